import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sparkmart.session import get_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_driver_memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return lambda name: scratch_path(spark, name)


def ts(text):
    """'2024-01-02' or '2024-01-02 03:04' as datetime; None stays None."""
    return None if text is None else datetime.fromisoformat(text)


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
