"""Every registered query against its SQL on the smallest test tables."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import connect, difference  # noqa: E402

from sparkmart.oracle import ORACLES  # noqa: E402
from sparkmart.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
