"""Session settings and the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Runtime settings every job relies on.  They may be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, also where the split costs a shuffle
    # further down: one slow task is worse than one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: How tables are written.  Keys that are hex text take half the space they take with Spark's default codec.
PARQUET = {"compression": "zstd"}

#: Whether the files a query has shuffled are removed when it ends, or at some later time.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}


def get_session(app: str = "sparkmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`RUNTIME_CONF`; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named in ``spark.checkpoint.dir``.

    Only a local session may do without it; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="sparkmart-")
    return _local_dirs[context.applicationId]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """While it holds, a query's shuffle files are removed when the query ends, so that those of many jobs don't add up.

    For frames that are run once: one that is run again shuffles again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/sparkmart/{uuid.uuid4().hex}/{name}"


def read_if_exists(spark: SparkSession, path: str, **options: str):
    """The Parquet dataset at ``path``, or ``None`` if nothing was written there yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
