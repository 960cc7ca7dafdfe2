"""Incremental ingest of landed pages as a file stream."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.operators.merge import require_key
from sparkmart.session import read_if_exists
from sparkmart.sources.pages import KEY, number_pages, read_page_stream, rows_of, unwrap_pages
from sparkmart.sources.tables import BATCH, append_batch, first_number, grown_schema, read_log


def stream_ingest(
    spark: SparkSession, in_dir: str, table_dir: str, checkpoint: str, schema: T.StructType,
    max_files: int | None = None, grow: bool = True,
) -> StreamingQuery:
    """Start a run over the files that landed since the last one; it ends by itself.

    The checkpoint takes the place of the high-water mark.  Each micro-batch becomes one
    batch of the table's log; its number is that of the micro-batch, counted from a start
    that belongs to the checkpoint.  A batch that is replayed after a failure replaces
    itself, and a stream with another checkpoint never replaces it.

    ``schema`` are the columns the table has at least.  A field that it doesn't know becomes a
    column with the type that extraction would give it, from its micro-batch on; columns once
    there keep their type.  With ``grow=False`` unknown fields are dropped.
    """
    start = _start(spark, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        records = unwrap_pages(number_pages(batch))
        columns = grown_schema(_before(spark, table_dir, start + number), records, schema) if grow else schema
        append_batch(require_key(rows_of(records, columns), [KEY]), table_dir, start + number)

    return (
        read_page_stream(spark, in_dir, max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _before(spark: SparkSession, table_dir: str, number: int) -> DataFrame | None:
    """The table's log without batch ``number``, which a replay writes again."""
    log = read_log(spark, table_dir)
    return None if log is None else log.filter(F.col(BATCH) != number)


def _start(spark: SparkSession, checkpoint: str) -> int:
    """The first batch number of the checkpoint's stream; fixed when it is first used."""
    path = f"{checkpoint}/first_batch"
    known = read_if_exists(spark, path)
    if known is None:
        spark.range(1).select(F.lit(first_number(datetime.now(timezone.utc))).alias("number")).write.parquet(path)
        known = spark.read.parquet(path)
    return known.first()["number"]
