"""Day series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "date_day"
_ONE_DAY = "interval 1 day"


def _series(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr(_ONE_DAY))).alias(DAY)


def date_spine(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    return spark.range(1).select(_series(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))


def date_spine_over(df: DataFrame, *columns: str) -> DataFrame:
    """Every day between the first and the last one found in ``columns`` of ``df``."""
    days = [F.col(c).cast("date") for c in columns]
    first = F.least(*[F.min(d) for d in days]) if len(days) > 1 else F.min(days[0])
    last = F.greatest(*[F.max(d) for d in days]) if len(days) > 1 else F.max(days[0])
    return df.agg(first.alias("first"), last.alias("last")).select(_series(F.col("first"), F.col("last")))
