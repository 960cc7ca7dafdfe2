"""Grouped sums and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_sum_count(
    df: DataFrame,
    by: Mapping[str, Column] | Sequence[str],
    total: str,
    total_name: str,
    count_name: str,
) -> DataFrame:
    """SUM and COUNT(*) per group.  Groups are summed per map task before the shuffle."""
    groups = [c.alias(n) for n, c in by.items()] if isinstance(by, Mapping) else list(by)
    return df.groupBy(*groups).agg(
        F.sum(total).cast("bigint").alias(total_name),
        F.count(F.lit(1)).alias(count_name),
    )
