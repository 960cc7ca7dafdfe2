"""Data tests.  A check gives the violating rows; none means it has passed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAILURES = "failures"


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values found more than once, with their count."""
    return _value_counts(df.filter(F.col(col).isNotNull()), col).filter(F.col(FAILURES) > 1)


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(col).isNull())


def check_relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Values of ``col`` the parent does not have, with the number of child rows.

    The child is counted per value before the join, so a value shared by much of the
    child is one row there.
    """
    counts = _value_counts(child.filter(F.col(col).isNotNull()), col)
    known = parent.select(F.col(field).alias(col)).distinct()
    return counts.join(known, col, "left_anti")


def _value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(FAILURES))


@dataclass(frozen=True)
class Check:
    """One test of a suite: ``kind`` is unique, not_null or relationships."""

    table: str
    column: str
    kind: str
    to: str | None = None
    field: str | None = None

    @property
    def name(self) -> str:
        target = f"_{self.to}_{self.field}" if self.to else ""
        return f"{self.kind}_{self.table}_{self.column}{target}"


def multiset_digest(df: DataFrame, measure: str) -> DataFrame:
    """One row that tells a table from any other as a bag of rows: ``rows``, ``total`` of a measure, ``mixed``, ``added``.

    Rows are hashed with NULLs told from absent values; exclusive or and sum of two hashes don't
    depend on order or partitions, and together notice a row that comes or goes in pairs.  Nothing is
    shuffled but one row per task.
    """
    cells = [cell for c in df.columns for cell in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.expr(measure)), F.lit(0)).cast("decimal(38,2)").alias("total"),
        F.coalesce(F.bit_xor(F.xxhash64(*cells)), F.lit(0)).alias("mixed"),
        F.coalesce(F.sum(F.xxhash64(F.lit(1), *cells).cast("decimal(38,0)")), F.lit(0)).alias("added"),
    )


def quality_report(spark: SparkSession, tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: name, number of failures, status.

    The NULLs of a table are counted in one pass without a shuffle of rows.  Every other
    check counts its own column: unique ids and keys that much of the table shares never
    meet in one aggregate, and the latter are folded before the shuffle.  ``tables`` are
    read once per check, so they should be written tables and not views over long plans.
    """
    checks = list(checks)
    nulls: dict[str, list[Check]] = {}
    for check in checks:
        if check.kind == "not_null":
            nulls.setdefault(check.table, []).append(check)
    reports = [_null_counts(tables[table], group) for table, group in nulls.items()]
    reports += [_failures(tables, check) for check in checks if check.kind != "not_null"]
    if not reports:
        return spark.createDataFrame([], f"check_name string, {FAILURES} bigint, status string")
    return reduce(DataFrame.unionByName, reports).select(
        "check_name", FAILURES, F.when(F.col(FAILURES) == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def _null_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    results = [F.struct(F.lit(c.name).alias("check_name"), F.count_if(F.col(c.column).isNull()).alias(FAILURES)) for c in checks]
    return df.agg(F.array(*results).alias("results")).select(F.inline("results"))


def _failures(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The number of values that are not unique, or of rows without a parent."""
    if check.kind == "unique":
        found = check_unique(tables[check.table], check.column).agg(F.count(F.lit(1)).alias(FAILURES))
    elif check.kind == "relationships":
        lost = check_relationships(tables[check.table], check.column, tables[check.to], check.field)
        found = lost.agg(F.coalesce(F.sum(FAILURES), F.lit(0)).cast("bigint").alias(FAILURES))
    else:
        raise ValueError(f"unknown kind of check: {check.kind}")
    return found.select(F.lit(check.name).alias("check_name"), FAILURES)
