"""Tables over JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, schema: str | None = None, partition: Mapping[str, object] | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options.  ``partition``: column, lower, upper, count.

    Without ``partition`` the table comes through one connection into one task, so a
    large table needs it.  Bounds only cut the range; rows outside them are read too.
    """
    options = {"url": url, "dbtable": f"{schema}.{table}" if schema else table, "fetchsize": "10000", **extra}
    if partition:
        options |= {
            "partitionColumn": str(partition["column"]),
            "lowerBound": str(partition["lower"]),
            "upperBound": str(partition["upper"]),
            "numPartitions": str(partition["count"]),
        }
    return options


def read_jdbc_tables(
    spark: SparkSession, url: str, schema: str | None, names: Iterable[str],
    partition: Mapping[str, Mapping[str, object]] | None = None, **extra: str,
) -> dict[str, DataFrame]:
    """The named tables of one schema; ``partition`` is given per table name.

    Filters and column lists set on the result reach the database.
    """
    return {
        name: spark.read.format("jdbc").options(
            **jdbc_options(url, name, schema, (partition or {}).get(name), **extra)
        ).load()
        for name in names
    }
