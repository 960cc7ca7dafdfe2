"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_rank"
UNORDERED = (T.MapType, T.VariantType)


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str | None,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key; a NULL in ``order_col`` counts as newest.

    ``ties`` decide between rows of equal age, larger values first.  By default all
    other columns do, so that the result never depends on how rows are spread over
    partitions.  Spark keeps the first row of each key per map task before it
    shuffles (window group limit), hence a key that holds a large part of all rows
    reaches its reducer as one row per map task.
    """
    if ties is None:
        ties = [
            f.name for f in df.schema.fields
            if f.name not in keys and f.name != order_col and not isinstance(f.dataType, UNORDERED)
        ]
    order = [f"`{order_col}` desc nulls first"] if order_col else []
    order += [f"`{c}` desc nulls last" for c in ties]
    partition = ", ".join(f"`{k}`" for k in keys)
    rank = f"row_number() over (partition by {partition} order by {', '.join(order or ['1'])})"
    return df.withColumn(_RANK, F.expr(rank)).filter(F.col(_RANK) == 1).drop(_RANK)


def filter_positive(df: DataFrame, amount: str) -> DataFrame:
    """Rows with an amount above zero.  Use it after the dedup: the newest state of a
    row counts, also when that state is not positive."""
    return df.filter(F.col(amount) > 0)
