"""Keys that hold more rows than one task should take, found by a bounded sketch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task may take.
TASK_ROWS = 2_000_000
#: Most hot keys, and the items the sketch tracks: it never misses a key with more than
#: 2 / ``TRACKED`` of all rows, so a table has no more hot keys than are asked for.
HOT_KEYS, TRACKED = 1_000, 16_384
#: Most slices of a key.
SLICES = 1_000


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> dict[object, int]:
    """Key -> slices it should be cut into, for keys with more than ``task_rows`` rows.

    One pass over the key's column; each task sends a sketch of bounded size.  NULL is a key.
    Of a table with more such keys than ``HOT_KEYS`` the largest are given: the others then hold
    less than a thousandth of its rows each.
    """
    found = df.selectExpr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED}) as top", f"count_if(`{key}` is null) as nulls").first()
    counts = {item["item"]: item["count"] for item in found["top"] or [] if item["item"] is not None} | {None: found["nulls"]}
    return {k: min(SLICES, -(-n // task_rows)) for k, n in counts.items() if n > task_rows}


def is_hot(key: Column, hot: dict[object, int]) -> Column:
    """Whether a key is one of ``hot``."""
    known = [k for k in hot if k is not None]
    listed = F.coalesce(key.isin(known), F.lit(False)) if known else F.lit(False)
    return listed | key.isNull() if None in hot else listed
