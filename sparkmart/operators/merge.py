"""Upsert and merge by key.

Both return the new content of the table; the caller writes it to a new path.  The
batch is reduced to one row per key first, and only its keys meet the target: if the
batch is under the broadcast threshold, the target is filtered in place and not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_latest

PAGE, POSITION = "_page", "_pos"


def require_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row without a key fails the batch, as a primary key would."""
    return df.withColumns({
        k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL in key column {k}")).cast(df.schema[k].dataType))
        for k in keys
    })


_UNKNOWN, _LAST = "_unknown", "_last"


def last_written(batch: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The row written last for each key, in the order of the ``seq`` columns.

    A NULL in the first of them counts as last; rows that tie on all of them are decided by
    their other columns, larger values first.  As an aggregate, not a ranking: a reader that
    counts keys, or takes none of the columns beside them, ships the keys alone.
    """
    order = [c for c in seq if c in batch.columns]
    rows = require_key(batch, keys)
    if not order:
        return dedup_latest(rows, keys, None)
    others = [c for c in rows.columns if c not in order and c not in keys]
    if any(kind in rows.schema[c].dataType.simpleString() for c in others for kind in ("map<", "variant")):
        return dedup_latest(rows, keys, order[0]).drop(*order)
    row = F.struct(F.col(f"`{order[0]}`").isNull().alias(_UNKNOWN), *[F.col(f"`{c}`") for c in order + others])
    newest = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max(row).alias(_LAST))
    kept = [c for c in rows.columns if c not in order]
    return newest.select(*[F.col(f"`{c}`") if c in keys else F.col(_LAST)[c].alias(c) for c in kept])


def upsert_by_key(
    target: DataFrame | None,
    batch: DataFrame,
    key: str = "id",
    seq: Sequence[str] = (PAGE, POSITION),
) -> DataFrame:
    """Insert new keys and overwrite known ones with what was written last.

    There is no comparison of timestamps: an older record that arrives later wins.
    Columns the batch does not have keep the target's value on known keys.
    """
    latest = last_written(batch, [key], seq)
    if target is None:
        return latest
    kept = [c for c in target.columns if c not in latest.columns]
    if kept:
        latest = latest.join(target.select(key, *kept), key, "left")
    return _replace(target, batch, latest, [key])


def merge_by_key(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str] = ("id",),
    dedup_sort: str | None = None,
) -> DataFrame:
    """Delete the batch's keys from the target and insert the batch, whole rows.

    Rows absent from the batch stay.  ``dedup_sort`` names the column whose largest
    value wins where the batch has a key more than once.
    """
    latest = dedup_latest(require_key(batch, keys), list(keys), dedup_sort)
    return latest if target is None else _replace(target, batch, latest, list(keys))


def _replace(target: DataFrame, batch: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    # The keys come from the batch itself: distinct folds a repeated key per map task,
    # and the ranking of whole rows is not run a second time just for their keys.
    untouched = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return untouched.unionByName(latest, allowMissingColumns=True)
