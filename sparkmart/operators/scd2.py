"""Type-2 history: one row per version of a key, with the interval it was valid in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import surrogate_key

from .dedup import dedup_latest
from .hot import TASK_ROWS, hot_keys, is_hot

# The four columns of a snapshot table.
SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = (
    "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to",
)
META = (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO)

_OUT = "_out"


def _versioned(batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The batch as open versions."""
    return batch.withColumns({
        SCD_ID: surrogate_key(key, updated_at),
        UPDATED_AT: F.col(updated_at),
        VALID_FROM: F.col(updated_at),
        VALID_TO: F.lit(None).cast(batch.schema[updated_at].dataType),
    })


def _one_per_key(batch: DataFrame, key: str, updated_at: str, on_duplicate: str) -> DataFrame:
    if on_duplicate == "latest":
        return dedup_latest(batch, [key], updated_at)
    if on_duplicate != "error":
        raise ValueError("on_duplicate is 'latest' or 'error'")
    # The second row of a key is enough to refuse it, so no more than two are shuffled.
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(updated_at)))
    refuse = F.raise_error(F.lit(f"duplicate {key} in batch")).cast("int")
    first_two = batch.withColumn(_OUT, rank).filter(F.col(_OUT) <= 2)
    return first_two.filter(F.when(F.col(_OUT) > 1, refuse).otherwise(F.col(_OUT)) == 1).drop(_OUT)


def scd2_step(
    open_rows: DataFrame,
    batch: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    on_duplicate: str = "latest",
) -> DataFrame:
    """Open versions after one batch, together with those the batch has closed.

    Only open versions meet the batch, so closed history is neither read nor shuffled.
    Open versions and batch have one row per key each: the join cannot fan out and no
    key can be hot.  One pass over the joined pair gives both of its versions.
    """
    new = _versioned(_one_per_key(batch, key, updated_at, on_duplicate), key, updated_at)
    columns = open_rows.columns + [c for c in new.columns if c not in open_rows.columns]
    types = {f.name: f.dataType for f in new.schema.fields} | {
        f.name: f.dataType for f in open_rows.schema.fields
    }
    # Both versions of a joined pair as structs; _out tells which of them exist.
    newer = f"o.{VALID_FROM} < n.`{updated_at}`"
    ended = f"if({newer}, n.`{updated_at}`, o.{VALID_TO})"

    def fields(side: str, have: list[str]) -> list[str]:
        return [
            f"cast({ended if side == 'o' and c == VALID_TO else f'{side}.`{c}`' if c in have else 'null'} "
            f"as {types[c].simpleString()}) as `{c}`"
            for c in columns
        ]

    known = f"o.{SCD_ID} is not null as {_OUT}"
    arrived = f"n.{SCD_ID} is not null and (o.{SCD_ID} is null or coalesce({newer}, false)) as {_OUT}"
    old_version = f"struct({', '.join([known, *fields('o', open_rows.columns)])})"
    new_version = f"struct({', '.join([arrived, *fields('n', new.columns)])})"

    o, n = open_rows.alias("o"), new.alias("n")
    joined = o.join(n, F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")), "full_outer")
    return joined.selectExpr(f"inline(array({old_version}, {new_version}))").filter(_OUT).drop(_OUT)


def scd2_apply(
    history: DataFrame | None,
    batch: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    on_duplicate: str = "latest",
) -> DataFrame:
    """The history after one more snapshot run.

    A key is compared by ``updated_at`` alone: a newer row closes the open version and
    opens its own; an equal, older or undated row changes nothing; a key the batch
    does not have stays as it is.  A repeated run changes nothing.
    """
    if history is None:
        return _versioned(_one_per_key(batch, key, updated_at, on_duplicate), key, updated_at)
    still_open = F.col(VALID_TO).isNull()
    stepped = scd2_step(history.filter(still_open), batch, key, updated_at, on_duplicate)
    return history.filter(~still_open).unionByName(stepped, allowMissingColumns=True)


def snapshot_customers(history: DataFrame | None, customers: DataFrame) -> DataFrame:
    return scd2_apply(history, customers, "customer_id")


def snapshot_products(history: DataFrame | None, products: DataFrame) -> DataFrame:
    return scd2_apply(history, products, "product_id")


def scd2_from_log(
    log: DataFrame, key: str, ts: str, ties: Sequence[str] | None = None, task_rows: int = TASK_ROWS,
) -> DataFrame:
    """History from a complete log of changes: each version ends where the next begins.

    Rows of one key and one instant count as one version (``ties`` choose the row).

    Rows meet by key: one shuffle and one sort, in which copies of an instant are left out and
    the next instant is looked up.  A key with more than ``task_rows`` rows, found by a sketch, is
    cut into ranges of time at its quantiles.  A range is a task's, whatever the key holds; the
    last version of a range ends where the next range begins, which one row per range tells.
    """
    ties = [c for c in log.columns if c not in (key, ts)] if ties is None else list(ties)
    hot = hot_keys(log, key, task_rows)
    if not hot:
        return _closed(log, key, ts, ties)
    is_one = is_hot(F.col(key), hot)
    bounds = _time_bounds(log.filter(is_one), key, ts, hot)
    # copies of an instant are folded before the shuffle: an instant can't be cut
    rows = dedup_latest(log.filter(is_one), [key, ts], None, ties)
    part = F.size(F.filter(_BOUNDS, lambda b: b <= F.col(ts))).alias(_PART)
    same = F.col(key).eqNullSafe(F.col(_KEY))
    ranged = rows.join(bounds, same).select(*log.columns, part)
    edges = log.filter(is_one).join(bounds, same).groupBy(F.col(key).alias(_KEY), part).agg(F.min(ts).alias(_NEXT))
    # one row per range and hot key
    edges = edges.select(_KEY, F.col(_PART).alias(f"{_PART}_r"), F.lead(_NEXT).over(Window.partitionBy(_KEY).orderBy(_PART)).alias(f"{_NEXT}_r"))
    inside = _closed(ranged, key, ts, ties, _PART)
    stitched = inside.join(edges, same & (F.col(_PART) == F.col(f"{_PART}_r")), "left")
    stitched = stitched.withColumn(VALID_TO, F.coalesce(VALID_TO, f"{_NEXT}_r")).drop(_KEY, f"{_PART}_r", f"{_NEXT}_r", _PART)
    return _closed(log.filter(~is_one), key, ts, ties).unionByName(stitched)


_KEY, _PART, _BOUNDS, _NEXT, _BEFORE = "_key", "_part", "_bounds", "_next", "_before"


def _closed(log: DataFrame, key: str, ts: str, ties: Sequence[str], *parts: str) -> DataFrame:
    """Versions of ``key`` (and ``parts`` of it), one per instant, each ended where the next one begins."""
    of = ", ".join(f"`{c}`" for c in (key, *parts))
    order = ", ".join([f"`{ts}` asc nulls first", *[f"`{c}` desc nulls last" for c in ties]])
    window = f"over (partition by {of} order by {order})"
    before = log.selectExpr("*", f"lag(struct(`{ts}`)) {window} as {_BEFORE}")
    first = before.filter(f"{_BEFORE} is null or not {_BEFORE}.`{ts}` <=> `{ts}`")
    return first.select(
        *log.columns, surrogate_key(key, ts).alias(SCD_ID), F.col(ts).alias(UPDATED_AT), F.col(ts).alias(VALID_FROM),
        F.expr(f"lead(`{ts}`) {window} as {VALID_TO}"),
    )


def _time_bounds(rows: DataFrame, key: str, ts: str, hot: dict[object, int]) -> DataFrame:
    """Per hot key the instants at which its ranges begin.  As many numbers as ranges: a small table."""
    most = max(hot.values())
    quantiles = F.percentile_approx(ts, [i / most for i in range(1, most)] or [0.5], 10 * most)
    found = rows.groupBy(F.col(key).alias(_KEY)).agg(quantiles.alias(_BOUNDS)).collect()
    kind = f"`{_KEY}` {rows.schema[key].dataType.simpleString()}, `{_BOUNDS}` array<{rows.schema[ts].dataType.simpleString()}>"
    cut = [(r[0], sorted({b for b in r[1] or [] if b is not None})) for r in found]
    return F.broadcast(rows.sparkSession.createDataFrame(cut, kind))
