"""The warehouse build: merge, snapshot, models, checks.

Every run writes to folders of its own number and is recorded last, in the run log.
A run that dies is not in the log; the next one takes the same number, reads what the
last recorded run left, and replaces the pieces.

Deliberate choices where the source system's own build is vague or unsafe:

* high-water marks are compared as instants, not as text;
* two rows of one key in a snapshot batch count as the newest one;
* ties between equally new rows are broken by the other columns;
* models read the merged tables (``read_from='merged'``) and not the last copy alone;
* staging is a function, so a first run needs nothing from an earlier one;
* records that are not objects are left out when pages are unwrapped;
* credentials are never printed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import Check, quality_report, scd2_apply, scd2_step
from sparkmart.operators.scd2 import VALID_TO
from sparkmart.session import PARQUET, read_if_exists, shuffles_dropped
from sparkmart.sources.keyed import KeyedTable
from sparkmart.sources.schemas import ENTITIES, RAW_SCHEMAS
from sparkmart.sources.tables import ORDER, append_batch, is_log, materialize, named_as_raw, read_log, sources
from sparkmart.together import together

from . import dimensions as dims
from . import facts
from .monthly import MONTHLY, RUN, MonthlyTable, by_month, changed_months, in_months, write_changes
from .staging import STAGING


#: Entity -> key of its type-2 history.
SNAPSHOTS = {"customers": "customer_id", "products": "product_id"}

# Keys and references of the marts' data tests.
_KEYS = {
    "dim_customers": "customer_key",
    "dim_products": "product_key",
    "dim_stores": "store_key",
    "dim_employees": "employee_key",
    "fct_sales": "order_item_id",
    "fct_payments": "payment_id",
}
_REFERENCES = [
    ("fct_sales", "dim_customers", "customer_key"),
    ("fct_sales", "dim_products", "product_key"),
    ("fct_sales", "dim_stores", "store_key"),
    ("fct_payments", "dim_customers", "customer_key"),
    ("fct_payments", "dim_stores", "store_key"),
    ("fct_payments", "dim_payment_method", "payment_method_key"),
]
#: The 18 data tests of the marts.
CHECKS = [Check(t, c, kind) for t, c in _KEYS.items() for kind in ("unique", "not_null")] + [
    Check(child, column, "relationships", parent, column) for child, parent, column in _REFERENCES
]

STATE = "state"


class Models(Mapping[str, DataFrame]):
    """All models over the raw tables by name, each built when first asked for.

    ``histories`` gives the snapshot history per entity; without it each key has the one
    version a first snapshot run would give it.  ``replaced`` holds models to use in
    place of those built here, such as tables already written.  ``deal`` lays out the rows
    of the large facts for where they are written; ``order_keys`` are those of the sales, if written.
    """

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, DataFrame],
        histories: Mapping[str, DataFrame] | None = None, replaced: Mapping[str, DataFrame] | None = None,
        days: tuple[str, str] = (dims.CALENDAR_START, dims.CALENDAR_END), deal: facts.Deal | None = None,
        order_keys: DataFrame | None = None,
    ) -> None:
        self.spark, self.raw, self.histories, self.days = spark, raw, histories, days
        self.deal, self.order_keys = deal, order_keys
        self.built = dict(replaced or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = MODELS[name](self)
        return self.built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(MODELS)

    def __len__(self) -> int:
        return len(MODELS)

    def take(self, *names: str) -> list[DataFrame]:
        return [self[name] for name in names]

    def history(self, entity: str) -> DataFrame:
        if self.histories is not None:
            return self.histories[entity]
        return scd2_apply(None, self[f"stg_{entity}"], SNAPSHOTS[entity])


def _staged(entity: str) -> Callable[[Models], DataFrame]:
    return lambda m: STAGING[entity](m.raw[entity])


#: Model name -> how it follows from the raw tables and other models.
MODELS: dict[str, Callable[[Models], DataFrame]] = {
    **{f"stg_{entity}": _staged(entity) for entity in STAGING},
    "dim_customers": lambda m: dims.dim_customers(m.history("customers")),
    "dim_products": lambda m: dims.dim_products(m.history("products")),
    "dim_stores": lambda m: dims.dim_stores(m["stg_stores"]),
    "dim_employees": lambda m: dims.dim_employees(m["stg_employees"]),
    "dim_payment_method": lambda m: dims.dim_payment_method(m["stg_payment_methods"]),
    "dim_date": lambda m: dims.dim_date(m.spark, *m.days),
    "fct_sales": lambda m: facts.fct_sales(*m.take(
        "stg_order_items", "stg_orders", "dim_customers", "dim_products", "dim_stores", "dim_employees"), m.deal, m.order_keys),
    "fct_payments": lambda m: facts.fct_payments(*m.take(
        "stg_payments", "stg_orders", "dim_customers", "dim_stores", "dim_payment_method"), m.deal),
    "flagged_payments": lambda m: facts.flagged_payments(m["stg_payments"]),
    "fct_inventory_daily": lambda m: facts.fct_inventory_daily(m.raw["inventory_movements"]),
    "fct_order_lifecycle": lambda m: facts.fct_order_lifecycle(m["stg_orders"]),
}
#: Fact -> role of a date -> its column.
DATE_ROLES = {
    "fct_sales": {"sold": "created_at"},
    "fct_payments": {"paid": "paid_at"},
    "fct_inventory_daily": {"inventory": "inventory_date"},
    "fct_order_lifecycle": {"ordered": "ordered_at", "shipped": "shipped_at", "delivered": "delivered_at"},
}
#: Models that are written; all others are views.
TABLES = tuple(MONTHLY)


def last_run(spark: SparkSession, state_dir: str) -> int:
    """Number of the last finished run, 0 before the first."""
    log = read_log(spark, f"{state_dir}/runs")
    return 0 if log is None else log.agg(F.max(RUN)).first()[0]


def read_snapshot(spark: SparkSession, state_dir: str, entity: str, run: int) -> DataFrame | None:
    """History after ``run``: what any run up to it has closed, and what is open in it."""
    parts = read_if_exists(spark, f"{state_dir}/snapshots/{entity}") if run else None
    if parts is None:
        return None
    closed = (F.col(STATE) == "closed") & (F.col(RUN) <= run)
    still_open = (F.col(STATE) == "open") & (F.col(RUN) == run)
    return parts.filter(closed | still_open).drop(RUN, STATE)


def snapshot_run(spark: SparkSession, state_dir: str, entity: str, staged: DataFrame, run: int) -> DataFrame:
    """One snapshot run: writes the open versions and those just closed, no older ones."""
    key = SNAPSHOTS[entity]
    history = read_snapshot(spark, state_dir, entity, run - 1)
    if history is None:
        versions = scd2_apply(None, staged, key)
    else:
        parts = spark.read.parquet(f"{state_dir}/snapshots/{entity}/{RUN}={run - 1}/{STATE}=open")
        versions = scd2_step(parts, staged, key)
    state = F.when(F.col(VALID_TO).isNull(), F.lit("open")).otherwise(F.lit("closed"))
    (
        versions.withColumn(STATE, state).write.options(**PARQUET).mode("overwrite").partitionBy(STATE)
        .parquet(f"{state_dir}/snapshots/{entity}/{RUN}={run}")
    )
    return read_snapshot(spark, state_dir, entity, run)


def _load(spark: SparkSession, src_dir: str, state_dir: str, run: int) -> dict[str, DataFrame]:
    """The raw tables of this run: those of the last one with what is new, by hash parts of their keys.

    Of a table that extraction keeps as a log of batches, the batches no earlier run took are
    folded in, once, whatever reads the table later.  Any other table is one whole batch.
    """

    def raw(entity: str) -> DataFrame:
        table, source = KeyedTable(f"{state_dir}/raw/{entity}"), spark.read.parquet(f"{src_dir}/{entity}")
        if is_log(source):
            return named_as_raw(table.fold(spark, f"{src_dir}/{entity}", run).drop(*ORDER), RAW_SCHEMAS[entity].fieldNames())
        return table.merge(spark, source, run, "updated_at" if "updated_at" in source.columns else None)

    return together(spark, {entity: lambda e=entity: raw(e) for entity in ENTITIES})


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.options(**PARQUET).mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _write_facts(
    spark: SparkSession, state_dir: str, out_dir: str, run: int, models: Models, histories: Mapping[str, DataFrame],
    read_from: str, date_keys: bool,
) -> dict[str, DataFrame]:
    """The two large facts, of which only the months that this run's load can change are built and written."""
    tables = {name: MonthlyTable(f"{out_dir}/{name}", f"{state_dir}/months/{name}") for name in TABLES}

    def fact(name: str, months: list[int | None] | None, keys: DataFrame | None = None) -> DataFrame:
        lines = f"stg_{MONTHLY[name].lines}"
        # a line of the merged tables has one row, so rows of other months don't decide on it
        some = {} if months is None else {lines: models[lines].filter(in_months(F.col("created_at"), months))}
        rows = Models(spark, models.raw, histories, some, models.days, by_month, keys)[name]
        return facts.fact_date_key(rows, models["dim_date"], DATE_ROLES[name]) if date_keys else rows

    build = {name: json.dumps([fact(name, None).schema.jsonValue(), read_from, [str(d) for d in models.days]]) for name in TABLES}
    same = [name for name in TABLES if read_from == "merged" and tables[name].built_as(spark, run - 1, build[name])]
    read = {e for name in same for e in ("orders", MONTHLY[name].lines, *MONTHLY[name].by_line.values(), *MONTHLY[name].by_order.values())}
    changes = together(spark, {e: lambda e=e: write_changes(spark, state_dir, e, run) for e in sorted(read)})

    def write(name: str) -> DataFrame:
        months = changed_months(MONTHLY[name], models, changes) if name in same else None
        rounds = tables[name].rounds(models[f"stg_{MONTHLY[name].lines}"], months) if read_from == "merged" else [months]
        keys = None
        if len(rounds) > 1 and name == "fct_sales":
            keys = facts.order_keys(*models.take("stg_orders", "dim_customers", "dim_stores", "dim_employees"))
            keys = _kept(keys, f"{state_dir}/order_keys/{RUN}={run}")
        written = tables[name].write(spark, lambda some: fact(name, some, keys), months, run, build[name], rounds)
        return materialize(written, name)

    return together(spark, {name: lambda n=name: write(n) for name in TABLES})


def run_pipeline(
    spark: SparkSession, src_dir: str, state_dir: str, out_dir: str, read_from: str = "merged",
    days: tuple[str, str] = (dims.CALENDAR_START, dims.CALENDAR_END), date_keys: bool = False,
) -> DataFrame:
    """Load, snapshot, build and check; returns the quality report.

    ``src_dir`` holds one Parquet table per entity.  A stage that fails raises, and
    nothing after it runs.  The two large facts are written under ``out_dir`` by month, of
    a later run only the months that its load can change; all other models are temp views.  ``days`` are the first and last day of the calendar;
    ``date_keys`` adds to the facts the calendar's keys of their dates (``DATE_ROLES``).
    What a job has shuffled is removed when the job ends.
    """
    with shuffles_dropped(spark):
        return _build(spark, src_dir, state_dir, out_dir, read_from, days, date_keys)


def _build(
    spark: SparkSession, src_dir: str, state_dir: str, out_dir: str, read_from: str, days: tuple[str, str], date_keys: bool,
) -> DataFrame:
    run = last_run(spark, state_dir) + 1
    merged = _load(spark, src_dir, state_dir, run)
    raw = merged if read_from == "merged" else sources(spark, src_dir)

    staged = Models(spark, raw)
    histories = together(spark, {e: lambda e=e: snapshot_run(spark, state_dir, e, staged[f"stg_{e}"], run) for e in SNAPSHOTS})

    models = Models(spark, raw, histories, days=days)
    written = _write_facts(spark, state_dir, out_dir, run, models, histories, read_from, date_keys)
    keyed = {
        name: facts.fact_date_key(models[name], models["dim_date"], roles)
        for name, roles in DATE_ROLES.items() if date_keys and name not in TABLES
    }
    models = Models(spark, raw, histories, keyed | written, days)
    for name in models:
        if name not in TABLES:
            materialize(models[name], name)

    path = f"{out_dir}/{RUN}={run}/quality"
    quality_report(spark, models, CHECKS).write.mode("overwrite").parquet(path)
    finished = spark.range(1).select(
        F.lit(run).alias(RUN), F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp").alias("finished_at"),
    )
    append_batch(finished, f"{state_dir}/runs", run)
    return spark.read.parquet(path)
