"""One runnable query per operator, over the test tables.

Each takes (spark, sf_dir) and runs over whole tables.  Queries about landed pages,
batches and written tables derive those from the tables with Spark and keep them in the
folder the cluster shares.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import functions as fn
from sparkmart import operators as op
from sparkmart.operators.merge import PAGE, POSITION
from sparkmart.plans import dimensions as dims
from sparkmart.plans import facts, reports, staging
from sparkmart.plans.warehouse import (
    CHECKS, SNAPSHOTS, Models, read_snapshot, run_pipeline,
)
from sparkmart.session import PARQUET, scratch_path, shuffles_dropped
from sparkmart.sources import driver_tables as dt
from sparkmart.sources import pages as pg
from sparkmart.sources import tables as tb
from sparkmart.sources import watermark as wm
from sparkmart.sources.extract import ExtractState, current_marks, extract_all, extract_entity
from sparkmart.sources.keyed import KeyedTable
from sparkmart.streaming import stream_ingest
from sparkmart.together import together

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f
    return register


# ---------------------------------------------------------------- landed pages

RECORD = fn.struct(
    "id string, eventId bigint, eventType string, value double, large boolean, props string, updatedAt string"
)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return pg.unwrap_pages(dt.landed_pages(spark, sf))


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return pg.rows_of(_records(spark, sf), RECORD)


def _land(pages: DataFrame, load: int, path: str) -> None:
    """The pages of one load, in files whose names sort by page."""
    due = pages.filter(F.col("load") == load).repartitionByRange(PAGE).sortWithinPartitions(PAGE)
    due.select("value").write.text(f"{path}/load={load}")


@query("unwrap_pages")
def _(spark, sf):
    row = fn.struct("id string, eventId bigint, value double")
    return pg.rows_of(_records(spark, sf), row).select(
        F.col(PAGE).alias("page"), F.col(POSITION).cast("bigint").alias("pos"), "id", "eventId", "value",
    )


@query("infer_arrival_schema")
def _(spark, sf):
    return pg.arrival_fields(_records(spark, sf), "all")


@query("serialize_nested")
def _(spark, sf):
    nested = dt.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k int").alias("props"), F.array("user_id", "event_id").alias("pair"),
    )
    return op.serialize_nested(nested)


@query("conform_columns")
def _(spark, sf):
    schema = fn.struct("event_id string, user_id bigint, value decimal(12,2), channel string, ts timestamp_ntz")
    return op.conform_columns(dt.table(spark, sf, "events"), schema)


@query("snake_case_columns")
def _(spark, sf):
    orders = dt.table(spark, sf, "orders")
    camel = orders.select(
        F.col("o_orderkey").alias("orderId"), F.col("o_custkey").alias("customerID"),
        F.col("o_orderdate").alias("updatedAt"), F.col("o_orderstatus").alias("status"),
    )
    return op.snake_case_columns(camel)


# ---------------------------------------------------------------- watermarks


def _marks(spark: SparkSession, sf: str) -> DataFrame:
    """A control table: one mark per event type, as of half of the events."""
    events = dt.table(spark, sf, "events")
    return events.groupBy(F.col("event_type").alias("entity")).agg(
        F.concat(F.max("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("last_updated_at"),
        F.lit("2024-03-01T00:00:00Z").cast("timestamp").alias("last_run_at"),
        F.count(F.lit(1)).alias("rows_extracted"),
    )


@query("read_watermark")
def _(spark, sf):
    return wm.mark_of(_marks(spark, sf), "purchase").select(
        "entity", fn.utc_ntz("last_updated_at").alias("mark"),
    )


MARK = "2024-01-02T12:00:00Z"


@query("filter_updated_after")
def _(spark, sf):
    return wm.filter_updated_after(_rows(spark, sf), MARK).select("eventId", "updatedAt")


@query("advance_watermark")
def _(spark, sf):
    return wm.advance_watermark(_rows(spark, sf), MARK).select(fn.utc_ntz("mark").alias("mark"), "rows")


@query("save_watermark")
def _(spark, sf):
    marks = wm.save_watermark(_marks(spark, sf), "purchase", "2030-01-01T02:00:00+02:00", 7, "2030-01-02T00:00:00Z")
    return wm.save_watermark(marks, "refund", "2030-01-01T00:00:00Z", 1, "2030-01-02T00:00:00Z").select(
        "entity", fn.utc_ntz("last_updated_at").alias("last_updated_at"),
        fn.utc_ntz("last_run_at").alias("last_run_at"), "rows_extracted",
    )


# ---------------------------------------------------------------- upsert, merge, extract


def _event_columns(df: DataFrame) -> DataFrame:
    return df.select("id", "eventId", "eventType", "value", "large", "props", "updatedAt")


@query("upsert_by_id")
def _(spark, sf):
    rows = _rows(spark, sf)
    base = op.upsert_by_key(None, rows)
    # Arrival order decides: late errors overwrite newer rows.
    late = rows.filter("eventType = 'error'").withColumn("value", F.col("value") * 2)
    return _event_columns(op.upsert_by_key(base, late))


@query("merge_by_key")
def _(spark, sf):
    raw = dt.raw_tables(spark, sf)
    base = op.merge_by_key(None, raw["customers"], ["id"], "updated_at")
    changed = dt.second_batches(spark, sf)["customers"].filter("tier = 'vip'")
    merged = op.merge_by_key(base, changed, ["id"], "updated_at")
    return merged.select("id", "segment", "tier", "updated_at")


@query("merge_parts")
def _(spark, sf):
    """As ``merge_by_key``, over a table in parts: the second version writes the parts its keys are in."""
    table = KeyedTable(scratch_path(spark, "customers"))
    table.merge(spark, dt.raw_tables(spark, sf)["customers"], 1, "updated_at")
    changed = dt.second_batches(spark, sf)["customers"].filter("tier = 'vip'")
    return table.merge(spark, changed, 2, "updated_at").select("id", "segment", "tier", "updated_at")


@query("fold_log")
def _(spark, sf):
    """The lake's log of events, folded after each load: the second fold reads the second batch alone."""
    state, table = ExtractState(scratch_path(spark, "landing"), scratch_path(spark, "lake")), KeyedTable(scratch_path(spark, "folded"))
    pages = dt.landed_pages(spark, sf)
    for load in range(1, dt.LOADS + 1):
        _land(pages, load, state.landing("events"))
        extract_entity(spark, "events", state)
        folded = table.fold(spark, state.table("events"), load)
    return _event_columns(folded).withColumn("value", F.col("value").cast("double"))


@query("extract_entity")
def _(spark, sf):
    state = ExtractState(scratch_path(spark, "landing"), scratch_path(spark, "lake"))
    pages = dt.landed_pages(spark, sf)
    day = datetime(2030, 1, 1, tzinfo=timezone.utc)
    _land(pages, 1, state.landing("events"))
    extract_entity(spark, "events", state, run_at=day)
    _land(pages, 2, state.landing("events"))
    extract_entity(spark, "events", state, full_refresh=True, run_at=day.replace(day=2))
    extract_entity(spark, "events", state, run_at=day.replace(day=3))
    return _event_columns(state.entity(spark, "events")).withColumn("value", F.col("value").cast("double"))


@query("extract_rerun_is_noop")
def _(spark, sf):
    """Rows each run wrote and batches the table has after it: a run over nothing new adds none."""
    state = ExtractState(scratch_path(spark, "landing"), scratch_path(spark, "lake"))
    pages = dt.landed_pages(spark, sf)
    day = datetime(2030, 1, 1, tzinfo=timezone.utc)
    results = []
    for load in range(1, dt.LOADS + 1):
        _land(pages, load, state.landing("events"))
        for _ in range(2):
            run = len(results) + 1
            rows = extract_entity(spark, "events", state, run_at=day.replace(day=run))
            batches = tb.read_log(spark, state.table("events")).select(tb.BATCH).distinct().count()
            results.append((run, rows, batches))
    return spark.createDataFrame(results, "run int, rows bigint, batches bigint")


@query("extract_summary")
def _(spark, sf):
    state = ExtractState(scratch_path(spark, "landing"), scratch_path(spark, "lake"))
    pages = dt.landed_pages(spark, sf, "event_type")
    pages.select("event_type", "value").write.partitionBy("event_type").text(state.landing_dir)
    types = [r[0] for r in dt.table(spark, sf, "events").select("event_type").distinct().orderBy("event_type").collect()]
    names = [f"event_type={t}" for t in types] + ["not_landed"]
    summary = extract_all(spark, names, state)
    marks = current_marks(spark, state).select("entity", fn.utc_ntz("last_updated_at").alias("mark"))
    return op.lookup(summary.select("entity", "status", "rows"), marks, "entity", ["mark"])


# ---------------------------------------------------------------- tables


@query("write_table")
def _(spark, sf):
    path = scratch_path(spark, "supplier")
    suppliers = dt.table(spark, sf, "supplier")
    tb.write_table(suppliers.filter("s_acctbal >= 0"), path)
    tb.write_table(suppliers.filter("s_acctbal < 0"), path)
    return spark.read.parquet(path)


def _write_lake(spark: SparkSession, sf: str, but: tuple[str, ...] = ()) -> str:
    path, raw = scratch_path(spark, "lake"), dt.raw_tables(spark, sf)
    for entity, df in ((e, raw[e]) for e in raw if e not in but):
        df.write.options(**PARQUET).parquet(f"{path}/{entity}")
    return path


#: Sources the query below keeps as logs.
LOGGED = ("order_items", "inventory_movements", "customers", "products")


@query("source_table")
def _(spark, sf):
    """Rows of each source, four of which are kept as logs of batches: what is written twice counts once."""
    lake, raw = _write_lake(spark, sf, LOGGED), dt.raw_tables(spark, sf)
    for entity in LOGGED:
        place = f"{lake}/logs/{entity}"
        tb.append_batch(raw[entity].withColumns({PAGE: F.lit(1), POSITION: F.monotonically_increasing_id()}), place, 1)
        log = spark.read.parquet(f"{place}/{tb.BATCH}=1")
        tb.append_batch(log.filter("quantity > 5") if "quantity" in log.columns else log, place, 2)
    places = {n: f"{lake}/logs" if n in LOGGED else lake for n in tb.ENTITIES}
    tables = {n: tb.sources(spark, place, [n])[n] for n, place in places.items()}
    counts = [df.agg(F.lit(n).alias("source"), F.count(F.lit(1)).alias("rows")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


@query("materialize")
def _(spark, sf):
    daily = facts.fct_inventory_daily(dt.raw_tables(spark, sf)["inventory_movements"])
    month = F.year("inventory_date") * 100 + F.month("inventory_date")
    tb.materialize(daily.withColumn("month", month), "inventory_by_month", "table", scratch_path(spark, "daily"), "month")
    return spark.table("inventory_by_month")


@query("model_ref")
def _(spark, sf):
    flagged = facts.flagged_payments(staging.stg_payments(dt.raw_tables(spark, sf)["payments"]))
    methods = dims.dim_payment_method(staging.stg_payment_methods(dt.raw_tables(spark, sf)["payment_methods"]))
    per_method = flagged.groupBy("payment_method_id").agg(F.count(F.lit(1)).alias("flagged"))
    return op.lookup(per_method, methods, "payment_method_id", ["method_name"])


# ---------------------------------------------------------------- staging


def _staging_query(entity: str, model) -> None:
    QUERIES[model.__name__] = lambda spark, sf: model(dt.raw_tables(spark, sf)[entity])


for _entity, _model in staging.STAGING.items():
    _staging_query(_entity, _model)


# ---------------------------------------------------------------- columns


def _over(table: str, *keys: str, **columns) -> Query:
    """The key columns of a table beside columns computed from it."""
    def run(spark, sf):
        return dt.table(spark, sf, table).select(*keys, *[c().alias(n) for n, c in columns.items()])
    return run


_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
DOUBLE = T.DoubleType()
ANSWER = "case when l_returnflag = 'R' then 'on' when l_returnflag = 'A' then 'Off' when l_linenumber = 1 then 'yes' else '0' end"

QUERIES |= {
    "cast_text": _over("lineitem", *_LINE, key_text=lambda: fn.cast_text("l_orderkey"), ship_text=lambda: fn.cast_text("l_shipdate")),
    "cast_int": _over("lineitem", *_LINE, quantity=lambda: fn.cast_int("l_quantity", DOUBLE), price=lambda: fn.cast_int(F.col("l_extendedprice").cast("decimal(12,2)"), T.DecimalType(12, 2))),
    "cast_money": _over("lineitem", *_LINE, price=lambda: fn.cast_money("l_extendedprice")),
    "cast_pct": _over("lineitem", *_LINE, discount_pct=lambda: fn.cast_pct("l_discount")),
    "cast_bool": _over("lineitem", *_LINE, answer=lambda: fn.cast_bool(F.expr(ANSWER))),
    "cast_date": _over("lineitem", *_LINE, ship_date=lambda: fn.cast_date("l_shipdate")),
    "cast_ts": _over("events", "event_id", at=lambda: fn.cast_ts(F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")))),
    "full_name": _over("supplier", "s_suppkey", full_name=lambda: fn.full_name(F.expr("case when s_suppkey % 3 > 0 then s_name end"), F.expr("case when s_suppkey % 5 > 0 then s_acctbal end"))),
    "clean_phone": _over("customer", "c_custkey", phone=lambda: fn.clean_phone(F.expr(dt.CUSTOMERS["phone"]))),
    "coalesce_empty": _over("customer", "c_custkey", segment=lambda: fn.coalesce_empty(F.expr("nullif(c_mktsegment, 'BUILDING')"))),
    "md5_key": _over("lineitem", *_LINE, line_key=lambda: fn.md5_key(F.expr(dt.ORDER_ITEMS["id"]))),
    "surrogate_key": _over("orders", "o_orderkey", order_key=lambda: fn.surrogate_key("o_orderkey", F.expr("nullif(o_orderstatus, 'P')"), "o_orderdate")),
    "date_key": _over("lineitem", *_LINE, date_key=lambda: fn.date_key("l_shipdate")),
    "date_parts": lambda spark, sf: dt.table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in fn.date_parts("o_orderdate").items()]),
    "iso_week": _over("orders", "o_orderkey", week=lambda: fn.iso_week("o_orderdate")),
    "day_name": _over("orders", "o_orderkey", day_of_week=lambda: fn.day_name("o_orderdate")),
    "is_weekend": _over("orders", "o_orderkey", is_weekend=lambda: fn.is_weekend("o_orderdate")),
    "to_day": _over("events", "event_id", day=lambda: fn.to_day("ts")),
    "gross_revenue": _over("lineitem", *_LINE, gross_revenue=lambda: fn.gross_revenue(fn.cast_int("l_quantity", DOUBLE), fn.cast_money("l_extendedprice"))),
}


@query("is_current")
def _(spark, sf):
    return _history(spark, sf, "customers").select("customer_id", "dbt_valid_from", fn.is_current("dbt_valid_to").alias("is_current"))


@query("hours_between")
def _(spark, sf):
    return _staged(spark, sf)["stg_orders"].select("order_id", fn.hours_between("ordered_at", "delivered_at").alias("hours"))


@query("predicates")
def _(spark, sf):
    orders = _staged(spark, sf)["stg_orders"]
    kept = orders.filter(
        F.col("status").isin("F", "O") & (F.col("discount_amount") <= 0) & F.col("discount_code").isNull()
        & (F.col("total_amount") > 100000) & (F.col("team_id") == "1")
    )
    return kept.select("order_id", "status", "total_amount", (F.col("delivered_at") > F.col("ordered_at")).alias("later"))


# ---------------------------------------------------------------- relational operators


def _staged(spark: SparkSession, sf: str) -> Models:
    return Models(spark, dt.raw_tables(spark, sf))


def _history(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    """History of customers or products after both batches."""
    model, key = staging.STAGING[entity], SNAPSHOTS[entity]
    first = op.scd2_apply(None, model(dt.raw_tables(spark, sf)[entity]), key)
    return op.scd2_apply(first, model(dt.second_batches(spark, sf)[entity]), key)


class _Histories(dict):
    """History per entity, built when asked for."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        super().__init__()
        self.place = spark, sf

    def __missing__(self, entity: str) -> DataFrame:
        return self.setdefault(entity, _history(*self.place, entity))


class _Marts(Models):
    """All models, with both batches in the histories and a calendar that covers the data."""

    def __getitem__(self, name: str) -> DataFrame:
        if name == "dim_date" and name not in self.built:
            days = op.date_spine_over(self["stg_order_items"], "created_at", "updated_at")
            self.built[name] = dims.calendar(days)
        return super().__getitem__(name)


def marts(spark: SparkSession, sf: str) -> Models:
    return _Marts(spark, dt.raw_tables(spark, sf), _Histories(spark, sf))


@query("left_join_lookup")
def _(spark, sf):
    staged = _staged(spark, sf)
    return op.lookup(staged["stg_orders"], dims.dim_stores(staged["stg_stores"]), "store_id", ["store_key"]).select(
        "order_id", "store_id", "store_key"
    )


@query("hot_key_lookup")
def _(spark, sf):
    """As ``left_join_lookup``, with the stores of more than a hundred orders split by themselves."""
    staged = _staged(spark, sf)
    joined = op.lookup(staged["stg_orders"], dims.dim_stores(staged["stg_stores"]), "store_id", ["store_key"], salt="hot", task_rows=100)
    return joined.select("order_id", "store_id", "store_key")


@query("current_dim_join")
def _(spark, sf):
    customers = dims.dim_customers(_history(spark, sf, "customers"))
    return op.lookup_current(_staged(spark, sf)["stg_orders"], customers, "customer_id", ["customer_key", "tier"]).select(
        "order_id", "customer_key", "tier"
    )


@query("dedup_latest")
def _(spark, sf):
    return op.dedup_latest(_staged(spark, sf)["stg_order_items"], ["order_item_id"], "updated_at")


@query("group_sum_count")
def _(spark, sf):
    by = {"ship_day": fn.to_day("l_shipdate"), "flag": F.col("l_returnflag")}
    return op.group_sum_count(dt.table(spark, sf, "lineitem"), by, "l_partkey", "total", "lines")


@query("date_spine")
def _(spark, sf):
    return op.date_spine_over(dt.table(spark, sf, "orders"), "o_orderdate")


@query("cte")
def _(spark, sf):
    lines = _staged(spark, sf)["stg_order_items"]
    newest = op.dedup_latest(lines, ["order_item_id"], "updated_at")
    return newest.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines"), F.max("updated_at").alias("newest"))


@query("filter_positive")
def _(spark, sf):
    newest = op.dedup_latest(_staged(spark, sf)["stg_payments"], ["payment_id"], "updated_at")
    return op.filter_positive(newest, "amount_paid").select("payment_id", "amount_paid", "updated_at")


# ---------------------------------------------------------------- history


@query("scd2_apply")
def _(spark, sf):
    events = dt.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), "event_type", "value", F.col("ts").alias("updated_at"),
    )
    # A batch shows the last state of a user: first without the errors, then with them.
    history = op.scd2_apply(None, events.filter("event_type <> 'error'"), "user_id")
    return op.scd2_apply(history, events, "user_id")


@query("snapshot_customers")
def _(spark, sf):
    return _history(spark, sf, "customers")


@query("snapshot_products")
def _(spark, sf):
    return _history(spark, sf, "products")


@query("scd2_from_log")
def _(spark, sf):
    events = dt.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_id", "event_type", "ts")
    return op.scd2_from_log(events, "user_id", "ts")


@query("scd2_from_hot_log")
def _(spark, sf):
    """History of a handful of keys: each is cut into ranges of time of about 500 rows."""
    events = dt.table(spark, sf, "events").select("event_type", "user_id", "ts")
    return op.scd2_from_log(events, "event_type", "ts", ["user_id"], task_rows=500)


# ---------------------------------------------------------------- marts and reports


def _mart_query(name: str) -> None:
    QUERIES[name] = lambda spark, sf: marts(spark, sf)[name]


for _name in (
    "dim_customers", "dim_products", "dim_stores", "dim_employees", "dim_payment_method", "dim_date",
    "fct_sales", "fct_payments", "flagged_payments", "fct_inventory_daily", "fct_order_lifecycle",
):
    _mart_query(_name)


@query("fact_date_key")
def _(spark, sf):
    m = marts(spark, sf)
    roles = {"ordered": "ordered_at", "shipped": "shipped_at", "delivered": "delivered_at"}
    return facts.fact_date_key(m["fct_order_lifecycle"], m["dim_date"], roles).select(
        "order_id", "ordered_date_key", "shipped_date_key", "delivered_date_key"
    )


def _report_query(report) -> None:
    QUERIES[report.__name__] = lambda spark, sf: report(marts(spark, sf))


for _report in (
    reports.kpi_summary, reports.revenue_by_store, reports.revenue_by_product, reports.revenue_trend,
    reports.top_customers, reports.customer_growth, reports.payment_method_mix,
    reports.payment_performance, reports.inventory_monitor, reports.store_performance,
):
    _report_query(_report)


# ---------------------------------------------------------------- quality


@query("check_unique")
def _(spark, sf):
    return op.check_unique(_staged(spark, sf)["stg_order_items"], "order_item_id")


@query("check_not_null")
def _(spark, sf):
    return op.check_not_null(_staged(spark, sf)["stg_orders"], "delivered_at").select("order_id", "status", "ordered_at")


@query("check_relationships")
def _(spark, sf):
    staged = _staged(spark, sf)
    return op.check_relationships(staged["stg_orders"], "store_id", staged["stg_stores"], "store_id")


#: Checks on natural keys, which unlike those of the marts can fail.
NATURAL_CHECKS = [
    op.Check("stg_order_items", "order_item_id", "unique"),
    op.Check("stg_order_items", "order_item_id", "not_null"),
    op.Check("stg_orders", "delivered_at", "not_null"),
    op.Check("stg_orders", "store_id", "relationships", "stg_stores", "store_id"),
    op.Check("stg_payments", "payment_method_id", "relationships", "stg_payment_methods", "payment_method_id"),
]


@query("quality_report")
def _(spark, sf):
    """Checks over written tables, as in a build: dimensions whole, all others with the columns the checks name."""
    checks, models = CHECKS + NATURAL_CHECKS, marts(spark, sf)
    named: dict[str, list[str]] = {}
    for check in checks:
        for table, column in ((check.table, check.column), (check.to, check.field)):
            if table and column not in named.setdefault(table, []):
                named[table].append(column)
    written: dict[str, DataFrame] = {}

    def check(some: list) -> list[Row]:
        return op.quality_report(spark, written, some).collect() if some else []

    def job(name: str) -> list[Row]:
        """Plan and write one table, then run the checks that need no more than what is written before it."""
        model = models[name] if name.startswith("dim_") else models[name].select(named[name])
        written[name] = tb.materialize(model, name, "table", scratch_path(spark, name))
        return check([c for c in checks if c.table == name and (c.to is None or name.startswith("fct_"))])

    early = [n for n in named if not n.startswith("fct_")]
    results = together(spark, {n: lambda n=n: job(n) for n in early}, 8)
    # the facts read the written dimensions
    models.built |= {n: df for n, df in written.items() if n.startswith("dim_")}
    late = {n: lambda n=n: job(n) for n in named if n not in early}
    results |= together(spark, late | {"references": lambda: check([c for c in checks if c.to and c.table in early])}, 8)
    rows = [row for found in results.values() for row in found]
    return spark.createDataFrame(rows, "check_name string, failures bigint, status string")


# ---------------------------------------------------------------- whole builds


#: Model -> what the build's queries add up over its rows.
MEASURES = {
    "dim_customers": "case when is_current then 1 else 0 end",
    "dim_products": "selling_price",
    "dim_stores": "length(store_name)",
    "dim_employees": "length(employee_id)",
    "dim_payment_method": "length(method_name)",
    "dim_date": "date_key",
    "fct_sales": "gross_revenue",
    "fct_payments": "amount_paid",
    "flagged_payments": "amount_paid",
    "fct_inventory_daily": "net_quantity_moved",
    "fct_order_lifecycle": "case when delivered_at > ordered_at then 1 else 0 end",
    "snapshot_customers": "case when dbt_valid_to is null then 1 else 0 end",
    "snapshot_products": "selling_price",
}


def _camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(part.title() for part in rest)


def _land_entities(spark: SparkSession, sf: str, state: ExtractState) -> None:
    """All nine entities as landed pages of one record each, in the order in which a merge prefers rows."""

    def land(entity: str, df: DataFrame) -> None:
        newest = [F.col("updated_at").asc_nulls_last()] if "updated_at" in df.columns else []
        order = newest + [F.col(c).asc_nulls_first() for c in df.columns if c != "updated_at"]
        record = F.to_json(F.struct(*[F.col(c).alias(_camel(c)) for c in df.columns]))
        sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
        sorted_rows.select(F.concat(F.lit('{"data":['), record, F.lit("]}")).alias("value")).write.text(state.landing(entity), compression="gzip")

    together(spark, {e: lambda e=e, df=df: land(e, df) for e, df in dt.raw_tables(spark, sf).items()})


def _digests(spark: SparkSession, state_dir: str, run: int) -> dict[str, Row]:
    """Digest of each model after a run, and of the two histories."""
    tables = {n: spark.table(n) for n in MEASURES if n not in SNAPSHOT_NAMES}
    tables |= {n: read_snapshot(spark, state_dir, e, run) for n, e in SNAPSHOT_NAMES.items()}
    return together(spark, {n: lambda n=n, df=df: op.multiset_digest(df, MEASURES[n]).first() for n, df in tables.items()}, 8)


SNAPSHOT_NAMES = {f"snapshot_{entity}": entity for entity in SNAPSHOTS}


@query("warehouse_build")
def _(spark, sf):
    """Pages of all nine entities, extracted and built: the data tests, and rows and a total of each model and history."""
    lake, state_dir = ExtractState(scratch_path(spark, "landing"), scratch_path(spark, "lake")), scratch_path(spark, "state")
    with shuffles_dropped(spark):
        _land_entities(spark, sf, lake)
        failed = extract_all(spark, dt.raw_tables(spark, sf), lake).filter("status = 'failed'").collect()
        if failed:
            raise RuntimeError(f"not extracted: {failed}")
        report = run_pipeline(spark, f"{lake.lake_dir}/raw", state_dir, scratch_path(spark, "marts"))
        rows = [(f"rows_{n}", d["rows"], "rows", d["total"]) for n, d in _digests(spark, state_dir, 1).items()]
    built = spark.createDataFrame(rows, "check_name string, failures bigint, status string, total decimal(38,2)")
    return report.withColumn("total", F.lit(None).cast("decimal(38,2)")).unionByName(built)


@query("rerun_is_noop")
def _(spark, sf):
    """A second build over the same lake leaves every model and history as it was, by digests of all rows."""
    state_dir, out, runs = scratch_path(spark, "state"), scratch_path(spark, "marts"), []
    with shuffles_dropped(spark):
        lake = _write_lake(spark, sf)
        for run in (1, 2):
            run_pipeline(spark, lake, state_dir, out)
            runs.append(_digests(spark, state_dir, run))
    rows = [(n, d["rows"], d["total"], runs[1][n] != d) for n, d in runs[0].items()]
    return spark.createDataFrame(rows, "model string, rows bigint, total decimal(38,2), changed boolean")


@query("stream_ingest")
def _(spark, sf):
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "table", "checkpoint"))
    pages = dt.landed_pages(spark, sf)
    for load in range(1, dt.LOADS + 1):
        _land(pages, load, landing)
        stream_ingest(spark, landing, table, checkpoint, RECORD).awaitTermination()
    return _event_columns(tb.read_batches(spark, table))


@query("stream_schema_growth")
def _(spark, sf):
    """A stream whose second load has a field more: it becomes a column, NULL where the first load was last."""
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "table", "checkpoint"))
    more = F.replace(F.col("value"), F.lit('"eventId":'), F.lit('"channelNo":7,"eventId":'))
    pages = dt.landed_pages(spark, sf).withColumn("value", F.when(F.col("load") == dt.LOADS, more).otherwise(F.col("value")))
    for load in range(1, dt.LOADS + 1):
        _land(pages, load, landing)
        stream_ingest(spark, landing, table, checkpoint, fn.struct("id string, eventId bigint")).awaitTermination()
    return tb.read_batches(spark, table).select("id", "eventId", "eventType", "large", "channelNo")
