"""Facts, reports and the whole build on a small hand-made shop."""

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import ts, tuples
from sparkmart import functions as fn
from sparkmart.plans import dimensions as dims
from sparkmart.plans import facts, reports, staging, warehouse
from sparkmart.sources.extract import ExtractState, extract_all
from sparkmart.sources.schemas import RAW_SCHEMAS


def table(spark, entity, *rows):
    """Rows given by the columns that matter; all others are NULL."""
    schema = RAW_SCHEMAS[entity]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows], schema)


D = Decimal


@pytest.fixture
def raw(spark):
    day = ts("2024-03-01")
    return {
        "customers": table(spark, "customers", {"id": "c1", "first_name": "Ann", "phone": "1/2-3", "updated_at": day}, {"id": "c2", "updated_at": day}),
        "products": table(spark, "products", {"id": "p1", "name": "Pen", "updated_at": day}),
        "stores": table(spark, "stores", {"id": "s1", "name": "North", "updated_at": day}, {"id": "s2", "name": "South", "updated_at": day}),
        "employees": table(spark, "employees", {"id": "e1", "first_name": "Sam", "updated_at": day}),
        "orders": table(
            spark, "orders",
            {"id": "o1", "customer_id": "c1", "store_id": "s1", "employee_id": "e1", "ordered_at": day, "paid_at": ts("2024-03-01 06:00")},
            {"id": "o2", "customer_id": "c2", "store_id": "nowhere", "ordered_at": day, "paid_at": ts("2024-02-29")},
            {"id": "o3"},
        ),
        "order_items": table(
            spark, "order_items",
            {"id": "i1", "order_id": "o1", "product_id": "p1", "quantity": 2, "unit_price": D("1.50"), "created_at": day, "updated_at": day},
            {"id": "i1", "order_id": "o1", "product_id": "p1", "quantity": 3, "unit_price": D("1.50"), "created_at": day, "updated_at": ts("2024-03-02")},
            {"id": "i2", "order_id": "o2", "product_id": "p?", "quantity": 1, "unit_price": D("4.00"), "created_at": day, "updated_at": None},
            {"id": "i2", "order_id": "o2", "product_id": "p1", "quantity": 9, "unit_price": D("4.00"), "created_at": day, "updated_at": day},
            {"id": "i3", "order_id": None, "quantity": None, "unit_price": D("1.00"), "created_at": ts("2024-04-05"), "updated_at": day},
        ),
        "payments": table(
            spark, "payments",
            {"id": "x1", "order_id": "o1", "payment_method_id": "m1", "amount_paid": D("5.00"), "updated_at": day, "created_at": day, "customer_id": "c2"},
            {"id": "x2", "order_id": "o1", "payment_method_id": "m1", "amount_paid": D("5.00"), "updated_at": day, "created_at": day},
            {"id": "x2", "order_id": "o1", "payment_method_id": "m1", "amount_paid": D("-5.00"), "updated_at": ts("2024-03-09"), "created_at": day},
            {"id": "x3", "order_id": "o2", "payment_method_id": "m?", "amount_paid": D("0.00"), "updated_at": day, "created_at": day},
            {"id": "x4", "order_id": "o2", "payment_method_id": "m2", "amount_paid": None, "updated_at": day, "created_at": day},
            {"id": "x5", "order_id": "gone", "payment_method_id": "m?", "amount_paid": D("2.00"), "updated_at": day, "created_at": day},
        ),
        "payment_methods": table(spark, "payment_methods", {"id": "m1", "name": "Card"}, {"id": "m2", "name": "Cash"}),
        "inventory_movements": table(
            spark, "inventory_movements",
            {"id": "v1", "product_id": "p1", "store_id": "s1", "quantity": 5, "moved_at": ts("2024-03-01 23:59")},
            {"id": "v2", "product_id": "p1", "store_id": "s1", "quantity": -2, "moved_at": ts("2024-03-01 01:00")},
            {"id": "v3", "product_id": "p1", "store_id": "s1", "quantity": -4, "moved_at": ts("2024-03-02")},
        ),
    }


@pytest.fixture
def marts(spark, raw):
    return warehouse.Models(spark, raw)


def key_of(spark, *parts):
    return spark.range(1).select(fn.surrogate_key(*[F.lit(p) for p in parts])).first()[0]


def test_staging_needs_all_columns(raw):
    with pytest.raises(ValueError, match="status"):
        staging.stg_orders(raw["orders"].drop("status"))
    assert [len(model(raw[e]).columns) for e, model in staging.STAGING.items()] == [17, 14, 11, 12, 16, 10, 13, 7]


def test_column_counts_of_the_marts(marts):
    expected = {
        "dim_customers": 18, "dim_products": 14, "dim_stores": 12, "dim_employees": 12, "dim_payment_method": 8, "dim_date": 8,
        "fct_sales": 12, "fct_payments": 9, "flagged_payments": 13, "fct_inventory_daily": 5, "fct_order_lifecycle": 11,
    }
    assert {name: len(marts[name].columns) for name in expected} == expected


def test_sales_keep_newest_line_and_unmatched_keys(spark, marts):
    got = {r.order_item_id: r for r in marts["fct_sales"].collect()}
    assert set(got) == {"i1", "i2", "i3"}
    assert (got["i1"].quantity, got["i1"].price, got["i1"].gross_revenue) == (3, D("1.50"), D("4.50"))
    assert got["i1"].customer_key == key_of(spark, "c1", "2024-03-01 00:00:00")
    assert got["i1"].store_key == key_of(spark, "s1") and got["i1"].employee_key == key_of(spark, "e1")
    # The line without a time counts as the newest; its product is unknown.
    assert (got["i2"].quantity, got["i2"].product_key, got["i2"].store_key) == (1, None, None)
    assert got["i2"].customer_key is not None and got["i3"].customer_key is None and got["i3"].gross_revenue is None


def test_sales_use_the_current_version_of_a_customer(spark, raw, marts):
    changed = raw["customers"].filter("id = 'c1'").withColumn("updated_at", F.lit("2024-05-01").cast("timestamp_ntz"))
    history = warehouse.scd2_apply(marts.history("customers"), staging.stg_customers(changed), "customer_id")
    models = warehouse.Models(spark, raw, {"customers": history, "products": marts.history("products")})
    assert models["dim_customers"].count() == 3
    assert models["fct_sales"].filter("order_item_id = 'i1'").first().customer_key == key_of(spark, "c1", "2024-05-01 00:00:00")
    assert models["fct_sales"].count() == 3


def test_payments_and_flagged(spark, marts):
    got = {r.payment_id: r for r in marts["fct_payments"].collect()}
    # x2's newest state is negative, x3 is zero, x4 is unknown.
    assert set(got) == {"x1", "x5"}
    assert got["x1"].customer_key == key_of(spark, "c1", "2024-03-01 00:00:00")  # the order's customer, not the payment's
    assert (got["x5"].customer_key, got["x5"].payment_method_key) == (None, None)
    assert tuples(marts["flagged_payments"], "payment_id") == [("x2",), ("x3",)]


def test_duplicate_order_fans_the_fact_out(spark, raw):
    raw = raw | {"orders": raw["orders"].unionAll(raw["orders"].filter("id = 'o1'"))}
    assert warehouse.Models(spark, raw)["fct_sales"].count() == 4


def test_lifecycle_and_inventory(marts):
    hours = {r.order_id: (r.hours_to_payment, r.hours_to_ship) for r in marts["fct_order_lifecycle"].collect()}
    assert hours == {"o1": (6.0, None), "o2": (-24.0, None), "o3": (None, None)}
    assert tuples(marts["fct_inventory_daily"], "net_quantity_moved", "movement_count") == [(-4, 1), (3, 2)]
    stock = {str(r.inventory_date): r.net_stock for r in reports.inventory_monitor(marts).collect()}
    assert stock == {"2024-03-01": 3, "2024-03-02": -1}


def test_date_keys_by_role(marts):
    keyed = facts.fact_date_key(marts["fct_order_lifecycle"], marts["dim_date"].filter("date_key <> 20240229"), {"ordered": "ordered_at", "paid": "paid_at"})
    assert tuples(keyed, "order_id", "ordered_date_key", "paid_date_key") == [
        ("o1", 20240301, 20240301), ("o2", 20240301, None), ("o3", None, None),
    ]


def test_reports(marts):
    kpi = reports.kpi_summary(marts).first()
    assert (kpi.revenue, kpi.orders, kpi.customers, kpi.average_order_value) == (D("8.50"), 2, 2, 4.25)
    assert tuples(reports.revenue_by_store(marts)) == [("North", D("4.50"), 1), (None, D("4.00"), 1)]
    assert [r.customer_id for r in reports.top_customers(marts, 1).collect()] == ["c1"]
    assert tuples(reports.customer_growth(marts)) == [("2024-03", 2, 2)]
    assert tuples(reports.revenue_trend(marts)) == [
        (20240301, 2024, 3, D("8.50"), D("8.50")), (20240405, 2024, 4, None, None),
    ]
    mix = {r.method_name: (r.payments, r.amount) for r in reports.payment_method_mix(marts).collect()}
    assert mix == {"Card": (1, D("5.00")), None: (1, D("2.00"))}
    performance = {r.payment_method_id: (r.amount, r.mean_hours_to_payment, r.flagged) for r in reports.payment_performance(marts).collect()}
    assert performance == {"m1": (D("5.00"), 6.0, 1), "m2": (None, None, 0)}
    stores = {r.store_id: (r.revenue, r.orders) for r in reports.store_performance(marts).collect()}
    assert stores == {"s1": (D("4.50"), 1), "s2": (None, 0)}


def test_two_stores_of_one_name_count_an_order_once(spark, marts, raw):
    renamed = raw | {"stores": raw["stores"].withColumn("name", F.lit("Same"))}
    assert tuples(reports.revenue_by_store(warehouse.Models(spark, renamed))) == [("Same", D("4.50"), 1), (None, D("4.00"), 1)]


# ---------------------------------------------------------------- the whole build


def write_lake(raw, path, **changed):
    for entity, df in (raw | changed).items():
        df.write.mode("overwrite").parquet(f"{path}/{entity}")


def test_build_twice_and_then_with_changes(spark, raw, scratch):
    lake, state, out = scratch("lake"), scratch("state"), scratch("out")
    write_lake(raw, lake)
    report = warehouse.run_pipeline(spark, lake, state, out)
    assert report.count() == 18 and tuples(report.select("status").distinct()) == [("pass",)]
    first = {t: tuples(spark.table(t)) for t in warehouse.MODELS if t != "dim_date"}
    # The lake has duplicate lines and payments; the merge has left one of each.
    assert spark.table("stg_order_items").count() == 3

    warehouse.run_pipeline(spark, lake, state, out)
    assert {t: tuples(spark.table(t)) for t in first} == first
    assert warehouse.last_run(spark, state) == 2

    # A changed customer, and a store that is gone from the lake.
    changed = raw["customers"].filter("id = 'c1'").withColumns({
        "updated_at": F.lit("2024-05-01").cast("timestamp_ntz"), "tier": F.lit("gold"),
    })
    write_lake({}, lake, customers=changed, stores=raw["stores"].filter("id = 's1'"))
    warehouse.run_pipeline(spark, lake, state, out)
    assert spark.table("dim_stores").count() == 2
    versions = spark.table("dim_customers").filter("customer_id = 'c1'")
    assert tuples(versions, "tier", "valid_to") == [("gold", None), (None, ts("2024-05-01"))]
    closed = spark.read.parquet(f"{state}/snapshots/customers").filter("state = 'closed'")
    assert closed.count() == 1

    batch_only = warehouse.run_pipeline(spark, lake, state, out, read_from="batch")
    assert batch_only.count() == 18 and spark.table("dim_stores").count() == 1


def test_a_build_that_died_is_repeated_under_its_number(spark, raw, scratch):
    lake, state, out = scratch("lake"), scratch("state"), scratch("out")
    write_lake(raw, lake)
    broken = scratch("broken")
    write_lake(raw, broken, payments=raw["payments"].drop("amount_paid"))
    with pytest.raises(ValueError, match="amount_paid"):
        warehouse.run_pipeline(spark, broken, state, out)
    assert warehouse.last_run(spark, state) == 0
    assert warehouse.run_pipeline(spark, lake, state, out).filter("status = 'fail'").count() == 0
    assert warehouse.last_run(spark, state) == 1
    assert spark.table("fct_sales").count() == 3


def camel(name):
    first, *rest = name.split("_")
    return first + "".join(part.title() for part in rest)


def test_build_from_landed_pages(spark, raw, scratch):
    """Pages of all nine entities, extracted and built, twice: the same marts as from plain tables."""
    plain, state = scratch("plain"), ExtractState(scratch("landing"), scratch("lake"))
    for entity, df in raw.items():
        keyed = df.dropDuplicates(["id"])
        keyed.write.parquet(f"{plain}/{entity}")
        record = F.to_json(F.struct(*[F.col(c).alias(camel(c)) for c in keyed.columns]))
        spark.read.parquet(f"{plain}/{entity}").select(F.concat(F.lit('{"data":['), record, F.lit("]}"))).write.text(state.landing(entity))
    warehouse.run_pipeline(spark, plain, scratch("state"), scratch("out"))
    want = {t: tuples(spark.table(t)) for t in ("fct_sales", "fct_payments", "dim_customers", "fct_inventory_daily")}
    place, out = scratch("state"), scratch("out")
    for _ in range(2):
        assert extract_all(spark, raw, state).filter("status = 'failed'").count() == 0
        assert warehouse.run_pipeline(spark, f"{state.lake_dir}/raw", place, out).filter("status = 'fail'").count() == 0
        assert {t: tuples(spark.table(t)) for t in want} == want
    # The log is folded once: the second run has found no new batch and written no rows, and models read the fold.
    versions = {p.name for p in (Path(place) / "raw").glob("*/rows/v=*")}
    assert versions == {"v=1"}
    assert all("/raw/orders/rows/v=1/" in f and place in f for f in spark.table("stg_orders").inputFiles())
    warehouse.run_pipeline(spark, f"{state.lake_dir}/raw", place, out, days=("2024-03-01", "2024-03-31"), date_keys=True)
    assert tuples(spark.table("fct_sales"), "order_item_id", "sold_date_key")[0] == ("i1", 20240301)
    assert {"ordered_date_key", "shipped_date_key"} <= set(spark.table("fct_order_lifecycle").columns)


def test_days_outside_the_calendar_keep_their_month(spark):
    sales = spark.createDataFrame([("2022-01-05", "10.00"), ("2022-01-06", "1.00"), ("2023-05-01", "5.00")], "d string, r string").select(
        F.col("d").cast("timestamp_ntz").alias("created_at"), F.col("r").cast("decimal(12,2)").alias("gross_revenue"))
    trend = reports.revenue_trend({"fct_sales": sales, "dim_date": dims.dim_date(spark)})
    assert tuples(trend.filter("date_key is null"), "year", "month", "revenue", "month_revenue") == [
        (2022, 1, D("1.00"), D("11.00")), (2022, 1, D("10.00"), D("11.00")), (2023, 5, D("5.00"), D("5.00"))]


def test_a_table_is_written_as_its_last_step_leaves_it(spark, scratch):
    from sparkmart.sources.tables import materialize

    written = materialize(spark.range(30, numPartitions=3), "thirty", "table", scratch("thirty"))
    assert len(written.inputFiles()) == 3 and written.count() == 30


def test_lines_meet_products_before_they_carry_the_keys_of_their_orders(spark):
    from sparkmart.plans import facts
    from sparkmart.sources.schemas import RAW_SCHEMAS

    lines, orders = (spark.createDataFrame([], RAW_SCHEMAS[e]).withColumnRenamed("id", k) for e, k in (("order_items", "order_item_id"), ("orders", "order_id")))
    dim = lambda name: spark.createDataFrame([], f"{name}_id string, {name}_key string, valid_to timestamp_ntz")
    fact = facts.fct_sales(lines, orders, dim("customer"), dim("product"), dim("store"), dim("employee"))
    joins = [line for line in fact._jdf.queryExecution().analyzed().toString().splitlines() if "Join LeftOuter" in line]
    assert "order_id" in joins[0] and "product_id" in joins[1]
