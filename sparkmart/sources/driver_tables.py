"""The nine raw entities, derived from the order-processing tables of the test data.

The expressions are plain SQL that Spark and DuckDB read alike, so that queries and
their oracles start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_1, BATCH_2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def text(expression: str) -> str:
    return f"cast({expression} as string)"


CUSTOMERS = {
    "id": text("c_custkey"),
    "team_id": text("c_nationkey % 3"),
    "first_name": "substr(c_name, 1, 8)",
    "last_name": "substr(c_name, 10)",
    "email": f"concat('c', {text('c_custkey')}, '@mail.example')",
    "phone": f"concat('555/', {text('c_nationkey')}, '-', {text('c_custkey')})",
    "segment": "c_mktsegment",
    "tier": "case when c_acctbal >= 5000 then 'gold' else 'basic' end",
    "address": f"concat({text('c_custkey')}, ' Main Street')",
    "city": f"concat('City ', {text('c_nationkey')})",
    "state": text("c_nationkey % 5"),
    "effective_from": "'2023-06-01 00:00:00'",
    "registered_at": "'2023-06-01 08:30:00'",
    "is_deleted": "case when c_acctbal < 0 then 'true' else 'false' end",
    "created_at": "'2023-06-01 08:30:00'",
    "updated_at": f"'{BATCH_1}'",
}
#: Customers of the second batch whose row has changed.
CUSTOMER_CHANGED = "c_acctbal >= 9000"
CUSTOMERS_2 = CUSTOMERS | {
    "tier": f"case when {CUSTOMER_CHANGED} then 'vip' else ({CUSTOMERS['tier']}) end",
    "updated_at": f"case when {CUSTOMER_CHANGED} then '{BATCH_2}' else '{BATCH_1}' end",
}

PRODUCTS = {
    "id": text("p_partkey"),
    "team_id": text("p_size % 3"),
    "sku": f"concat('SKU-', {text('p_partkey')})",
    "name": "p_name",
    "category": "p_type",
    "sub_category": text("p_size"),
    "brand": "p_brand",
    "supplier": text("p_partkey % 100"),
    "cost_price": "p_retailprice",
    "selling_price": "cast(p_retailprice as decimal(12,2))",
    "effective_from": "'2023-06-01 00:00:00'",
    "is_deleted": "'false'",
    "created_at": "'2023-06-01 08:30:00'",
    "updated_at": f"'{BATCH_1}'",
}
PRODUCT_CHANGED = "p_size > 40"
PRODUCTS_2 = PRODUCTS | {
    "selling_price": f"cast(p_retailprice as decimal(12,2)) + case when {PRODUCT_CHANGED} then 1.00 else 0.00 end",
    "updated_at": f"case when {PRODUCT_CHANGED} then '{BATCH_2}' else '{BATCH_1}' end",
}

STORES = {
    "id": text("n_nationkey"),
    "team_id": text("n_nationkey % 3"),
    "name": "n_name",
    "city": "n_name",
    "state": "r_name",
    "address": f"concat({text('n_nationkey')}, ' Market Square')",
    "phone": f"concat('555-', {text('n_nationkey')})",
    "manager_name": f"concat('Manager ', {text('n_nationkey')})",
    "opened_date": "'2020-05-17'",
    "created_at": "'2023-06-01 08:30:00'",
    "updated_at": f"'{BATCH_1}'",
}

EMPLOYEES = {
    "id": text("s_suppkey"),
    "team_id": text("s_nationkey % 3"),
    "store_id": text("s_nationkey"),
    "first_name": "case when s_suppkey % 10 = 3 then null else 'Sam' end",
    "last_name": "s_name",
    "email": f"concat('e', {text('s_suppkey')}, '@mail.example')",
    "role": "case when s_acctbal > 5000 then 'manager' else 'clerk' end",
    "hired_date": "'2022-02-28'",
    "is_deleted": "'false'",
    "created_at": "'2023-06-01 08:30:00'",
    "updated_at": f"'{BATCH_1}'",
}

#: Over orders with the first and last shipping day of their lines.
ORDERS = {
    "id": text("o_orderkey"),
    "team_id": text("o_custkey % 3"),
    "customer_id": text("o_custkey"),
    "store_id": text("o_custkey % 27"),
    "employee_id": text("o_orderkey % 12"),
    "status": "o_orderstatus",
    "discount_code": "case when o_orderkey % 4 = 0 then 'SPRING' end",
    "discount_amount": "case when o_orderkey % 4 = 0 then 5.00 else 0.00 end",
    "total_amount": "o_totalprice",
    "ordered_at": "o_orderdate",
    "paid_at": "first_ship",
    "shipped_at": "last_ship",
    "delivered_at": "case when o_orderstatus = 'F' then last_ship + interval 3 days end",
    "cancelled_at": "cast(null as string)",
    "created_at": "o_orderdate",
    "updated_at": "o_orderdate",
}

ORDER_ITEMS = {
    "id": f"concat({text('l_orderkey')}, '-', {text('l_linenumber')})",
    "team_id": text("l_suppkey % 3"),
    "order_id": text("l_orderkey"),
    "product_id": text("l_partkey"),
    "quantity": "l_quantity",
    "unit_price": "l_extendedprice",
    "discount_pct": "l_discount",
    "line_total": "l_extendedprice",
    "created_at": "l_shipdate - interval 2 days",
    "updated_at": "l_shipdate",
}

PAYMENTS = {
    "id": f"concat({text('user_id')}, '-', {text('cast(ts as date)')})",
    "team_id": text("user_id % 3"),
    "order_id": text("event_id"),
    "customer_id": text("user_id"),
    "payment_method_id": text("event_id % 6"),
    "amount_paid": "case when event_type = 'error' then -value else value end",
    "currency": "'EUR'",
    "status": "event_type",
    "payment_type": "case when event_id % 2 = 0 then 'card' else 'cash' end",
    "reference": "props",
    "paid_at": "ts",
    "created_at": "ts",
    "updated_at": "ts",
}

PAYMENT_METHODS = {
    "id": text("r_regionkey"),
    "team_id": text("r_regionkey % 3"),
    "name": "r_name",
    "provider": f"concat('Bank ', {text('r_regionkey')})",
    "is_digital": "case when r_regionkey % 2 = 0 then 'yes' else 'no' end",
    "created_at": "'2023-06-01 08:30:00'",
    "updated_at": f"'{BATCH_1}'",
}

INVENTORY_MOVEMENTS = {
    "id": f"concat({text('l_orderkey')}, '-', {text('l_linenumber')})",
    "product_id": text("l_partkey"),
    "store_id": text("l_suppkey % 25"),
    "quantity": "cast(case when l_returnflag = 'R' then l_quantity else -l_quantity end as bigint)",
    "moved_at": "l_shipdate",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as {name}" for name, e in expressions.items()])


class _RawTables(Mapping[str, DataFrame]):
    """The nine entities by name, each derived when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def _read(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def _shipped_orders(self) -> DataFrame:
        shipped = self._read("lineitem").groupBy("l_orderkey").agg(
            F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
        )
        return self._read("orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")

    def _nations(self) -> DataFrame:
        return self._read("nation").join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")

    def __getitem__(self, entity: str) -> DataFrame:
        rows, expressions = _ENTITIES[entity]
        return project(rows(self), expressions)

    def __iter__(self) -> Iterator[str]:
        return iter(_ENTITIES)

    def __len__(self) -> int:
        return len(_ENTITIES)


def _rows(name: str) -> Callable[[_RawTables], DataFrame]:
    return lambda tables: tables._read(name)


_ENTITIES: dict[str, tuple[Callable[[_RawTables], DataFrame], dict[str, str]]] = {
    "customers": (_rows("customer"), CUSTOMERS),
    "products": (_rows("part"), PRODUCTS),
    "stores": (_RawTables._nations, STORES),
    "employees": (_rows("supplier"), EMPLOYEES),
    "orders": (_RawTables._shipped_orders, ORDERS),
    "order_items": (_rows("lineitem"), ORDER_ITEMS),
    "payments": (_rows("events"), PAYMENTS),
    "payment_methods": (_rows("region"), PAYMENT_METHODS),
    "inventory_movements": (_rows("lineitem"), INVENTORY_MOVEMENTS),
}


def raw_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """All nine entities; customers and products as of their first batch."""
    return _RawTables(spark, sf_dir)


def second_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers and products a month later: whole tables, some rows changed."""
    return {
        "customers": project(table(spark, sf_dir, "customer"), CUSTOMERS_2),
        "products": project(table(spark, sf_dir, "part"), PRODUCTS_2),
    }


RECORDS_PER_PAGE = 100


LOADS = 2


def landed_pages(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    """``events`` as pages of JSON text: ``load`` (when it lands), ``_page``, ``value``,
    and the ``by`` columns.

    The records sit under each known name in turn, one page in four is a bare list.
    """
    from .pages import ENVELOPES

    events = table(spark, sf_dir, "events")
    time = F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))
    zone = F.when(F.col("event_id") % 2 == 0, F.lit("Z")).otherwise(F.lit("+00:00"))
    record = F.struct(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("id"),
        F.col("event_id").alias("eventId"),
        F.col("event_type").alias("eventType"),
        F.col("value"),
        (F.col("value") > 50).alias("large"),
        F.from_json("props", "k int").alias("props"),
        F.concat(time, zone).alias("updatedAt"),
    )
    # An event's number is its own, so a page has no more than its hundred records.
    page = F.floor(F.col("event_id") / RECORDS_PER_PAGE).cast("bigint")
    position = (F.col("event_id") % RECORDS_PER_PAGE).alias("pos")
    listed = F.array_sort(F.collect_list(F.struct(position, F.to_json(record).alias("r"))))
    body = F.concat(F.lit("["), F.array_join(F.transform(listed, lambda x: x["r"]), ","), F.lit("]"))
    data, items, results = ENVELOPES
    more = F.lit('"meta":{"has_more":true,"cursor":"next"}}')
    turn = F.col("_page") % 4
    value = (
        F.when(turn == 0, F.concat(F.lit(f'{{"{data}":'), "body", F.lit(","), more))
        .when(turn == 1, F.concat(F.lit(f'{{"{data}":[],"{items}":'), "body", F.lit(","), more))
        .when(turn == 2, F.concat(F.lit(f'{{"{results}":'), "body", F.lit(","), more))
        .otherwise(F.col("body"))
    )
    load = (F.col("_page") % LOADS + 1).alias("load")
    pages = events.groupBy(*by, page.alias("_page")).agg(body.alias("body"))
    return pages.select(*by, load, "_page", value.alias("value"))
