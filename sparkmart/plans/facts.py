"""Fact tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import gross_revenue, hours_between, md5_key, pack_key, to_day, unpack_key
from sparkmart.operators import (
    dedup_latest, filter_positive, group_sum_count, lookup, lookup_current,
)
from sparkmart.operators.calendar import DAY


#: Lays out a fact's rows for where they are written, before the columns that only follow from others are added.
Deal = Callable[[DataFrame], DataFrame]


def _packed(df: DataFrame) -> DataFrame:
    """A dimension's or an order's rows with their keys packed: a fact is shuffled with them several times."""
    return df.withColumns({c: pack_key(c) for c in df.columns if c.endswith("_key")})


def _dealt(keyed: DataFrame, deal: Deal | None) -> DataFrame:
    return deal(keyed) if deal else keyed


def order_keys(
    orders: DataFrame, customers: DataFrame, stores: DataFrame, employees: DataFrame | None = None,
) -> DataFrame:
    """The dimension keys of each order.

    Facts join this once on ``order_id`` in place of one join per dimension: the
    dimensions meet the orders, of which there are far fewer than fact rows, and the
    fact itself is not shuffled by customer, store or employee.
    """
    keyed = lookup_current(orders, customers, "customer_id", ["customer_key"])
    keyed = lookup(keyed, stores, "store_id", ["store_key"])
    names = ["customer_key", "store_key"]
    if employees is not None:
        keyed = lookup(keyed, employees, "employee_id", ["employee_key"])
        names.append("employee_key")
    return keyed.select("order_id", *names)


def fct_sales(
    order_items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame,
    stores: DataFrame, employees: DataFrame, deal: Deal | None = None, keys: DataFrame | None = None,
) -> DataFrame:
    """One row per order line, newest state, with the keys of the current dimensions.

    ``keys`` are the :func:`order_keys`, where they are already written.

    The columns that break ties are all those the fact takes from a line, so lines
    that tie on every one of them give the same fact row whichever is kept.
    """
    ties = ["order_id", "product_id", "quantity", "unit_price", "created_at"]
    lines = dedup_latest(order_items, ["order_item_id"], "updated_at", ties)
    keys = _packed(order_keys(orders, customers, stores, employees) if keys is None else keys)
    # Products first: where they are too many to broadcast, the lines are shuffled without the keys of their orders.
    products = products.withColumn("product_key", pack_key("product_key"))
    keyed = lookup_current(lines, products, "product_id", ["product_key"])
    names = ["customer_key", "product_key", "store_key", "employee_key"]
    keyed = lookup(keyed, keys, "order_id", [n for n in names if n != "product_key"])
    keyed = keyed.select("order_item_id", "order_id", *names, "created_at", "updated_at", "quantity", "unit_price")
    return _dealt(keyed, deal).select(
        md5_key("order_item_id").alias("sales_key"),
        "order_item_id", "order_id",
        *[unpack_key(n).alias(n) for n in names],
        "created_at", "updated_at",
        "quantity", F.col("unit_price").alias("price"),
        gross_revenue("quantity", "unit_price").alias("gross_revenue"),
    )


def fct_payments(
    payments: DataFrame, orders: DataFrame, customers: DataFrame, stores: DataFrame, methods: DataFrame,
    deal: Deal | None = None,
) -> DataFrame:
    """One row per payment whose newest state has an amount above zero.

    Customer and store are those of the order.
    """
    ties = ["order_id", "payment_method_id", "amount_paid", "paid_at", "created_at"]
    newest = dedup_latest(payments, ["payment_id"], "updated_at", ties)
    keyed = lookup(
        filter_positive(newest, "amount_paid"), _packed(order_keys(orders, customers, stores)),
        "order_id", ["customer_key", "store_key"],
    )
    methods = methods.withColumn("payment_method_key", pack_key("payment_method_key"))
    keyed = lookup(keyed, methods, "payment_method_id", ["payment_method_key"])
    names = ["customer_key", "store_key", "payment_method_key"]
    keyed = keyed.select("payment_id", "order_id", *names, "paid_at", "created_at", "updated_at", "amount_paid")
    return _dealt(keyed, deal).select(
        "payment_id", "order_id", *[unpack_key(n).alias(n) for n in names],
        "paid_at", "created_at", "updated_at", "amount_paid",
    )


def flagged_payments(payments: DataFrame) -> DataFrame:
    """Every state of a payment whose amount is zero or less; unknown amounts are in neither list."""
    return payments.filter(F.col("amount_paid") <= 0)


def fct_inventory_daily(movements: DataFrame) -> DataFrame:
    by = {
        "inventory_date": to_day("moved_at"),
        "product_id": F.col("product_id"),
        "store_id": F.col("store_id"),
    }
    return group_sum_count(movements, by, "quantity", "net_quantity_moved", "movement_count")


def fct_order_lifecycle(orders: DataFrame) -> DataFrame:
    """Milestones of an order and the signed hours from each to the next."""
    return orders.select(
        "order_id", "customer_id", "store_id", "employee_id",
        "ordered_at", "paid_at", "shipped_at", "delivered_at",
        hours_between("ordered_at", "paid_at").alias("hours_to_payment"),
        hours_between("paid_at", "shipped_at").alias("hours_to_ship"),
        hours_between("shipped_at", "delivered_at").alias("hours_to_delivery"),
    )


def fact_date_key(fact: DataFrame, dates: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """Adds ``<role>_date_key`` for each {role: date or timestamp column}.

    A day the calendar lacks gives NULL.  A small calendar is broadcast by its size.
    """
    for role, column in roles.items():
        day = f"_{role}_day"
        keyed = lookup(fact.withColumn(day, to_day(column)), dates, (day, DAY), {"date_key": f"{role}_date_key"})
        fact = keyed.drop(day)
    return fact
