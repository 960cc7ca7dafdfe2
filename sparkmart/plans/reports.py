"""Reports over the marts.

``marts`` holds tables by model name.  Measures are summed per order or per key before
any name is joined, so the joins see one row per order and not one per line.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import ratio, to_day
from sparkmart.operators import lookup
from sparkmart.operators.calendar import DAY

Marts = Mapping[str, DataFrame]

MONEY = "decimal(38,2)"


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def _per_order(sales: DataFrame, *by: str) -> DataFrame:
    """Revenue per order and the given keys."""
    return sales.groupBy("order_id", *by).agg(_money(F.sum("gross_revenue")).alias("revenue"))


def _revenue(c: str = "revenue") -> Column:
    return _money(F.sum(c)).alias("revenue")


def _orders() -> Column:
    return F.count_distinct("order_id").alias("orders")


def _order_rows() -> Column:
    """Orders where each is one row by now."""
    return F.count("order_id").alias("orders")


def kpi_summary(marts: Marts) -> DataFrame:
    """Revenue, orders, customers and average order value in one row."""
    # An order has one customer, so it is one row per order with the customer carried along.
    per_order = marts["fct_sales"].groupBy("order_id").agg(
        _money(F.sum("gross_revenue")).alias("revenue"), F.max("customer_key").alias("customer_key"),
    )
    totals = per_order.agg(_revenue(), _order_rows(), F.count_distinct("customer_key").alias("customers"))
    return totals.withColumn("average_order_value", ratio("revenue", "orders"))


def revenue_by_store(marts: Marts) -> DataFrame:
    per_order = _per_order(marts["fct_sales"], "store_key")
    return lookup(per_order, marts["dim_stores"], "store_key", ["store_name"]).groupBy("store_name").agg(
        _revenue(), _orders()
    )


def revenue_by_product(marts: Marts) -> DataFrame:
    per_product = marts["fct_sales"].groupBy("product_key").agg(
        _revenue("gross_revenue"), F.sum("quantity").cast("bigint").alias("quantity")
    )
    named = lookup(per_product, marts["dim_products"], "product_key", ["product_id", "product_name", "category"])
    return named.groupBy("product_id", "product_name", "category").agg(
        _revenue(), F.sum("quantity").cast("bigint").alias("quantity")
    )


def revenue_trend(marts: Marts) -> DataFrame:
    """Revenue per day, beside that of its month.

    Year and month are those of the day itself, so a day outside the calendar has no
    ``date_key`` but keeps its month.
    """
    per_day = marts["fct_sales"].groupBy(to_day("created_at").alias("sold_on")).agg(_revenue("gross_revenue"))
    keyed = lookup(per_day, marts["dim_date"], ("sold_on", DAY), ["date_key"])
    keyed = keyed.withColumns({"year": F.year("sold_on"), "month": F.month("sold_on")})
    month = Window.partitionBy("year", "month")
    return keyed.select(
        "date_key", "year", "month", "revenue", _money(F.sum("revenue").over(month)).alias("month_revenue"),
    )


def top_customers(marts: Marts, n: int = 10) -> DataFrame:
    per_customer = (
        _per_order(marts["fct_sales"], "customer_key").filter(F.col("customer_key").isNotNull())
        .groupBy("customer_key").agg(_revenue(), _order_rows())
    )
    best = per_customer.orderBy(F.desc("revenue"), "customer_key").limit(n)
    return lookup(best, marts["dim_customers"], "customer_key", ["customer_id", "full_name"])


def customer_growth(marts: Marts) -> DataFrame:
    """Customers by the month of their first order, and the running total."""
    first = (
        marts["fct_sales"].filter(F.col("customer_key").isNotNull())
        .groupBy("customer_key").agg(F.min("created_at").alias("first_at"))
    )
    months = first.groupBy(F.date_format(to_day("first_at"), "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("new_customers")
    )
    # One row per month by now: the single partition of this window is the calendar.
    running = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return months.withColumn("total_customers", F.sum("new_customers").over(running))


def _per_method(marts: Marts) -> DataFrame:
    return marts["fct_payments"].groupBy("payment_method_key").agg(
        F.count(F.lit(1)).alias("payments"), _money(F.sum("amount_paid")).alias("amount"),
    )


def payment_method_mix(marts: Marts) -> DataFrame:
    """Payments, amount and share of the amount per method."""
    named = lookup(_per_method(marts), marts["dim_payment_method"], "payment_method_key", ["method_name"])
    per_name = named.groupBy("method_name").agg(
        F.sum("payments").alias("payments"), _money(F.sum("amount")).alias("amount"),
    )
    # One row per method name: the whole-table window sees only those.
    total = _money(F.sum("amount").over(Window.partitionBy()))
    return per_name.withColumn("amount_share", ratio("amount", total))


def payment_performance(marts: Marts) -> DataFrame:
    """Per method: amount, mean hours from order to payment, flagged payments."""
    # Counted per order and method first: an order with very many payments is one row
    # when it meets its durations.
    per_order = marts["fct_payments"].groupBy("order_id", "payment_method_key").agg(
        F.count(F.lit(1)).alias("n"), _money(F.sum("amount_paid")).alias("amount"),
    )
    paid = lookup(per_order, marts["fct_order_lifecycle"], "order_id", ["hours_to_payment"])
    hours = F.col("hours_to_payment")
    by_method = paid.groupBy("payment_method_key").agg(
        _money(F.sum("amount")).alias("amount"),
        F.try_divide(F.sum(hours * F.col("n")), F.sum(F.when(hours.isNotNull(), F.col("n")))).alias("mean_hours_to_payment"),
    )
    flagged = marts["flagged_payments"].groupBy("payment_method_id").agg(F.count(F.lit(1)).alias("flagged"))
    methods = marts["dim_payment_method"].select("payment_method_key", "payment_method_id", "method_name")
    report = lookup(methods, by_method, "payment_method_key", ["amount", "mean_hours_to_payment"])
    report = lookup(report, flagged, "payment_method_id", ["flagged"])
    return report.select(
        "payment_method_id", "method_name", "amount", "mean_hours_to_payment",
        F.coalesce("flagged", F.lit(0)).cast("bigint").alias("flagged"),
    )


def inventory_monitor(marts: Marts) -> DataFrame:
    """Running net stock of a product in a store.

    The fact has one row per day, so a product and store have no more rows than the
    calendar has days.
    """
    running = (
        Window.partitionBy("product_id", "store_id").orderBy("inventory_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return marts["fct_inventory_daily"].select(
        "inventory_date", "product_id", "store_id", "net_quantity_moved",
        F.sum("net_quantity_moved").over(running).cast("bigint").alias("net_stock"),
    )


def store_performance(marts: Marts) -> DataFrame:
    """Per store: revenue, orders, mean hours to delivery."""
    per_store = _per_order(marts["fct_sales"], "store_key").groupBy("store_key").agg(_revenue(), _order_rows())
    delivery = marts["fct_order_lifecycle"].groupBy("store_id").agg(
        F.avg("hours_to_delivery").alias("mean_hours_to_delivery")
    )
    report = lookup(marts["dim_stores"].select("store_key", "store_id", "store_name"), per_store, "store_key", ["revenue", "orders"])
    report = lookup(report, delivery, "store_id", ["mean_hours_to_delivery"])
    return report.select(
        "store_id", "store_name", "revenue", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
        "mean_hours_to_delivery",
    )
