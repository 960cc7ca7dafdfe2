"""Dimensions.  Versioned ones read a snapshot history, the others a staging model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from sparkmart.functions import (
    date_key, date_parts, day_name, is_current, is_weekend, iso_week, surrogate_key,
)
from sparkmart.operators import date_spine
from sparkmart.operators.calendar import DAY
from sparkmart.operators.scd2 import SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO

# The calendar's first and last day.
CALENDAR_START, CALENDAR_END = "2024-01-01", "2027-12-31"


def _versioned(history: DataFrame, key: str, natural: str, unused: tuple[str, ...]) -> DataFrame:
    """Every version gets a key of its own and a plain name for its interval."""
    return (
        history.withColumns({
            key: surrogate_key(natural, VALID_FROM),
            "is_current": is_current(VALID_TO),
        })
        .withColumnsRenamed({VALID_FROM: "valid_from", VALID_TO: "valid_to"})
        .drop(SCD_ID, UPDATED_AT, *unused)
    )


def dim_customers(history: DataFrame) -> DataFrame:
    return _versioned(history, "customer_key", "customer_id", ("is_deleted", "created_at", "updated_at"))


def dim_products(history: DataFrame) -> DataFrame:
    unused = ("effective_from", "is_deleted", "created_at", "updated_at")
    return _versioned(history, "product_key", "product_id", unused)


def dim_stores(stores: DataFrame) -> DataFrame:
    return stores.withColumn("store_key", surrogate_key("store_id"))


def dim_employees(employees: DataFrame) -> DataFrame:
    return employees.withColumn("employee_key", surrogate_key("employee_id")).drop("full_name")


def dim_payment_method(methods: DataFrame) -> DataFrame:
    return methods.withColumn("payment_method_key", surrogate_key("payment_method_id"))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of each ``date_day``."""
    return days.select(
        date_key(DAY).alias("date_key"),
        DAY,
        *[c.alias(name) for name, c in date_parts(DAY).items()],
        iso_week(DAY).alias("week"),
        day_name(DAY).alias("day_of_week"),
        is_weekend(DAY).alias("is_weekend"),
    )


def dim_date(
    spark: SparkSession, start: str | date = CALENDAR_START, end: str | date = CALENDAR_END,
) -> DataFrame:
    return calendar(date_spine(spark, start, end))
