"""Staging models: one typed projection per raw entity.

Types come from the entity's schema; a model only says what it renames and adds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from sparkmart.functions import clean_phone, full_name
from sparkmart.operators import conform_columns
from sparkmart.sources.schemas import RAW_SCHEMAS


def _stage(
    raw: DataFrame, entity: str, renames: Mapping[str, str], computed: Mapping[str, Column] | None = None,
) -> DataFrame:
    typed = conform_columns(raw, RAW_SCHEMAS[entity], strict=True)
    return typed.withColumnsRenamed(dict(renames)).withColumns(dict(computed or {}))


def stg_customers(raw: DataFrame) -> DataFrame:
    return _stage(raw, "customers", {"id": "customer_id"}, {
        "full_name": full_name("first_name", "last_name"),
        "phone": clean_phone("phone"),
    })


def stg_products(raw: DataFrame) -> DataFrame:
    return _stage(raw, "products", {"id": "product_id", "name": "product_name"})


def stg_stores(raw: DataFrame) -> DataFrame:
    return _stage(raw, "stores", {"id": "store_id", "name": "store_name"})


def stg_employees(raw: DataFrame) -> DataFrame:
    return _stage(raw, "employees", {"id": "employee_id"}, {"full_name": full_name("first_name", "last_name")})


def stg_orders(raw: DataFrame) -> DataFrame:
    return _stage(raw, "orders", {"id": "order_id"})


def stg_order_items(raw: DataFrame) -> DataFrame:
    return _stage(raw, "order_items", {"id": "order_item_id"})


def stg_payments(raw: DataFrame) -> DataFrame:
    return _stage(raw, "payments", {"id": "payment_id"})


def stg_payment_methods(raw: DataFrame) -> DataFrame:
    return _stage(raw, "payment_methods", {"id": "payment_method_id", "name": "method_name"})


#: Entity -> staging model.  Inventory movements are used as they arrive.
STAGING: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": stg_customers,
    "products": stg_products,
    "stores": stg_stores,
    "employees": stg_employees,
    "orders": stg_orders,
    "order_items": stg_order_items,
    "payments": stg_payments,
    "payment_methods": stg_payment_methods,
}
