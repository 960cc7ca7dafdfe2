"""Columns of the nine raw entities and the types their staging models give them."""

from __future__ import annotations

from sparkmart.functions import struct

# Entity names, column names and types of the source system.
_DDL = {
    "customers": (
        "id string, team_id string, first_name string, last_name string, email string, phone string, "
        "segment string, tier string, address string, city string, state string, "
        "effective_from timestamp_ntz, registered_at timestamp_ntz, is_deleted boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "products": (
        "id string, team_id string, sku string, name string, category string, sub_category string, "
        "brand string, supplier string, cost_price decimal(12,2), selling_price decimal(12,2), "
        "effective_from timestamp_ntz, is_deleted boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "stores": (
        "id string, team_id string, name string, city string, state string, address string, phone string, "
        "manager_name string, opened_date date, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "employees": (
        "id string, team_id string, store_id string, first_name string, last_name string, email string, "
        "role string, hired_date date, is_deleted boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "orders": (
        "id string, team_id string, customer_id string, store_id string, employee_id string, status string, "
        "discount_code string, discount_amount decimal(12,2), total_amount decimal(12,2), "
        "ordered_at timestamp_ntz, paid_at timestamp_ntz, shipped_at timestamp_ntz, "
        "delivered_at timestamp_ntz, cancelled_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "order_items": (
        "id string, team_id string, order_id string, product_id string, quantity int, "
        "unit_price decimal(12,2), discount_pct decimal(8,2), line_total decimal(12,2), "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "payments": (
        "id string, team_id string, order_id string, customer_id string, payment_method_id string, "
        "amount_paid decimal(12,2), currency string, status string, payment_type string, reference string, "
        "paid_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "payment_methods": (
        "id string, team_id string, name string, provider string, is_digital boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "inventory_movements": (
        "id string, product_id string, store_id string, quantity bigint, moved_at timestamp_ntz"
    ),
}

ENTITIES = tuple(_DDL)
RAW_SCHEMAS = {name: struct(ddl) for name, ddl in _DDL.items()}
