"""Measures and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_current(valid_to: Column | str) -> Column:
    return _col(valid_to).isNull()


def gross_revenue(quantity: Column | str, price: Column | str) -> Column:
    """Quantity times unit price, before any discount."""
    return (_col(quantity) * _col(price)).cast("decimal(18,2)")


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double; NULL where b is zero."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))
