"""Schemas written as text, readable before a session exists."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_SIMPLE = {
    t.simpleString(): t
    for t in (
        T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.DoubleType(),
        T.DateType(), T.TimestampType(), T.TimestampNTZType(),
    )
}


def struct(columns: str) -> T.StructType:
    """``"id string, price decimal(12,2)"`` as a schema."""
    fields = []
    for column in re.split(r",\s+", columns):
        name, kind = column.split()
        decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
        data_type = T.DecimalType(*map(int, decimal.groups())) if decimal else _SIMPLE[kind]
        fields.append(T.StructField(name, data_type))
    return T.StructType(fields)
