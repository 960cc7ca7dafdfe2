"""Column lists and column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions import cast_to

#: Types whose cast follows a rule of its own; all others are plain casts, written as one
#: text per column because plans of wide tables are built from Python call by call.
_RULED = (T.BooleanType, T.IntegerType, T.LongType)
_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def conform_columns(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Exactly the columns of ``schema``: extra ones dropped, missing ones NULL.

    ``strict`` makes a missing column an error.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    if strict and (missing := [f.name for f in schema.fields if f.name not in have]):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    ruled = {
        f.name: cast_to(f"`{f.name}`", have[f.name], f.dataType)
        for f in schema.fields if f.name in have and isinstance(f.dataType, _RULED) and have[f.name] != f.dataType
    }
    return (df.withColumns(ruled) if ruled else df).selectExpr(*[
        f"cast({f'`{f.name}`' if f.name in have else 'null'} as {f.dataType.simpleString()}) as `{f.name}`"
        for f in schema.fields
    ])


def serialize_nested(df: DataFrame) -> DataFrame:
    """Structs, arrays, maps and variants as JSON text; other columns untouched."""
    return df.select(*[
        (F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f"`{f.name}`"))
        for f in df.schema.fields
    ])


def snake_case(name: str) -> str:
    """``updatedAt`` -> ``updated_at``, ``orderID`` -> ``order_id``."""
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"[^A-Za-z0-9]+", "_", name).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    names = [snake_case(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("two columns would get the same name")
    return df.toDF(*names)
