"""Typed casts that keep PostgreSQL's meaning where Spark's own differs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PERCENT = T.DecimalType(8, 2)
NUMERIC = T.DecimalType(38, 18)

# The words Spark's own text-to-boolean cast does not know.
TRUE_WORDS = ["on"]
FALSE_WORDS = ["off", "of"]

_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_text(c: Column | str) -> Column:
    return _col(c).cast("string")


def cast_int(c: Column | str, source: T.DataType | None = None) -> Column:
    """Integer; a fractional ``source`` type is rounded half away from zero, not cut."""
    column = _col(c)
    if source is not None and isinstance(source, _FRACTIONAL):
        column = F.round(column, 0)
    return column.cast("int")


def cast_money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def cast_pct(c: Column | str) -> Column:
    return _col(c).cast(PERCENT)


def cast_bool(c: Column | str, source: T.DataType | None = None) -> Column:
    """Boolean; text may also say on/off.  Any other word raises (ANSI)."""
    column = _col(c)
    if source is not None and not isinstance(source, T.StringType):
        return column.cast("boolean")
    word = F.lower(F.trim(column.cast("string")))
    return (
        F.when(word.isin(TRUE_WORDS), F.lit(True))
        .when(word.isin(FALSE_WORDS), F.lit(False))
        .otherwise(word.cast("boolean"))
    )


def cast_date(c: Column | str) -> Column:
    return _col(c).cast("date")


def cast_ts(c: Column | str) -> Column:
    """Timestamp without zone; an offset written in the text is ignored."""
    return _col(c).cast("timestamp_ntz")


def cast_to(c: Column | str, source: T.DataType, target: T.DataType) -> Column:
    """Cast by the target type, choosing among the builders above."""
    if isinstance(target, T.BooleanType):
        return cast_bool(c, source)
    if isinstance(target, T.IntegerType):
        return cast_int(c, source)
    if isinstance(target, T.LongType) and isinstance(source, _FRACTIONAL):
        return F.round(_col(c), 0).cast("bigint")
    return _col(c).cast(target)
