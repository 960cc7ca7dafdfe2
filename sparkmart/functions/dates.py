"""Calendar functions and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import cast_date, cast_ts

MICROS_PER_HOUR = 3.6e9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(c: Column | str) -> Column:
    return cast_date(c)


def date_key(c: Column | str) -> Column:
    """20240131 for 2024-01-31."""
    day = cast_date(c)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_parts(c: Column | str) -> dict[str, Column]:
    day = cast_date(c)
    return {"year": F.year(day), "quarter": F.quarter(day), "month": F.month(day)}


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(cast_date(c))


def day_name(c: Column | str) -> Column:
    """English day name, unpadded."""
    return F.date_format(cast_date(c), "EEEE")


def is_weekend(c: Column | str) -> Column:
    return F.weekday(cast_date(c)) >= 5


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Signed hours from start to end; NULL if either is NULL."""
    return F.timestamp_diff("MICROSECOND", cast_ts(start), cast_ts(end)) / F.lit(MICROS_PER_HOUR)


def utc_ntz(c: Column | str) -> Column:
    """The UTC wall clock of an instant, whatever the session time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(c)), epoch)
