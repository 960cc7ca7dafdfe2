import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import ts
from sparkmart import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize("value, kind, expected", [
    (3.7, T.DoubleType(), 4), (-2.5, T.DoubleType(), -3), (2.5, T.DoubleType(), 3), (7, T.LongType(), 7), ("12", T.StringType(), 12),
])
def test_int_rounds_half_away_from_zero(spark, value, kind, expected):
    assert one(spark, fn.cast_int(F.lit(value).cast(kind), kind)) == expected


def test_int_of_fractional_text_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fn.cast_int(text("3.7"), T.StringType()))


def test_money_and_percent_round_half_up_and_raise_on_overflow(spark):
    assert one(spark, fn.cast_money(text("1.005"))) == Decimal("1.01")
    assert one(spark, fn.cast_pct(text("-0.125"))) == Decimal("-0.13")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        one(spark, fn.cast_money(text("12345678901.00")))


@pytest.mark.parametrize("word, expected", [
    ("on", True), ("OFF", False), (" yes ", True), ("n", False), ("1", True), ("0", False), ("t", True), (None, None),
])
def test_bool_words(spark, word, expected):
    assert one(spark, fn.cast_bool(text(word), T.StringType())) is expected


def test_bool_of_other_word_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fn.cast_bool(text("maybe"), T.StringType()))


def test_timestamp_text_with_offset_keeps_its_wall_clock(spark):
    assert one(spark, fn.cast_ts(text("2024-05-01T10:00:00+02:00"))) == ts("2024-05-01 10:00")


def test_text_of_timestamp_drops_trailing_zeros(spark):
    assert one(spark, fn.cast_text(text("2024-01-01 00:00:00.500").cast("timestamp_ntz"))) == "2024-01-01 00:00:00.5"


@pytest.mark.parametrize("first, last, expected", [("Ann", "Lee", "Ann Lee"), (None, "Lee", " Lee"), ("Ann", None, "Ann "), (None, None, " ")])
def test_full_name_keeps_the_space(spark, first, last, expected):
    assert one(spark, fn.full_name(text(first), text(last))) == expected


def test_phone_loses_slashes_and_dashes_only(spark):
    assert one(spark, fn.clean_phone(text("+1/555-12-34 x"))) == "+15551234 x"


def md5(value):
    return hashlib.md5(value.encode()).hexdigest()


def test_keys(spark):
    assert one(spark, fn.md5_key(text(None))) == md5("")
    assert one(spark, fn.surrogate_key(text("a"), text(None), F.lit(3))) == md5("a||3")
    assert one(spark, fn.surrogate_key(text(""), text("b"))) == one(spark, fn.surrogate_key(text(None), text("b")))
    # A part that holds the separator can collide; known and kept.
    assert one(spark, fn.surrogate_key(text("a|b"), text("c"))) == one(spark, fn.surrogate_key(text("a"), text("b|c")))


@pytest.mark.parametrize("day, key, week, name, weekend", [
    ("2027-01-01", 20270101, 53, "Friday", False), ("2024-12-30", 20241230, 1, "Monday", False),
    ("2024-02-29", 20240229, 9, "Thursday", False), ("2026-01-04", 20260104, 1, "Sunday", True),
])
def test_calendar(spark, day, key, week, name, weekend):
    d = text(day).cast("date")
    row = spark.range(1).select(fn.date_key(d), fn.iso_week(d), fn.day_name(d), fn.is_weekend(d), *fn.date_parts(d).values()).first()
    y, m, _ = map(int, day.split("-"))
    assert tuple(row) == (key, week, name, weekend, y, (m + 2) // 3, m)


def test_to_day_of_zoned_text(spark):
    assert one(spark, fn.to_day(text("2024-03-05T23:30:00Z"))) == date(2024, 3, 5)


@pytest.mark.parametrize("a, b, hours", [
    ("2024-01-01 00:00:00", "2024-01-01 01:30:00", 1.5), ("2024-01-02 00:00:00", "2024-01-01 00:00:00", -24.0),
    (None, "2024-01-01 00:00:00", None), ("2024-01-01 00:00:00", None, None),
])
def test_hours_between(spark, a, b, hours):
    assert one(spark, fn.hours_between(text(a), text(b))) == hours


def test_gross_revenue_ratio_and_current(spark):
    assert one(spark, fn.gross_revenue(F.lit(3), text("2.50").cast("decimal(12,2)"))) == Decimal("7.50")
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.is_current(text(None))) is True


def test_utc_ntz_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, fn.utc_ntz(text("2024-03-10T07:30:00Z").cast("timestamp"))) == ts("2024-03-10 07:30")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_struct_reads_types():
    schema = fn.struct("a string, b decimal(12,2), c timestamp_ntz")
    assert schema["b"].dataType == T.DecimalType(12, 2) and schema["c"].dataType == T.TimestampNTZType()


def test_packed_keys_are_half_as_long_and_come_back(spark):
    keys = [None, "", "k1", "ab", "AB", "abc", "0a1b", "d41d8cd98f00b204e9800998ecf8427e", "\u00e9", "\x01", "zz"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", fn.pack_key("k").alias("p"))
    got = {r.k: (r.p, r.u) for r in df.select("k", "p", fn.unpack_key("p").alias("u")).collect()}
    assert all(got[k][1] == k for k in keys) and len(got[keys[7]][0]) == 17
