import hashlib
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ts, tuples
from sparkmart import operators as op

SCHEMA = "id string, tier string, updated_at timestamp_ntz"
SHOWN = ("id", "tier", "dbt_valid_from", "dbt_valid_to")
D1, D2, D3 = ts("2024-01-01"), ts("2024-02-01"), ts("2024-03-01")


@pytest.fixture
def rows(spark):
    return lambda *r: spark.createDataFrame(list(r), SCHEMA)


def apply(history, batch, **options):
    return op.scd2_apply(history, batch, "id", **options)


def test_first_run_inserts_everything(rows):
    history = apply(None, rows(("a", "basic", D1), ("n", "x", None)))
    row = history.filter("id = 'a'").first()
    assert row.dbt_scd_id == hashlib.md5(b"a|2024-01-01 00:00:00").hexdigest()
    assert row.dbt_updated_at == row.dbt_valid_from == D1 and row.dbt_valid_to is None
    assert tuples(history, *SHOWN) == [("a", "basic", D1, None), ("n", "x", None, None)]


def test_new_key_is_inserted_and_missing_key_stays(rows):
    history = apply(apply(None, rows(("a", "basic", D1))), rows(("b", "basic", D2)))
    assert tuples(history, *SHOWN) == [("a", "basic", D1, None), ("b", "basic", D2, None)]


def test_newer_row_closes_and_opens(rows):
    history = apply(apply(None, rows(("a", "basic", D1))), rows(("a", "gold", D2)))
    assert tuples(history, *SHOWN) == [("a", "basic", D1, D2), ("a", "gold", D2, None)]
    third = apply(history, rows(("a", "vip", D3)))
    assert tuples(third, *SHOWN) == [("a", "basic", D1, D2), ("a", "gold", D2, D3), ("a", "vip", D3, None)]


@pytest.mark.parametrize("when", [D1, ts("2023-01-01"), None])
def test_equal_older_or_undated_row_changes_nothing(rows, when):
    first = apply(None, rows(("a", "basic", D1)))
    assert tuples(apply(first, rows(("a", "changed", when)))) == tuples(first)


def test_undated_open_row_is_never_replaced(rows):
    first = apply(None, rows(("a", "basic", None)))
    assert tuples(apply(first, rows(("a", "gold", D2)))) == tuples(first)


def test_duplicate_in_batch(rows):
    batch = rows(("a", "basic", D1), ("a", "gold", D2))
    assert tuples(apply(None, batch), *SHOWN) == [("a", "gold", D2, None)]
    with pytest.raises(Exception, match="duplicate id"):
        apply(None, batch, on_duplicate="error").collect()
    assert apply(None, rows(("a", "x", D1), ("b", "x", D1)), on_duplicate="error").count() == 2
    with pytest.raises(ValueError):
        apply(None, batch, on_duplicate="first")


def test_new_column_is_null_for_old_rows_and_lost_column_for_new(spark, rows):
    first = apply(None, rows(("a", "basic", D1), ("c", "basic", D1)))
    wider = spark.createDataFrame([("a", D2, 5)], "id string, updated_at timestamp_ntz, points int")
    history = apply(first, wider)
    assert tuples(history, "id", "tier", "points", "dbt_valid_to") == [
        ("a", "basic", None, D2), ("a", None, 5, None), ("c", "basic", None, None),
    ]


def test_rerun_changes_nothing(rows):
    batch = rows(("a", "gold", D2), ("b", "basic", D1), (None, "x", D1))
    once = apply(apply(None, rows(("a", "basic", D1))), batch)
    assert tuples(apply(once, batch)) == tuples(once)


def test_fold_over_batches_equals_closed_form(spark):
    rng = random.Random(3)
    log = [(f"k{k}", str(rng.random()), ts(f"2024-01-{day:02d} 0{rng.randrange(10)}:00")) for day in range(1, 8) for k in range(9) if rng.random() < 0.6]
    history = None
    for day in range(1, 8):
        history = apply(history, spark.createDataFrame([r for r in log if r[2].day == day], SCHEMA))
    closed = op.scd2_from_log(spark.createDataFrame(log, SCHEMA), "id", "updated_at")
    columns = ("id", "tier", "updated_at", "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")
    assert tuples(history, *columns) == tuples(closed, *columns)

    # Invariants: one open version per key, intervals meet end to start.
    assert history.filter("dbt_valid_to is null").groupBy("id").count().filter("count > 1").count() == 0
    assert history.filter("dbt_valid_to <= dbt_valid_from").count() == 0
    starts = history.select("id", F.col("dbt_valid_from").alias("dbt_valid_to"))
    assert history.filter("dbt_valid_to is not null").join(starts, ["id", "dbt_valid_to"], "left_anti").count() == 0


def test_ranges_of_a_hot_key_give_the_same_history(spark):
    rng = random.Random(3)
    keys, day = ["hot"] * 6 + ["warm"] * 2 + [None] * 3 + ["cold", "x", "y"], datetime(2024, 1, 1)
    rows = [(rng.choice(keys), str(rng.randrange(4)), rng.choice([None] + [day + timedelta(seconds=rng.randrange(900))] * 20)) for _ in range(1500)]
    log = spark.createDataFrame([*rows, *rows[:50], *[("hot", "9", day)] * 300], SCHEMA)
    whole = tuples(op.scd2_from_log(log, "id", "updated_at"))
    assert len(whole) > 1000
    for task_rows in (40, 200):
        assert tuples(op.scd2_from_log(log, "id", "updated_at", task_rows=task_rows)) == whole
    sliced = op.scd2_from_log(log, "id", "updated_at", task_rows=40)
    assert "hashpartitioning(id#" in sliced._jdf.queryExecution().toString() and "_part" in sliced._jdf.queryExecution().toString()
    assert not re.search("Cartesian|BroadcastNestedLoop", sliced._jdf.queryExecution().toString())


def test_closed_form_within_and_across_days_with_equal_instants(spark):
    log = spark.createDataFrame([
        ("a", "1", ts("2024-01-01 01:00")), ("a", "2", ts("2024-01-01 05:00")), ("a", "3", ts("2024-01-09 00:00")),
        ("a", "9", ts("2024-01-01 05:00")), ("b", "1", ts("2024-01-01 00:00")),
    ], SCHEMA)
    assert tuples(op.scd2_from_log(log, "id", "updated_at"), *SHOWN) == [
        ("a", "1", ts("2024-01-01 01:00"), ts("2024-01-01 05:00")), ("a", "3", ts("2024-01-09"), None),
        ("a", "9", ts("2024-01-01 05:00"), ts("2024-01-09")), ("b", "1", ts("2024-01-01"), None),
    ]
