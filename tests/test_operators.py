import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import ts, tuples
from sparkmart import functions as fn
from sparkmart import operators as op
from sparkmart.plans import dimensions as dims


def test_dedup_takes_newest_and_null_counts_as_newest(spark):
    df = spark.createDataFrame([
        ("a", ts("2024-01-01"), 1), ("a", ts("2024-01-03"), 2), ("b", None, 3), ("b", ts("2024-01-09"), 4),
    ], "k string, t timestamp_ntz, v int")
    assert tuples(op.dedup_latest(df, ["k"], "t"), "k", "v") == [("a", 2), ("b", 3)]


def test_dedup_ties_do_not_depend_on_partitions(spark):
    rows = [("a", ts("2024-01-01"), v, str(v % 3)) for v in range(50)]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v int, w string").repartition(seed + 1)
        results.add(tuple(tuples(op.dedup_latest(df, ["k"], "t"))))
        assert tuples(op.dedup_latest(df, ["k"], "t", ["w", "v"]), "v") == [(47,)]
    assert results == {(("a", ts("2024-01-01"), 49, "1"),)}


def test_filter_positive_after_dedup(spark):
    df = spark.createDataFrame([("p", ts("2024-01-01"), 5), ("p", ts("2024-01-02"), -5), ("q", ts("2024-01-01"), None)],
                               "k string, t timestamp_ntz, amount int")
    assert op.filter_positive(op.dedup_latest(df, ["k"], "t"), "amount").count() == 0


@pytest.fixture
def facts_and_dims(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "a")], "n int, k string")
    dim = spark.createDataFrame([("a", "A1", ts("2024-01-01")), ("a", "A2", None), ("b", "B1", ts("2024-01-01"))],
                                "id string, name string, valid_to timestamp_ntz")
    return fact, dim


@pytest.mark.parametrize("salt", [1, 5])
def test_lookup_keeps_unmatched_and_fans_out_on_duplicates(facts_and_dims, salt):
    fact, dim = facts_and_dims
    got = op.lookup(fact, dim, ("k", "id"), {"name": "found"}, salt=salt)
    assert got.columns == ["n", "k", "found"]
    assert tuples(got, "n", "found") == [(1, "A1"), (1, "A2"), (2, "B1"), (3, None), (4, None), (5, "A1"), (5, "A2")]


@pytest.mark.parametrize("salt", [1, 3])
def test_current_lookup_uses_open_versions_only(facts_and_dims, salt):
    fact, dim = facts_and_dims
    got = op.lookup_current(fact, dim, ("k", "id"), ["name"], salt=salt)
    assert tuples(got, "n", "name") == [(1, "A2"), (2, None), (3, None), (4, None), (5, "A2")]


def test_salted_lookup_of_a_hot_key_is_whole(spark):
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    dim = fact.select("k").distinct().withColumn("v", F.upper("k"))
    plain, salted = (op.lookup(fact.repartition(7), dim, "k", ["v"], salt=s) for s in (1, 4))
    assert salted.count() == 3000 and plain.exceptAll(salted).count() == 0


def test_group_sum_count(spark):
    df = spark.createDataFrame([(ts("2024-01-01 05:00"), 2), (ts("2024-01-01 23:00"), -5), (ts("2024-01-02"), None)], "t timestamp_ntz, q bigint")
    got = op.group_sum_count(df, {"d": fn.to_day("t")}, "q", "total", "n")
    assert tuples(got) == [(date(2024, 1, 1), -3, 2), (date(2024, 1, 2), None, 1)]


def test_date_spine_and_calendar(spark):
    days = dims.dim_date(spark)
    assert days.count() == 1461
    assert tuples(days.agg(F.min("date_key"), F.max("date_key"))) == [(20240101, 20271231)]
    df = spark.createDataFrame([(ts("2024-02-27 10:00"), ts("2024-03-01 09:00"))], "a timestamp_ntz, b timestamp_ntz")
    assert op.date_spine_over(df, "a", "b").count() == 4


def test_conform_columns(spark):
    df = spark.createDataFrame([(1.5, "x", "on")], "n double, extra string, flag string")
    schema = T.StructType.fromDDL("n int, flag boolean, absent decimal(12,2)")
    assert tuples(op.conform_columns(df, schema)) == [(2, True, None)]
    with pytest.raises(ValueError, match="absent"):
        op.conform_columns(df, schema, strict=True)


def test_serialize_nested_and_snake_case(spark):
    df = spark.sql("select 1 as orderID, named_struct('k', 1) as theProps, array(1, 2) as `Tag List`, parse_json('{\"b\": 2}') as v")
    got = op.snake_case_columns(op.serialize_nested(df))
    assert got.columns == ["order_id", "the_props", "tag_list", "v"]
    assert tuples(got) == [(1, '{"k":1}', "[1,2]", '{"b":2}')]
    with pytest.raises(ValueError):
        op.snake_case_columns(spark.sql("select 1 as aB, 2 as a_b"))


# ---------------------------------------------------------------- upsert and merge

BATCH = "id string, v int, updated_at string, _page int, _pos int"


def test_upsert_last_written_wins_over_newer_timestamp(spark):
    target = spark.createDataFrame([("a", 1, "2024-01-01"), ("keep", 9, "2024-01-01")], "id string, v int, updated_at string")
    batch = spark.createDataFrame([
        ("a", 2, "2024-05-01", 1, 0), ("a", 3, "2023-01-01", 2, 0), ("b", 4, "2024-01-01", 1, 1), ("b", 5, "2024-01-01", 1, 2),
    ], BATCH)
    once = op.upsert_by_key(target, batch)
    assert tuples(once) == [("a", 3, "2023-01-01"), ("b", 5, "2024-01-01"), ("keep", 9, "2024-01-01")]
    assert tuples(op.upsert_by_key(once, batch)) == tuples(once)


def test_upsert_keeps_columns_the_batch_lacks_and_adds_new_ones(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("c", 2, "y")], "id string, v int, old string")
    batch = spark.createDataFrame([("a", 7, True), ("b", 8, False)], "id string, v int, new boolean")
    got = op.upsert_by_key(target, batch)
    assert tuples(got, "id", "v", "old", "new") == [("a", 7, "x", True), ("b", 8, None, False), ("c", 2, "y", None)]
    replaced = op.merge_by_key(target, batch)
    assert tuples(replaced, "id", "v", "old", "new") == [("a", 7, None, True), ("b", 8, None, False), ("c", 2, "y", None)]


def test_missing_key_fails_the_batch(spark):
    batch = spark.createDataFrame([(None, 1)], "id string, v int")
    for write in (op.upsert_by_key, op.merge_by_key):
        with pytest.raises(Exception, match="NULL in key column id"):
            write(None, batch).collect()


def test_upsert_random_batches_match_a_dict(spark):
    rng = random.Random(5)
    target, expected = None, {}
    for _ in range(3):
        rows = [(str(rng.randrange(12)), rng.randrange(1000), "t", page, pos) for page in range(3) for pos in range(6)]
        for key, v, *_ in rows:
            expected[key] = v
        rng.shuffle(rows)
        target = op.upsert_by_key(target, spark.createDataFrame(rows, BATCH))
    assert dict(tuples(target, "id", "v")) == expected


def test_merge_is_idempotent_and_sorts_duplicates(spark):
    batch = spark.createDataFrame([("a", 1, ts("2024-01-02")), ("a", 2, ts("2024-01-01")), ("b", 3, None)], "id string, v int, t timestamp_ntz")
    once = op.merge_by_key(None, batch, ["id"], "t")
    assert tuples(once, "id", "v") == [("a", 1), ("b", 3)]
    assert tuples(op.merge_by_key(once, batch, ["id"], "t")) == tuples(once)


# ---------------------------------------------------------------- quality

def test_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert tuples(op.check_unique(df, "k")) == [("a", 2)]
    assert op.check_not_null(df, "k").count() == 2
    assert tuples(op.check_relationships(df, "k", parent, "k")) == [("b", 1)]


def test_quality_report_counts_failures(spark):
    tables = {
        "child": spark.createDataFrame([(1, "a"), (1, "x"), (2, "x"), (None, None), (3, "b")], "id int, ref string"),
        "parent": spark.createDataFrame([("a", 1), ("b", 2)], "key string, n int"),
        "other": spark.createDataFrame([("x",)], "key string"),
    }
    checks = [
        op.Check("child", "id", "unique"), op.Check("child", "id", "not_null"),
        op.Check("child", "ref", "relationships", "parent", "key"), op.Check("child", "ref", "relationships", "other", "key"),
        op.Check("child", "ref", "not_null"), op.Check("parent", "n", "unique"),
    ]
    assert {r.check_name: (r.failures, r.status) for r in op.quality_report(spark, tables, checks).collect()} == {
        "unique_child_id": (1, "fail"), "not_null_child_id": (1, "fail"),
        "relationships_child_ref_parent_key": (2, "fail"), "relationships_child_ref_other_key": (2, "fail"),
        "not_null_child_ref": (1, "fail"), "unique_parent_n": (0, "pass"),
    }
    assert op.quality_report(spark, tables, []).count() == 0


def test_quality_report_of_empty_tables_passes(spark):
    empty = spark.createDataFrame([], "id int")
    report = op.quality_report(spark, {"t": empty}, [op.Check("t", "id", "unique"), op.Check("t", "id", "not_null")])
    assert tuples(report, "failures", "status") == [(0, "pass"), (0, "pass")]


def test_money_type_of_revenue(spark):
    df = spark.sql("select 2 as q, cast(1.10 as decimal(12,2)) as p").select(fn.gross_revenue("q", "p").alias("r"))
    assert df.schema["r"].dataType == T.DecimalType(18, 2) and df.first()[0] == Decimal("2.20")
