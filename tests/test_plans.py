"""What the plans of the operators have to look like, and that hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sparkmart import operators as op
from sparkmart import registry
from sparkmart.sources.watermark import filter_updated_after

SF = "/root/testdata/sf0.001"
EAGER = {  # These write tables on the way; their parts are checked on their own.
    "extract_entity", "extract_summary", "write_table", "source_table", "materialize",
    "warehouse_build", "rerun_is_noop", "stream_ingest",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - EAGER))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_sales_fact_plan(spark):
    df = registry._staged(spark, SF)["fct_sales"]
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert text.count("WindowGroupLimit") >= 4  # before and after the exchange
    schema = next(s for s in re.findall(r"ReadSchema: struct<(.*)>", text) if "l_orderkey" in s)
    assert "l_discount" not in schema and "l_tax" not in schema and "l_comment" not in schema
    orders = next(s for s in re.findall(r"ReadSchema: struct<(.*)>", text) if "o_orderkey" in s)
    assert orders == "o_orderkey:bigint,o_custkey:bigint"


def test_filters_reach_the_scan(spark, scratch):
    path = scratch("t")
    spark.sql("select id, timestamp '2024-01-01' as updated_at from range(3)").write.parquet(path)
    newer = filter_updated_after(spark.read.parquet(path), "2024-01-01T00:00:00Z", "updated_at")
    assert "PushedFilters: [Or(GreaterThanOrEqual(updated_at,2024-01-01 00:00:00.0),IsNull(updated_at))]" in plan(newer)

    fact = spark.range(3).select(F.col("id").cast("string").alias("k"))
    current = op.lookup_current(fact, spark.read.parquet(_versions(spark, scratch)), ("k", "key"), ["name"])
    assert "PushedFilters: [IsNull(valid_to), IsNotNull(key)]" in plan(current)


def _versions(spark, scratch):
    path = scratch("versions")
    spark.sql("select cast(id as string) as key, 'n' as name, cast(null as timestamp_ntz) as valid_to from range(3)").write.parquet(path)
    return path


@pytest.fixture
def small_partitions(spark):
    """Thresholds scaled down so that test data counts as large."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_of_a_lookup_is_split(spark, small_partitions):
    n = 90_000
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    fact = spark.range(0, n, 1, 16).select(hot.alias("k"), F.md5(F.col("id").cast("string")).alias("payload"))
    dim = spark.range(-1, n, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = op.lookup(fact, dim, "k", ["v"])
    # The observed frame itself is run, so its plan is the final one.
    rows = joined.collect()
    assert len(rows) == n and all(r.v == 2 * r.k for r in rows)
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_of_a_lookup_are_salted_alone_without_adaptive_execution(spark):
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
    fact = spark.range(0, n, 1, 16).select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("payload"))
    dim = spark.range(-1, n, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        def largest(joined):
            assert joined.count() == n and joined.filter("v <> 2 * k").count() == 0 and joined.filter("v is null").count() == n // 3
            return joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert op.hot_keys(fact, "k", 2_000) == {-1: 10, None: 10} and op.hot_keys(fact, "k") == {}
        plain, salted = op.lookup(fact, dim, "k", ["v"]), op.lookup(fact, dim, "k", ["v"], salt="hot", task_rows=2_000)
        assert largest(plain) > n // 3 and largest(salted) < n // 5
        assert salted.columns == plain.columns and op.lookup(fact, dim, "k", ["v"], salt="hot").count() == n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_reaches_the_dedup_reducer_as_one_row_per_map_task(spark):
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"),
    )
    newest = op.dedup_latest(df, ["k"], "t")
    assert len(newest.collect()) == 20_001
    metrics = _exchange_rows(newest)
    assert metrics == 20_000 + 6


def _exchange_rows(df):
    """Rows written by the only shuffle of a plan that was run."""
    node = df._jdf.queryExecution().executedPlan().executedPlan()
    open_nodes = [node]
    while open_nodes:
        node = open_nodes.pop()
        if node.nodeName() == "Exchange":
            return node.metrics().apply("shuffleRecordsWritten").value()
        if "QueryStage" in node.nodeName():
            open_nodes.append(node.plan())
            continue
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
    raise AssertionError("no exchange")
