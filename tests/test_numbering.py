import random

import pytest
from pyspark.sql import functions as F

from lading.operators.numbering import assign_batches, number_rows
from lading.operators.spread import hot_keys, spread_join


def test_numbers_match_sorting(spark):
    ids = random.Random(3).sample(range(-(10**15), 10**15), 2000)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    numbered = {r.id: r.row_number for r in number_rows(df, ["id"]).collect()}
    assert numbered == {i: n for n, i in enumerate(sorted(ids), 1)}


def test_numbers_with_repeated_ids(spark):
    rows = [(1, f"n{i:04d}") for i in range(700)] + [(2, "z"), (0, "a")]
    df = spark.createDataFrame(rows, "id long, name string")
    numbered = number_rows(df, ["id", "name"]).orderBy("row_number").collect()
    assert [(r.id, r.name) for r in numbered] == sorted(rows)
    assert [r.row_number for r in numbered] == list(range(1, 703))


def test_frequent_value_fills_several_partitions(spark):
    df = spark.range(4000).select(F.lit(1).alias("id"), F.col("id").alias("other"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered = number_rows(df, ["id"])
        parts = numbered.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(r["count"] for r in parts) < 2000
    assert sorted(r.row_number for r in numbered.collect()) == list(range(1, 4001))


@pytest.mark.parametrize("size", [0, 1])
def test_tiny_inputs(spark, size):
    rows = assign_batches(spark.range(size), ["id"]).collect()
    assert [(r.id, r.batch_id) for r in rows] == [(0, 0)][:size]


def test_batches_of_500(spark):
    df = assign_batches(spark.range(1001).repartition(5), ["id"])
    sizes = {r.batch_id: r["count"] for r in df.groupBy("batch_id").count().collect()}
    assert sizes == {0: 500, 1: 500, 2: 1}
    assert df.filter(F.floor(F.col("id") / 500) != F.col("batch_id")).count() == 0


def test_no_wide_single_partition(spark):
    plan = number_rows(spark.range(100), ["id"])._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step runs over the counts per partition.
    assert plan.count("SinglePartition") == 1
    assert plan.index("SinglePartition") < plan.index("HashAggregate")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("min_rows", [1, 50, 10_000])
def test_spread_join_is_the_plain_join(spark, how, min_rows):
    rows = [(i, 5 if i % 3 else i % 11, None if i % 7 == 0 else "k") for i in range(600)]
    fact = spark.createDataFrame(rows, "n int, a int, b string")
    lookup = spark.createDataFrame(
        [(a, b, f"{a}{b}") for a in range(0, 9) for b in ("k", None)], "a int, b string, v string"
    )
    hot = hot_keys(fact, ["a", "b"], min_rows)
    joined = spread_join(fact, lookup, ["a", "b"], hot, ["n"], how, salts=4)
    expected = fact.join(
        lookup.withColumnsRenamed({"a": "a2", "b": "b2"}),
        F.col("a").eqNullSafe(F.col("a2")) & F.col("b").eqNullSafe(F.col("b2")),
        how,
    ).select("n", "a", "b", "v")
    assert sorted(map(str, joined.collect())) == sorted(map(str, expected.collect()))


def test_hot_rows_are_spread(spark):
    fact = spark.range(5000).select("id", F.lit(1).alias("k"))
    lookup = spark.createDataFrame([(1, "x")], "k int, v string")
    hot = hot_keys(fact, ["k"], 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(fact, lookup, ["k"], hot, ["id"])
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(per_task) == 4
    assert max(r["count"] for r in per_task) < 2500
