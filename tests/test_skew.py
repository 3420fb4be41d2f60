from __future__ import annotations

import random

import pytest
from helpers import assert_same_rows, rows
from pyspark.sql import functions as F

from chirplake.operators import balance, skew


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows have one key, a tenth another, and the rest are spread over many."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, "warm")
    key = key.otherwise(F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(9_000))))
    frame = spark.range(0, 60_000, 1, 7).select("id", key.alias("key"))
    return frame.withColumn("key", F.when(F.col("id") % 999 != 0, F.col("key")))


@pytest.mark.parametrize("tracked", [3_000, 400])
def test_bounds_hold_and_no_heavy_key_is_missed(spark, skewed, tracked):
    share = 0.02
    found = {r["key"]: r for r in skew.heavy_keys(skewed, "key", share, tracked).collect()}
    true = dict(rows(skewed.where("key is not null").groupBy("key").count()))
    total = sum(true.values())
    assert {key for key, n in true.items() if n >= share * total} <= set(found)
    assert len(found) < 1 / (share - 3.5 / 512) + 1
    for key, row in found.items():
        assert row["at_least"] <= true[key] <= row["at_most"] and row["rows"] == total


def test_shares_below_the_error_are_refused(spark, skewed):
    with pytest.raises(ValueError, match="shares above"):
        skew.heavy_keys(skewed, "key", 0.003, 400)


def test_no_rows_no_heavy_keys(spark, skewed):
    assert skew.heavy_keys(skewed.limit(0), "key", 0.1).collect() == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_the_join(spark, skewed, how):
    small = skewed.where("id % 3 = 0").groupBy("key").agg(F.count("*").alias("n"))
    twice = small.unionByName(small.limit(50))
    assert_same_rows(
        skew.salted_join(skewed, twice, "key", how).select("id", "key", "n"),
        skewed.join(twice, "key", how).select("id", "key", "n"),
    )


def test_salted_join_spreads_the_hot_key_and_repeats_no_other(spark, skewed):
    small = skewed.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(skewed, small, "key", salts=16)
        largest = balance.partition_costs(joined, F.lit(1)).agg(F.max("cost")).first()[0]
        plain = balance.partition_costs(skewed.join(small, "key"), F.lit(1)).agg(F.max("cost")).first()[0]
        assert plain > 30_000 - 100 and largest < 18_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Generate" in plan and "'hot'" not in plan.split("Generate")[0].split("SortMergeJoin")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_planned_partitions_are_those_of_a_shuffle(spark, skewed):
    planned = dict(rows(skew.partition_sizes(skewed, "key", 8)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        moved = skewed.repartition(8, "key").groupBy(F.spark_partition_id().alias("p")).count()
        assert planned == dict(rows(moved))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_length_quantiles_are_near_the_ranks(spark):
    frame = spark.range(0, 100_000, 1, 5)
    found = dict(rows(skew.length_quantiles(frame, F.col("id"), (0.1, 0.5, 0.99))))
    assert all(abs(value / 100_000 - share) < 0.03 for share, value in found.items())


def test_partitions_of_equal_cost(spark):
    rng = random.Random(3)
    lengths = [rng.choice((1, 2, 5, 400)) if i < 3_000 else 1 for i in range(12_000)]
    frame = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "id int, text string")
    cost = F.octet_length("text")
    cut = balance.by_cost(frame, cost, 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        costs = [r["cost"] for r in balance.partition_costs(cut, cost).collect()]
        assert len(costs) == 16 and max(costs) <= 1.2 * sum(lengths) / 16
        by_rows = [r["cost"] for r in balance.partition_costs(frame.repartition(16), cost).collect()]
        unmoved = [r["cost"] for r in balance.partition_costs(frame, cost).collect()]
        assert max(unmoved) > 2 * sum(lengths) / len(unmoved) and sum(by_rows) == sum(lengths)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert cut.columns == frame.columns
    assert_same_rows(cut, frame)


def test_costs_that_are_missing_or_nothing(spark):
    frame = spark.createDataFrame([(1, None), (2, 0), (3, None)], "id int, cost int")
    assert_same_rows(balance.by_cost(frame, F.col("cost"), 4), frame)
    frame = spark.createDataFrame([(1, None), (2, 7), (3, -5)], "id int, cost int")
    assert_same_rows(balance.by_cost(frame, F.col("cost"), 4), frame)
    assert balance.by_cost(frame.limit(0), F.col("cost"), 4).collect() == []
