from __future__ import annotations

import os
import time

from helpers import assert_same_rows, rows
from pyspark.sql import functions as F

from chirplake.sources import compaction

SCHEMA = "n bigint, mention string, at timestamp"


def part(spark, start, n, mention="@m"):
    return spark.range(start, start + n, 1, 2).select(
        F.col("id").alias("n"),
        F.lit(mention).alias("mention"),
        F.timestamp_seconds(F.col("id")).alias("at"),
    )


def test_copies_grow_with_the_logarithm(spark, tmp_path):
    path, rewritten = str(tmp_path / "t"), 0
    for arrival in range(30):
        part(spark, arrival * 10, 10).write.mode("append").parquet(path)
        before = dict(compaction.copies_of(spark, path))
        assert compaction.compact_table(spark, path, 10**9)
        after = compaction.copies_of(spark, path)
        rewritten += sum(size for copy, size in after if copy not in before)
        sizes = [size for _, size in after]
        assert len(sizes) <= (arrival + 1).bit_length()
        assert all(a >= compaction.TIER * b for a, b in zip(sizes, sizes[1:], strict=False))
        if arrival % 7 == 0:
            assert compaction.read_current(spark, path).count() == 10 * (arrival + 1)
    assert_same_rows(compaction.read_current(spark, path), spark.read.parquet(path))
    assert rewritten <= sum(sizes) * (30).bit_length()
    assert not compaction.compact_table(spark, path, 10**9)


def test_copies_and_versions_are_retired_after_their_grace(spark, tmp_path):
    path = str(tmp_path / "t")
    for arrival in range(4):
        part(spark, arrival, 1).write.mode("append").parquet(path)
        compaction.compact_table(spark, path, 10**9)
    part(spark, 9, 1).write.parquet(f"{path}_compacted/broken-off")
    stored = lambda: len(os.listdir(f"{path}_compacted"))
    assert stored() == 5
    old = compaction.read_current(spark, path)
    assert compaction.retire_copies(spark, path, grace_seconds=3600) == 0
    assert old.count() == 4 and stored() == 5
    time.sleep(0.05)
    assert compaction.retire_copies(spark, path, grace_seconds=0) == 5 - len(compaction.copies_of(spark, path))
    assert stored() == len(compaction.copies_of(spark, path)) == 1
    assert len([f for f in os.listdir(f"{path}_compactions") if f.startswith("version")]) == 1
    assert compaction.read_current(spark, path).count() == 4
    part(spark, 4, 1).write.mode("append").parquet(path)
    assert compaction.compact_table(spark, path, 10**9)
    assert sorted(rows(compaction.read_current(spark, path), "n")) == [(i,) for i in range(5)]


def scanned_rows(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_mention_or_a_time_is_read_from_few_files(spark, tmp_path):
    frame = spark.range(0, 64_000, 1, 4).select(
        F.concat(F.lit("@h"), F.pmod(F.xxhash64("id"), F.lit(100))).alias("mention"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000))).alias("at"),
        F.col("id").alias("n"),
    )
    frame = frame.unionByName(
        spark.range(8_000).select(
            F.lit("@hot").alias("mention"), F.timestamp_seconds(F.col("id") * 125).alias("at"), F.col("id").alias("n")
        )
    ).withColumn("mention", F.when(F.col("n") % 50 != 0, F.col("mention")))
    path = str(tmp_path / "t")
    frame.write.parquet(path)
    assert compaction.compact_table(spark, path, 10**9, None, compaction.Cluster("mention", "at", files=128))
    current = compaction.read_current(spark, path)
    assert_same_rows(current, frame)
    copy = spark.read.parquet(compaction.copies_of(spark, path)[0][0])
    assert len(copy.inputFiles()) == 128
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        total = frame.count()
        for wanted in ("mention = '@h42'", "at between timestamp_seconds(500000) and timestamp_seconds(510000)"):
            assert 0 < copy.where(wanted).count() < total / 20
            assert scanned_rows(copy.where(wanted)) < total / 3
        both = "mention = '@hot' and at < timestamp_seconds(100000)"
        assert scanned_rows(copy.where(both)) < total / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_columns_of_one_value_or_none(spark, tmp_path):
    frame = part(spark, 0, 500).withColumn("at", F.lit(None).cast("timestamp"))
    path = str(tmp_path / "t")
    frame.write.parquet(path)
    compaction.compact_table(spark, path, 10**9, None, compaction.Cluster("mention", "at"))
    assert_same_rows(compaction.read_current(spark, path), frame)
