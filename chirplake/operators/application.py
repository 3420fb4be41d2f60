"""Per-mention results from gold.

Counts, minima and maxima are folded on the map side before the one shuffle on
the mention, so a mention that holds a third of all rows arrives as at most one
row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirplake.functions.labels import NEG, NEU, POS

COUNTS = {"negative": NEG, "neutral": NEU, "positive": POS}


def _label_counts() -> list[Column]:
    return [F.count_if(F.col("predicted_sentiment") == label).alias(n) for n, label in COUNTS.items()]


def _time_range() -> list[Column]:
    return [F.min("timestamp").alias("min_timestamp"), F.max("timestamp").alias("max_timestamp")]


def _total() -> Column:
    """Sum of the three counts; a row without a known label is in none of them."""
    return F.col("positive") + F.col("neutral") + F.col("negative")


def ranked(per_mention: DataFrame, by: str = "total") -> DataFrame:
    """Largest first, ties by mention."""
    return per_mention.orderBy(F.desc(by), F.asc("mention"))


def mention_total(gold: DataFrame) -> DataFrame:
    """Mentions in gold, repeats included, and how many different ones."""
    return gold.agg(
        F.count("mention").alias("mentions"), F.count_distinct("mention").alias("distinct_mentions")
    )


def mention_pivot(gold: DataFrame) -> DataFrame:
    """Counts of each predicted sentiment per mention, as columns, with their total."""
    counted = gold.groupBy("mention").agg(*_label_counts())
    return ranked(counted.withColumn("total", _total()))


def mention_time_range(gold: DataFrame) -> DataFrame:
    """Oldest and newest post per mention."""
    return gold.groupBy("mention").agg(*_time_range())


def application_partials(gold: DataFrame) -> DataFrame:
    """What one part of gold adds to the application table."""
    return gold.groupBy("mention").agg(*_time_range(), *_label_counts())


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of several parts as those of one."""
    return partials.groupBy("mention").agg(
        F.min("min_timestamp").alias("min_timestamp"),
        F.max("max_timestamp").alias("max_timestamp"),
        *[F.sum(name).alias(name) for name in COUNTS],
    )


def fold_partials(partials: DataFrame) -> DataFrame:
    """The application table from the partials of all parts."""
    return ranked(merge_partials(partials).withColumn("total", _total()))


def application_table(gold: DataFrame) -> DataFrame:
    """Time range and sentiment counts per mention, most mentioned first."""
    return ranked(application_partials(gold).withColumn("total", _total()))


def top_mentions(gold: DataFrame, by: str, n: int = 20) -> DataFrame:
    """The ``n`` mentions with the most ``by`` (positive, negative, neutral or total)."""
    counted = gold.groupBy("mention").agg(*_label_counts()).withColumn("total", _total())
    return ranked(counted, by).select("mention", by).limit(n)


def salted_mention_totals(gold: DataFrame, salts: int = 16) -> DataFrame:
    """Rows per mention by way of (mention, salt), so a hot mention has many reducers.

    The salt comes from the number of the task's partition. Every map task then
    sends one folded row per mention, no more than without salt, and a task run
    again after a lost executor sends it to the same place.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    parts = gold.groupBy("mention", salt.alias("salt")).agg(F.count("*").alias("part"))
    return parts.groupBy("mention").agg(F.sum("part").alias("total"))
