"""Counts and profiles of a layer. Each is one pass over the columns it needs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from chirplake.functions.text import has_at_sign, has_mention


def row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per named layer; over stored tables this reads only file footers."""
    counted = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows by all columns in turn, so that every look shows the same rows."""
    return df.orderBy(*[F.col(name).asc_nulls_last() for name in df.columns]).limit(n)


def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """Missing values per column: nulls, and NaN where the type has it."""

    def missing(field) -> Column:
        column = F.col(f"`{field.name}`")
        is_real = isinstance(field.dataType, (FloatType, DoubleType))
        return column.isNull() | F.isnan(column) if is_real else column.isNull()

    fields = df.schema.fields
    counted = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(missing(field)).alias(f"missing_{i}") for i, field in enumerate(fields)],
    )
    per_column = F.array(
        *[
            F.struct(F.lit(field.name).alias("column_name"), F.col(f"missing_{i}").alias("missing"))
            for i, field in enumerate(fields)
        ]
    )
    return counted.select("rows", F.inline(per_column)).select(
        F.lit(table_name).alias("table_name"), "column_name", "rows", "missing"
    )


def posts_per_user(posts: DataFrame) -> DataFrame:
    """Posts of each user, busiest first; posts without a user form their own group."""
    return _count_by_user(posts).orderBy(F.desc("posts"), F.asc("user"))


def top_users(posts: DataFrame, n: int = 20) -> DataFrame:
    return posts_per_user(posts).limit(n)


def _count_by_user(posts: DataFrame) -> DataFrame:
    return posts.groupBy("user").agg(F.count("*").alias("posts"))


def presence(df: DataFrame, found: Column) -> DataFrame:
    """Rows where ``found`` holds, and all others; an unknown counts as other."""
    return df.agg(F.count("*").alias("total"), F.count_if(found).alias("with_mention")).select(
        "total", "with_mention", (F.col("total") - F.col("with_mention")).alias("without_mention")
    )


def at_sign_presence(posts: DataFrame) -> DataFrame:
    """Posts with and without an ``@`` anywhere in the text."""
    return presence(posts, has_at_sign(F.col("text")))


def mention_presence(posts: DataFrame) -> DataFrame:
    """Posts with and without a true mention: no e-mail address, no bare ``@``."""
    return presence(posts, has_mention(F.col("text")))


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """How unevenly rows fall on the values of ``key``.

    The exact median holds one counter per distinct group size, and N rows have
    fewer than sqrt(2 N) + 1 distinct sizes, so it stays small at any scale.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("size"))
    return sizes.agg(
        F.count("*").alias("keys"),
        F.sum("size").alias("rows"),
        F.max("size").alias("largest"),
        F.percentile("size", F.lit(0.5)).alias("median"),
    ).withColumns(
        {
            "largest_to_median": F.try_divide("largest", "median"),
            "largest_share": F.try_divide("largest", "rows"),
        }
    )


def partition_balance(df: DataFrame) -> DataFrame:
    """How unevenly rows fall on the partitions of ``df``."""
    return balance_of_sizes(
        df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("size"))
    )


def balance_of_sizes(sizes: DataFrame) -> DataFrame:
    """The same from the ``size`` of each partition, which may be one that is only planned."""
    return sizes.agg(
        F.count("*").alias("partitions"),
        F.sum("size").alias("rows"),
        F.max("size").alias("largest"),
        F.min("size").alias("smallest"),
    ).withColumn("largest_to_mean", F.try_divide(F.col("largest") * F.col("partitions"), F.col("rows")))
