"""Sharding by rendezvous hashing: each record goes to the shard that bids highest for its key.

A shard's bid is its weight over the exponential variate drawn from the hash of key and
shard. Bids for other shards do not change when a shard is added, so a record either stays or
moves to the new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirplake.llm.common import in_order, whole_text

OVERHEAD_BYTES = 16


def _bid(key: Column, shard: Column, weight: Column) -> Column:
    """Larger is better. The hash's upper 53 bits make a number above 0 and under 1."""
    draw = F.shiftrightunsigned(F.xxhash64(key, shard), 11).cast("double")
    return weight / -F.log((draw + F.lit(0.5)) / F.lit(float(1 << 53)))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, of a stable key; equal bids go to the lower number. A null key is a key.

    ``weights`` gives each shard its share; a shard of weight 0 gets nothing.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be above 0")
    numbered = F.array(*[F.lit(float(weight)) for weight in weights])
    bids = F.transform(
        numbered,
        lambda weight, shard: F.struct(
            _bid(key, shard.cast("int"), weight).alias("bid"), (-shard).cast("int").alias("turned")
        ),
    )
    return -F.array_max(bids)["turned"]


def shard(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``size`` is the UTF-8 length of the text plus an overhead, a null text counts as empty.
    ``slot`` numbers the rows of a shard from 0 without gaps, by id and then by text; a null id
    comes first. With ``grown`` weights the shard under those comes along as ``grown_shard``, else
    null. The shard rests on the id alone: equal texts of different ids may part. Repeated rows have slots of
    their own; an empty table gives no rows, and long texts are measured whole.
    """
    text = whole_text(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        shard_of(F.col("doc_id").cast("long"), weights).alias("shard"),
        (
            shard_of(F.col("doc_id").cast("long"), grown) if grown else F.lit(None).cast("int")
        ).alias("grown_shard"),
    )
    placed = in_order(rows, "shard", "doc_id", "text_crc32", "size")
    # At most one row for each partition and one more for each shard that begins within one.
    runs = placed.groupBy("_part", "shard").agg(
        F.count(F.lit(1)).alias("n"), F.min("_row").alias("first")
    )
    bases, filled = [], {}
    for run in sorted(runs.collect(), key=lambda run: (run["_part"], run["shard"])):
        before = filled.get(run["shard"], 0)
        bases.append((run["_part"], run["shard"], before - run["first"]))
        filled[run["shard"]] = before + run["n"]
    base = docs.sparkSession.createDataFrame(bases, "_part int, shard int, base long")
    return placed.join(F.broadcast(base), ["_part", "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("_row") + F.col("base")).alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, weights: Sequence[float], path: str) -> None:
    """The rows as Parquet in one folder per shard, without a shuffle."""
    placed = docs.withColumn("shard", shard_of(F.col("doc_id").cast("long"), weights))
    placed.write.partitionBy("shard").parquet(path)
