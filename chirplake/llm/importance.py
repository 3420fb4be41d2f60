"""Quality by importance resampling: documents drawn in proportion to target over raw likelihood.

Words and pairs of neighbouring words are hashed to a fixed number of buckets. Two bags of buckets
are counted, one over the target documents and one over all; a document's weight is the ratio of
its likelihoods under the two. Gumbel noise on the log weights and a cut at the k-th largest sum draw k
documents without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirplake.llm.common import (
    checkpoint,
    in_order,
    offset_column,
    totals_before,
    whole_text,
    worker_cache,
)

BUCKETS = 10_000
SMOOTHING = 1.0
SEED = 42
_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd constant that spreads bits
MEMORY_WORDS = 400_000
# Target documents the target counts are taken from at most.
FIT_TARGETS = 200_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        hashed = xxhash.xxh64_intdigest(word, 0)
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = hashed
        return hashed


def _memory() -> _WordHashes:
    cache = worker_cache("importance")
    if "words" not in cache:
        cache["words"] = _WordHashes()
    return cache["words"]


def features(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of each word and of each pair of neighbours, ASCII letters lower-cased, repeats included."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    hashes = np.fromiter(map(_memory().__getitem__, words), np.uint64, len(words))
    pairs = (hashes[:-1] * _MIX) ^ (hashes[1:] + (hashes[:-1] >> np.uint64(7)))
    pairs ^= pairs >> np.uint64(29)
    return (np.concatenate((hashes, pairs)) % np.uint64(buckets)).astype(np.int64)


def _count(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), np.int64)
        for batch in batches:
            pairs = zip(batch.column("text").to_pylist(), batch.column("target").to_pylist(), strict=True)
            for text, target in pairs:
                found = np.bincount(features(text, buckets), minlength=buckets)
                counts[0] += found
                if target:
                    counts[1] += found
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[0, used]), pa.array(counts[1, used])],
            names=["bucket", "raw", "target"],
        )

    return count


@dataclass(frozen=True)
class ImportanceModel:
    """For each bucket the log of its share in the target over its share in all text."""

    ratios: np.ndarray


def fit(texts: DataFrame, buckets: int = BUCKETS) -> ImportanceModel:
    """From all rows of (text, target); as many sums as there are buckets come to the driver."""
    sums = (
        texts.mapInArrow(_count(buckets), "bucket int, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    counts = np.full((2, buckets), SMOOTHING)
    for row in sums:
        counts[:, row["bucket"]] += row["raw"], row["target"]
    shares = np.log(counts / counts.sum(1, keepdims=True))
    return ImportanceModel(shares[1] - shares[0])


def weigh(docs: DataFrame, model: ImportanceModel) -> DataFrame:
    """(doc_id, tag, n_features, log_weight) of every row."""
    ratios = model.ratios
    buckets = len(ratios)

    @arrow_udf("struct<n_features:bigint,log_weight:double>")
    def weighed(texts: pa.Array) -> pa.Array:
        found = [features(text, buckets) for text in texts.to_pylist()]
        # Rounded, so that the order of a sum does not show.
        weights = [round(float(ratios[f].sum()), 6) for f in found]
        return pa.StructArray.from_arrays(
            [pa.array([len(f) for f in found], pa.int64()), pa.array(weights, pa.float64())],
            names=["n_features", "log_weight"],
        )

    text = whole_text(F.col("text"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("tag"),
        weighed(text).alias("w"),
    ).select("doc_id", "tag", "w.*")


def _labelled(labels: DataFrame) -> DataFrame:
    """(_labelled, target): each labelled document, and whether all its labels say good and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("_labelled"))
        .agg(F.min(F.coalesce(good, F.lit(False)).cast("int")).cast("boolean").alias("target"))
    )


def _bounded(targets: DataFrame, n: int, most: int, seed: int) -> DataFrame:
    """The ids whose hash is below the share ``most / n`` of all hashes: all of them if they are no more.

    About ``most`` ids stay, give or take a few times its square root.
    """
    cut = int(min(1.0, most / max(n, 1)) * ((1 << 53) - 1))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_labelled"), 11)
    return targets.where(place <= cut).select("_labelled")


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    seed: int = SEED,
    fit_targets: int = FIT_TARGETS,
) -> DataFrame:
    """(doc_id, n_features, log_weight, gumbel, rank, kept) of every row of ``docs``.

    The target are the documents labelled of good quality and not toxic; the raw text is all
    documents. ``kept`` marks the ``share`` of rows with the largest ``log_weight + gumbel``, rank 0
    first. Left open, the share is that of the target among the labelled documents: 0 without labels.
    The noise is drawn from the hash of seed, id and text, so runs agree. Rows of one id and one text
    tie and are ranked one after the other. A document with several labels is a target if all of
    them say so; null labels say no. A null text has weight 0, an empty table no rows, and a long text
    is read whole.

    The target counts come from about ``fit_targets`` target documents at most, those of the smallest
    hashes; their ids alone are broadcast and no text is shuffled. The raw counts, the weights, the
    ranks and the share are taken over all rows.
    """
    targets = checkpoint(_labelled(labels))
    counted = targets.agg(
        F.count_if("target").alias("targets"), F.avg(F.col("target").cast("double")).alias("share")
    ).first()
    chosen = _bounded(targets.where("target"), counted["targets"], fit_targets, seed)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    flagged = slim.join(F.broadcast(chosen), slim["doc_id"] == chosen["_labelled"], "left").select(
        "text", F.col("_labelled").isNotNull().alias("target")
    )
    model = fit(flagged)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "tag"), 11).cast("double")
    uniform = (draw + F.lit(0.5)) / F.lit(float(1 << 53))
    drawn = weigh(docs, model).withColumn("gumbel", F.round(-F.log(-F.log(uniform)), 6))
    # Stored first, as putting rows in order looks at them twice.
    drawn = checkpoint(drawn.withColumn("turned", -(F.col("log_weight") + F.col("gumbel"))))
    placed = in_order(drawn, "turned", "doc_id", "tag")
    sizes = [(row["_part"], row["count"]) for row in placed.groupBy("_part").count().collect()]
    if share is None:
        share = counted["share"] or 0.0
    drawn_rows = round(share * sum(size for _, size in sizes))
    ranked = placed.withColumn("rank", F.col("_row") + offset_column(totals_before(sizes)))
    return ranked.select(
        "doc_id", "n_features", "log_weight", "gumbel", "rank", (F.col("rank") < drawn_rows).alias("kept")
    )
