"""Line dedup: a line found in several documents stays only in the first of them.

Lines travel as 128-bit hashes with their document and position, never as text. The
hashes are dealt out in ranges of (hash, document, position), so a line that fills a third
of the corpus is spread over many tasks, and every task streams over its sorted rows
and keeps in mind the first document of the current hash only. Where a hash runs on over
the edge of a task, one summary row per task tells the next ones which document came first.
The result is a compressed bitmap of kept lines per document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from chirplake.llm.common import (
    WHITE,
    checkpoint,
    free_name,
    lower_ascii,
    text_tag,
    whole_text,
)

MIN_CHARS = 10

_STREAMED = (
    "kind int, part int, doc long, tag long, pos int, "
    "head_1 long, head_2 long, head_doc long, last_1 long, last_2 long, last_doc long, one boolean"
)
_DROP, _HEAD, _SUMMARY = 0, 1, 2
_APPLIED = StructType(
    [
        StructField("text", StringType()),
        StructField("n_lines", LongType()),
        StructField("n_dropped", LongType()),
    ]
)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc, tag, pos) of every line that can be a duplicate.

    A line's key is the line stripped of ASCII white space and lower-cased in ASCII; keys
    under ``min_chars`` code points are no duplicates. Rows without a document id are left out.
    """
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"),
        text_tag(F.col("text")).alias("tag"),
        F.posexplode(F.split(whole_text(F.col("text")), "\n", -1)).alias("pos", "line"),
    )
    keyed = lines.withColumn("key", lower_ascii(F.btrim("line", F.lit(WHITE))))
    return keyed.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
        "doc",
        "tag",
        "pos",
    )


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted hashes whose document is not the first with that hash.

    Rows of the partition's first hash come out as they are: whether they are the first
    ones is known only when all partitions are.
    """
    fields = [name.split()[0] for name in _STREAMED.split(",")]
    kinds = dict.fromkeys(fields, pa.int64()) | {
        "kind": pa.int32(), "part": pa.int32(), "pos": pa.int32(), "one": pa.bool_()
    }
    head = last = None
    one = True
    part = 0

    def rows(n: int, **columns) -> pa.RecordBatch:
        arrays = [
            pa.array(columns[name], kinds[name]) if name in columns else pa.nulls(n, kinds[name])
            for name in fields
        ]
        return pa.RecordBatch.from_arrays(arrays, names=fields)

    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, tag, pos, parts = (
            batch.column(name).to_numpy(zero_copy_only=False)
            for name in ("h1", "h2", "doc", "tag", "pos", "part")
        )
        starts = np.ones(len(h1), bool)
        starts[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if last is None:
            part, head = int(parts[0]), (h1[0], h2[0], doc[0])
        else:
            starts[0] = (h1[0], h2[0]) != last[:2]
        group = np.cumsum(starts) - 1
        firsts = doc[starts]
        # Group -1 is the one the batch before ended with.
        first = np.where(group >= 0, firsts[np.maximum(group, 0)], 0) if len(firsts) else group * 0
        first = np.where(group < 0, last[2] if last else 0, first)
        in_head = (h1 == head[0]) & (h2 == head[1])
        one = one and bool(in_head.all())
        last = (h1[-1], h2[-1], int(first[-1]))
        for kind, chosen in ((_HEAD, in_head), (_DROP, ~in_head & (doc != first))):
            if n := int(chosen.sum()):
                yield rows(
                    n, kind=np.full(n, kind, np.int32), part=np.full(n, part, np.int32),
                    doc=doc[chosen], tag=tag[chosen], pos=pos[chosen].astype(np.int32),
                )
    if head is not None:
        names = ("head_1", "head_2", "head_doc", "last_1", "last_2", "last_doc")
        ends = {name: [int(value)] for name, value in zip(names, (*head, *last), strict=True)}
        yield rows(1, kind=[_SUMMARY], part=[part], one=[one], **ends)


def _first_of_heads(summaries: list) -> list[tuple[int, int]]:
    """For each partition, the first document that has the hash the partition begins with."""
    found, carried = [], None
    for row in sorted(summaries, key=lambda row: row["part"]):
        head = (row["head_1"], row["head_2"])
        first = carried[1] if carried and carried[0] == head else row["head_doc"]
        found.append((row["part"], first))
        carried = ((row["last_1"], row["last_2"]), first if row["one"] else row["last_doc"])
    return found


@arrow_udf(BinaryType())
def _pack(positions: pa.Array) -> pa.Array:
    """Sorted positions of dropped lines as a compressed bitmap of kept ones."""

    def packed(dropped: list[int]) -> bytes:
        keep = np.ones((max(dropped) // 8 + 1) * 8, bool)
        keep[dropped] = False
        return zlib.compress(np.packbits(keep, bitorder="little").tobytes())

    return pa.array([packed(dropped) for dropped in positions.to_pylist()], pa.binary())


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, tag, bitmap) of each document that loses a line.

    ``bitmap`` is the zlib-compressed run of bits, lowest first, one per line up to the end of the
    byte with the last dropped one: 1 keeps the line. Lines beyond it are kept. ``tag`` is the hash of the
    text, so that rows that share an id but not a text have bitmaps of their own.
    """
    keys = ("h1", "h2", "doc", "tag", "pos")
    # Stored first, as dealing rows out in ranges looks at them twice.
    hashes = checkpoint(line_hashes(docs, min_chars))
    ordered = hashes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    streamed = checkpoint(
        ordered.withColumn("part", F.spark_partition_id()).mapInArrow(_first_occurrences, _STREAMED)
    )
    # One row for each partition.
    summaries = streamed.where(F.col("kind") == _SUMMARY).collect()
    heads = docs.sparkSession.createDataFrame(
        _first_of_heads(summaries), "part int, first long"
    )
    undecided = streamed.where(F.col("kind") == _HEAD).join(F.broadcast(heads), "part")
    dropped = (
        streamed.where(F.col("kind") == _DROP)
        .select("doc", "tag", "pos")
        .unionByName(undecided.where(F.col("doc") != F.col("first")).select("doc", "tag", "pos"))
    )
    lists = dropped.groupBy("doc", "tag").agg(F.collect_set("pos").alias("positions"))
    return lists.select("doc", "tag", _pack("positions").alias("bitmap"))


@arrow_udf(_APPLIED)
def _apply(texts: pa.Array, bitmaps: pa.Array) -> pa.Array:
    kept, lines, dropped = [], [], []
    for text, bitmap in zip(texts.to_pylist(), bitmaps.to_pylist(), strict=True):
        if bitmap is None:
            kept.append(text)
            lines.append(text.count("\n") + 1)
            dropped.append(0)
            continue
        parts = text.split("\n")
        bits = np.frombuffer(zlib.decompress(bitmap), np.uint8)
        keep = np.unpackbits(bits, bitorder="little").astype(bool)[: len(parts)]
        gone = [i for i in range(len(keep)) if not keep[i]]
        lost = set(gone)
        kept.append("\n".join(line for i, line in enumerate(parts) if i not in lost))
        lines.append(len(parts))
        dropped.append(len(gone))
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
        names=["text", "n_lines", "n_dropped"],
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their text after line dedup, ``n_lines`` before it and ``n_dropped``.

    A key found in at least two documents loses all its lines except in the document with the
    smallest id. A null or empty text is one empty line. Rows without an id lose nothing and take
    nothing; rows of one id are one document, and a repeated row gives a repeated result. An empty
    table gives an empty one, and a text or line of any length is taken whole. Other columns stay as they are;
    the two new ones replace columns of those names.
    """
    tag, bits, done = (free_name(docs, name) for name in ("_tag", "_bits", "_done"))
    bitmaps = keep_bitmaps(docs, min_chars).select(
        F.col("doc").alias("_bits_doc"), F.col("tag").alias("_bits_tag"), F.col("bitmap").alias(bits)
    )
    tagged = docs.withColumn(tag, text_tag(F.col("text")))
    joined = tagged.join(
        bitmaps,
        (tagged["doc_id"] == bitmaps["_bits_doc"]) & (tagged[tag] == bitmaps["_bits_tag"]),
        "left",
    )
    applied = joined.withColumn(done, _apply(whole_text(F.col("text")), F.col(bits)))
    others = [F.col(f"`{name}`") for name in docs.columns if name not in ("text", "n_lines", "n_dropped")]
    return applied.select(*others, *(f"{done}.{name}" for name in ("text", "n_lines", "n_dropped")))
