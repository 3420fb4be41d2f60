"""SimHash near-dedup: fingerprints of word shingles, linked within a few bits.

Different fingerprints are few against documents: equal ones are put together first. Each one
is then sent to 15 cells: its 64 bits are cut into six blocks, and a cell is named by two blocks
and their bits. Two fingerprints with at most four differing bits agree on two whole blocks, so
they meet in a cell; no link is missed. In a cell a Gray-order index finds the groups. A cell
with many fingerprints is cut into slices, and each pair of slices is a task of its own, so no
task holds an unbounded group. Only links to the first of a group leave a cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirplake.llm.common import checkpoint, checkpoint_small, free_name, whole_text
from chirplake.llm.components import components
from chirplake.llm.gray_index import gray_code, group_cells

SHINGLE = 4
MAX_BITS = 4
SEED = 42
# (lowest bit, bits) of each block; two of six are equal if at most four bits differ.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
SLICE_ROWS = 4096
_HASHES_AT_ONCE = 1 << 14
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text: a bit is 1 if over half the shingles have it."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)
    counts, n = np.zeros(64, np.int64), len(words) - shingle + 1
    hashes = (digest(joined[a:b], SEED) for a, b in pairs)
    for done in range(0, n, _HASHES_AT_ONCE):
        some = np.fromiter(hashes, "<u8", min(_HASHES_AT_ONCE, n - done))
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long with the same bits."""

    @arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = [fingerprint(text, shingle) for text in texts.to_pylist()]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return fingerprints(whole_text(text))


def _cells(code: Column) -> Column:
    """The 15 cells of a fingerprint, as ints: number of the block pair, then the bits."""

    def bits(block: int) -> Column:
        low, n = BLOCKS[block]
        return F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << n) - 1))

    names = [
        F.shiftleft(F.lit(number).cast("long"), 22)
        .bitwiseOR(F.shiftleft(bits(a), BLOCKS[b][1]))
        .bitwiseOR(bits(b))
        .cast("int")
        for number, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2))
    ]
    return F.array(*names)


def _gray_rank(code: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _linker(most: int):
    names = ("cell", "one", "other", "rank", "id")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([batch.column(name).to_numpy(zero_copy_only=False) for name in names])
            n += batch.num_rows
            if n < HELD_ROWS:
                continue
            rows = [np.concatenate(parts) for parts in zip(*held, strict=True)]
            # The last cell may go on in the next batch.
            whole = _first_of_cells(rows)[-1]
            if whole:
                yield from linked([column[:whole] for column in rows])
            held, n = [[column[whole:] for column in rows]], len(rows[0]) - whole
        if n:
            yield from linked([np.concatenate(parts) for parts in zip(*held, strict=True)])

    def linked(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        starts = _first_of_cells(rows)
        sizes = np.diff(np.append(starts, len(rows[0])))
        several = np.repeat(sizes > 1, sizes)
        rows = [column[several] for column in rows]
        if not len(rows[0]):
            return
        ids = rows[4]
        first = group_cells(gray_code(rows[3].view(np.uint64)), _first_of_cells(rows), most)
        later = np.flatnonzero(first != np.arange(len(first)))
        if len(later):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[later]), pa.array(ids[first[later]])], names=["a", "b"]
            )

    return link


HELD_ROWS = 1 << 16


def _first_of_cells(rows: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(rows[0]), bool)
    new[1:] = False
    for column in rows[:3]:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def near_links(codes: DataFrame, most: int = MAX_BITS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Links (a, b) that connect all of ``codes`` (id, code) within ``most`` bits of each other.

    Codes must be different from each other. There may be fewer links than pairs, but what pairs
    connect, the links connect. ``most`` may be up to four.
    """
    if not 0 <= most <= len(BLOCKS) - 2:
        raise ValueError("fingerprints may differ in four bits at most")
    routed = codes.select(
        "id", _gray_rank(F.col("code")).alias("rank"), F.explode(_cells(F.col("code"))).alias("cell")
    )
    large = (
        routed.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > slice_rows)
        .select("cell", F.ceil(F.col("n") / slice_rows).cast("int").alias("slices"))
    )
    large = checkpoint_small(large)
    # Few cells are large, unless the corpus is; then the join is a shuffle.
    if large.limit(LARGE_CELLS_SENT + 1).count() <= LARGE_CELLS_SENT:
        large = F.broadcast(large)
    sized = routed.join(large, "cell", "left")
    own = F.pmod(F.xxhash64("rank"), F.col("slices").cast("long")).cast("int")
    tasks = F.when(
        F.col("slices").isNotNull(),
        F.transform(
            F.sequence(F.lit(0), F.col("slices") - 1),
            lambda other: F.struct(
                F.least(own, other).alias("one"), F.greatest(own, other).alias("other")
            ),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("other"))))
    dealt = sized.select("cell", F.explode(tasks).alias("task"), "rank", "id").select(
        "cell", "task.one", "task.other", "rank", "id"
    )
    together = dealt.repartition("cell", "one", "other").sortWithinPartitions(
        "cell", "one", "other", "rank"
    )
    return together.mapInArrow(_linker(most), "a long, b long").distinct()


LARGE_CELLS_SENT = 50_000


def near_groups(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """(doc_id, code, component) of each document; ``component`` is the smallest id reachable.

    Links are fingerprints that differ in at most ``most`` bits. Texts without words have the
    fingerprint zero and are linked like others. A row without an id belongs to the group of an
    equal fingerprint that has one and else has no component; it links nothing itself. Rows of one
    id are one document: they have its component. Repeated rows stay repeated. An empty table gives no
    rows; a text of any length gives one fingerprint of all its shingles.
    """
    coded = checkpoint(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            fingerprint_column(F.col("text"), shingle).alias("code"),
        )
    )
    codes = checkpoint_small(
        coded.groupBy("code").agg(F.min("doc_id").alias("id")).where(F.col("id").isNotNull())
    )
    links = near_links(codes, most)
    # An id whose rows have different fingerprints joins their groups.
    doubled = (
        coded.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("code").alias("low"), F.max("code").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("doc_id")
    )
    named = codes.withColumnRenamed("id", "b")
    same_id = coded.join(doubled, "doc_id").join(named, "code").select(F.col("doc_id").alias("a"), "b")
    roots = components(links.unionByName(same_id))
    grouped = checkpoint_small(
        codes.join(roots, codes["id"] == roots["node"], "left").select(
            "code", F.coalesce("root", "id").alias("component")
        )
    )
    return coded.join(grouped, "code", "left").select("doc_id", "code", "component")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """One document of each group, that with the smallest id; columns unchanged.

    Rows without an id stay, and so do all rows of an id that stays.
    """
    groups = near_groups(docs, shingle, most)
    gone = groups.where(F.col("doc_id") != F.col("component")).select(
        F.col("doc_id").alias("_gone")
    ).distinct()
    flag = free_name(docs, "_flag")
    gone = gone.withColumn(flag, F.lit(True))
    joined = docs.join(gone, docs["doc_id"] == gone["_gone"], "left")
    kept = joined.where(F.col(flag).isNull())
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])
