"""Ranked lexical search that scores each different bag of words once.

Documents are restricted to the terms of the items that are asked for. What is left of a document,
its vector of (term, occurrences) and its length class m, fixes its score for every item, so documents
with the same vector and m form a class: they are grouped by a hash, and the vectors themselves are
part of the group's key, which verifies it. Classes are scored block by block in the tasks, which keep
only the best classes of each item, and only the best of all are expanded again into their
documents, by ascending id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirplake.llm.common import checkpoint, lower_ascii, whole_text

BEST = 10
# Items are answered in blocks of no more than so many items and postings, which go to every task.
BLOCK_ITEMS, BLOCK_POSTINGS = 2_000, 500_000
# Gains and scores held at once while classes are scored.
HELD_AT_ONCE = 500_000
SCALE, LENGTH_SHARE, TERM_SCALE = 1000, 90, 1_000_000_000
# Sums of whole numbers below this are exact in doubles.
EXACT = 1 << 53

# Letters and digits of ASCII, lower-cased, and all bytes beyond ASCII stand; the rest separates.
_WORDS = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32
    for byte in range(256)
)
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_PAIR = np.dtype([("term", "<u4"), ("tf", "<u4")])


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(whole_text(text)), F.lit(TERM), F.lit(0))


@dataclass(frozen=True)
class ItemBlock:
    """Some items: their ids, the different terms of all, and for each term the items that hold it.

    ``starts`` and ``items`` are the postings: those of term t are ``items[starts[t] : starts[t + 1]]``.
    """

    ids: list
    terms: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray


def item_blocks(items: DataFrame, postings: int = BLOCK_POSTINGS) -> Iterator[ItemBlock]:
    """The items in blocks of a bounded number of postings, read one after the other.

    An item is a row; its place among the items with terms tells equal ids apart. An item of more terms
    than ``postings`` is a block of its own.
    """
    worded = items.select(
        "item_id", F.array_sort(F.array_distinct(terms_of(F.col("text")))).alias("terms")
    ).where(F.size("terms") > 0)
    ids, terms, held, count = [], {}, [], 0
    for row in worded.orderBy("item_id", "terms").toLocalIterator():
        found = [term.encode() for term in row["terms"]]
        if ids and (count + len(found) > postings or len(ids) >= BLOCK_ITEMS):
            yield _block(ids, terms, held)
            ids, terms, held, count = [], {}, [], 0
        ids.append(row["item_id"])
        held.append([terms.setdefault(term, len(terms)) for term in found])
        count += len(found)
    if ids:
        yield _block(ids, terms, held)


def _block(ids: list, terms: dict[bytes, int], held: list[list[int]]) -> ItemBlock:
    term = np.fromiter((t for found in held for t in found), np.int64)
    item = np.repeat(np.arange(len(held)), [len(found) for found in held])
    order = np.argsort(term, kind="stable")
    starts = np.searchsorted(term[order], np.arange(len(terms) + 1))
    return ItemBlock(ids, terms, starts, item[order].astype(np.int32))


def _shared(docs: DataFrame, value):
    """A value of bounded size that every task needs, sent to each executor once.

    Plain values and arrays only: an executor need not have this package.
    """
    return docs.sparkSession.sparkContext.broadcast(value)


def bags(docs: DataFrame, terms) -> DataFrame:
    """(doc_id, n, bag) of every document with a term: all its terms counted, and its vector over ``terms``.

    The vector lists (term, occurrences) as pairs of 32-bit numbers, by ascending term.
    """

    @arrow_udf("struct<n:bigint,bag:binary>")
    def bag(texts: pa.Array) -> pa.Array:
        number = terms.value.get
        lengths, vectors = [], []
        for text in texts.to_pylist():
            words = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
            counted = Counter(map(number, words))
            counted.pop(None, None)
            pairs = np.empty(len(counted), _PAIR)
            pairs["term"], pairs["tf"] = list(counted), list(counted.values())
            pairs.sort(order="term")
            lengths.append(len(words))
            vectors.append(pairs.tobytes())
        return pa.StructArray.from_arrays(
            [pa.array(lengths, pa.int64()), pa.array(vectors, pa.binary())], names=["n", "bag"]
        )

    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), bag(whole_text(F.col("text"))).alias("b")
    )
    return counted.select("doc_id", "b.*").where(F.col("n") > 0)


def _count_terms(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column("bag").to_pylist()), _PAIR)
            held += np.bincount(pairs["term"], minlength=size)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(held[used])], names=["term", "df"]
        )

    return count


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; as many sums as there are terms come to the driver."""
    counted = found.select("bag").mapInArrow(_count_terms(size), "term int, df long")
    held = np.zeros(size, np.int64)
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        held[row["term"]] = row["df"]
    return held


def term_weights(n_docs: int, held: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term, in doubles."""
    return np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64
    )


def classes(found: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(hash, m, bag, first, members) of each different vector and m; documents without an item's term are out.

    Rows are folded before the shuffle, so a class that holds a third of all documents sends one row
    from each task.
    """
    keyed = with_class(found, n_docs, n_terms)
    return keyed.groupBy("hash", "m", "bag").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("members")
    )


def with_class(found: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    m = F.lit(100 - LENGTH_SHARE) + F.expr(f"({LENGTH_SHARE}L * n * {n_docs}L) div {max(n_terms, 1)}L")
    return (
        found.where(F.octet_length("bag") > 0)
        .withColumn("m", m)
        .select("doc_id", F.xxhash64("bag", "m").alias("hash"), "m", "bag")
    )


def _contributions(pairs: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    tf = pairs["tf"].astype(np.int64)
    return weights[pairs["term"]] * ((TERM_SCALE * tf) // (SCALE * tf + 8 * m))


def _class_scores(
    bags_: list[bytes], m: np.ndarray, index: tuple[int, np.ndarray, np.ndarray], weights: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """(first class, scores for all items, one row for each class), some classes at a time.

    ``index`` is the number of items, and ``starts`` and ``items`` of their block.
    """
    n_items, starts, items = index
    pairs = np.frombuffer(b"".join(bags_), _PAIR)
    ends = np.cumsum([len(bag) // _PAIR.itemsize for bag in bags_])
    postings = np.diff(starts)[pairs["term"]]
    # Each pair once for every item that holds its term, and a score for each class and item.
    held = np.cumsum(postings)[ends - 1] + np.arange(1, len(bags_) + 1) * n_items
    cuts = [0, *(np.flatnonzero(np.diff(held // HELD_AT_ONCE)) + 1).tolist(), len(bags_)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        some = slice(ends[a - 1] if a else 0, ends[b - 1])
        counts = postings[some]
        row = np.repeat(np.arange(b - a), np.diff(ends[a:b], prepend=some.start))
        gained = _contributions(pairs[some], m[a:b][row], weights)
        stops = np.cumsum(counts)
        place = np.arange(stops[-1]) - np.repeat(stops - counts - starts[pairs["term"][some]], counts)
        cell = np.repeat(row * n_items, counts) + items[place]
        sums = np.bincount(cell, np.repeat(gained, counts), (b - a) * n_items)
        yield a, sums.reshape(b - a, -1).astype(np.int64)


_LAST = np.iinfo(np.int64).max
_TOP = "item int, score long, first long, hash long, m long, bag binary"


def _best_of_each(item: np.ndarray, score: np.ndarray, first: np.ndarray, best: int) -> np.ndarray:
    """The places of each item's best rows: highest score, then smallest first document."""
    order = np.lexsort((first, -score, item))
    starts = np.searchsorted(item[order], item[order])
    return order[np.arange(len(order)) - starts < best]


def _score_classes(index, weights, best: int):
    """A task's best classes of each item; what is kept is bounded by items and ``best``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        kept = {name: np.zeros(0, np.int64) for name in ("item", "score", "first", "hash", "m")}
        kept_bags = np.zeros(0, object)
        # From the tenth best score on; at that score a smaller id still gets in.
        least = np.ones(index.value[0], np.int64)
        for batch in batches:
            bags_ = batch.column("bag").to_pylist()
            if not bags_:
                continue
            as_objects = np.array([*bags_, None], object)
            m, hashed = (batch.column(name).to_numpy() for name in ("m", "hash"))
            # Without an id a class comes after all others of its score.
            first = batch.column("first").fill_null(_LAST).to_numpy()
            for at, scores in _class_scores(bags_, m, index.value, weight):
                row, item = np.nonzero(scores >= least)
                of = row + at
                new = {
                    "item": item, "score": scores[row, item],
                    "first": first[of], "hash": hashed[of], "m": m[of],
                }
                both = {name: np.concatenate((kept[name], new[name])) for name in kept}
                chosen = _best_of_each(both["item"], both["score"], both["first"], best)
                kept = {name: values[chosen] for name, values in both.items()}
                kept_bags = np.concatenate((kept_bags, as_objects[of]))[chosen]
                starts = np.flatnonzero(np.diff(kept["item"], prepend=-1))
                full = np.diff(starts, append=len(kept["item"])) >= best
                least[kept["item"][starts[full]]] = kept["score"][starts[full] + best - 1]
        if len(kept["item"]):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kept["item"].astype(np.int32)),
                    *(pa.array(kept[name]) for name in ("score", "first", "hash", "m")),
                    pa.array(kept_bags.tolist(), pa.binary()),
                ],
                names=[field.split()[0] for field in _TOP.split(", ")],
            )

    return score


def _rank(rows: DataFrame, by: list[Column], best: int) -> DataFrame:
    window = Window.partitionBy("item").orderBy(*by)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= best)


def search_block(docs: DataFrame, block: ItemBlock, best: int = BEST) -> DataFrame:
    """(item, rank, doc_id, score): the best documents of each item of a block, by its place in it."""
    spark = docs.sparkSession
    found = checkpoint(bags(docs, _shared(docs, block.terms)))
    totals = found.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals["docs"], totals["terms"] or 0
    weights = term_weights(n_docs, document_frequencies(found, len(block.terms)))
    longest = int(np.bincount(block.items, minlength=len(block.ids)).max())
    if longest * int(weights.max()) * (TERM_SCALE // SCALE) >= EXACT:
        raise OverflowError("scores of an item of this many terms are not exact in doubles")
    index = (len(block.ids), block.starts, block.items)
    scored = classes(found, n_docs, n_terms).select("first", "hash", "m", "bag").mapInArrow(
        _score_classes(_shared(docs, index), _shared(docs, weights), best), _TOP
    )
    # An item's best documents lie in its best classes by score and first document.
    by = [F.desc("score"), F.asc("first")]
    top = checkpoint(_rank(scored, by, best).select("item", "score", "hash", "m", "bag"))
    winners = top.select("hash", "m", "bag").distinct()  # bounded by items and ``best``
    members = (
        with_class(found, n_docs, n_terms)
        .join(F.broadcast(winners.select("hash").distinct()), "hash", "left_semi")
        .withColumn(
            "place",
            F.row_number().over(
                Window.partitionBy("hash", "m", "bag").orderBy(F.asc_nulls_last("doc_id"))
            ),
        )
        .where(F.col("place") <= best)
        .select("hash", "m", "bag", "doc_id")
    )
    expanded = top.join(members, ["hash", "m", "bag"])
    return _rank(expanded, [F.desc("score"), F.asc_nulls_last("doc_id")], best).select(
        "item", "rank", "doc_id", "score"
    )


def search(docs: DataFrame, items: DataFrame, best: int = BEST, postings: int = BLOCK_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of every item, over all of ``docs``.

    Terms are runs of ASCII letters and digits and of all that is not ASCII, with ASCII letters
    lower-cased. Equal scores rank by ascending id, null ids last; scores of 0 are left out. A null or
    empty text holds no term: as a document it does not count, as an item it has no rows. Every
    row is a document and every row an item, repeated rows and repeated or null ids too. Empty tables give
    no rows, long texts are read whole, and other columns play no part.

    Items are taken in blocks of ``postings``, each one pass over the documents, so that what the tasks
    are sent has a bound whatever the number of items.
    """
    results = []
    for block in item_blocks(items, postings):
        found = search_block(docs, block, best)
        names = docs.sparkSession.createDataFrame(
            list(enumerate(block.ids)), _names_schema(items)
        )
        results.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        empty = docs.sparkSession.createDataFrame([], f"{_names_schema(items)}, rank int, doc_id long, score long")
        return empty.select("item_id", "rank", "doc_id", "score")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


def _names_schema(items: DataFrame) -> str:
    return f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
