"""Benchmark decontamination in DataFrame functions only.

Every run of ten words of a test item is a window; an item of fewer words is one window as a
whole. The hash of a window sets two bits in a bitmap that goes to every task with the plan. A
document's windows are hashed where the document lies; those whose bits are set come out as words
and meet the broadcast windows in a hash join on the words themselves, which verifies the hit. No
document text is shuffled to find hits. The bitmap grows with the windows up to a bound on its memory;
beyond it the windows are taken in blocks, each one pass over the documents with a bitmap of its own,
so few windows come out that are no hits, however large the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirplake.llm.common import checkpoint_small, free_name, lower_ascii, text_tag, whole_text

WINDOW = 10
# Digits, letters after lower-casing, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Bits of a bitmap: 64 for each window where there is room, 16 at least. The most are 2 MB.
MIN_BITS, MAX_BITS = 1 << 16, 1 << 24
BITS_WANTED, BITS_LEAST = 64, 16
# Windows are broadcast up to this many bytes of text, and joined by a shuffle beyond.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(whole_text(text)), F.lit(WORD), F.lit(0))


def _starts(n_words: Column, length: int | Column) -> Column:
    """First word of each window of a length, from 1; none if the text is shorter."""
    length = F.lit(length) if isinstance(length, int) else length
    return F.when(
        n_words >= length, F.sequence(F.lit(1), F.greatest(n_words - length + 1, F.lit(1)))
    ).otherwise(F.array().cast("array<int>"))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, length, hash, items): each different window and the ids of the items that have it.

    Items without words have none. An item's id may be null; it then counts as the id ''.
    """
    worded = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words_of(F.col("text")).alias("words"),
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    windows = worded.withColumn("length", length).select(
        "item",
        "length",
        F.explode(
            F.transform(
                _starts(F.size("words"), F.col("length")),
                lambda start: F.slice(F.col("words"), start, F.col("length")),
            )
        ).alias("window"),
    )
    return windows.groupBy(
        F.array_join("window", " ").alias("gram"), "length", F.xxhash64("window").alias("hash")
    ).agg(F.collect_set("item").alias("items"))


def _places(hashed: Column, bits: int) -> tuple[Column, Column]:
    """The two bits of a hash, from its lower and its upper half."""
    last = F.lit(bits - 1)
    return hashed.bitwiseAND(last), F.shiftright(hashed, 32).bitwiseAND(last)


def _bitmap(windows: DataFrame, bits: int) -> Column:
    """A constant array of longs with both bits of every window set."""
    place = F.explode(F.array(*_places(F.col("hash"), bits)))
    words = (
        windows.select(place.alias("place"))
        .select(
            F.shiftright("place", 6).alias("word"),
            F.expr("shiftleft(1L, cast(place & 63L as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("word_bits"))
        .collect()
    )
    dense = dict.fromkeys(range(bits // 64), 0) | {row["word"]: row["word_bits"] for row in words}
    values = ",".join(str(dense[word]) for word in range(bits // 64))
    return F.split(F.lit(values), ",").cast("array<bigint>")


def _is_set(bitmap: Column, hashed: Column, bits: int) -> Column:
    first, second = (
        F.getbit(
            F.get(bitmap, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")
        )
        == 1
        for place in _places(hashed, bits)
    )
    return first & second


def _candidates(worded: DataFrame, windows: DataFrame, sizes: list) -> DataFrame:
    """``worded`` without its words, a row for each window whose bits are set: (first, length, gram).

    ``sizes`` has a row for each length of the windows. A document without any has one row of nulls.
    """
    n_windows = sum(row["n"] for row in sizes)
    bits = MIN_BITS
    while bits < min(BITS_WANTED * n_windows, MAX_BITS):
        bits *= 2
    bitmap = _bitmap(windows, bits)
    words, n_words = F.col("words"), F.col("n_words")

    def candidates(length: int) -> Column:
        hashes = F.transform(
            _starts(n_words, length), lambda start: F.xxhash64(F.slice(words, start, length))
        )
        starts = F.array_compact(
            F.transform(hashes, lambda hashed, i: F.when(_is_set(bitmap, hashed, bits), i))
        )
        return F.transform(
            starts,
            lambda i: F.struct(
                i.alias("first"),
                F.lit(length).alias("length"),
                F.array_join(F.slice(words, i + 1, length), " ").alias("gram"),
            ),
        )

    nothing = F.array().cast("array<struct<first:int,length:int,gram:string>>")
    found = F.concat(nothing, *[candidates(length) for length in sorted(row["length"] for row in sizes)])
    spread = worded.select("doc_id", "tag", "n_words", F.explode_outer(found).alias("at"))
    return spread.select("doc_id", "tag", "n_words", "at.*")


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: (doc_id, tag, n_words, hits, items).

    ``hits`` are the verified occurrences as (first word from 0, words), ``items`` the ids as
    strings of the items whose windows occur. ``tag`` is the hash of the text: rows of one id
    with different texts are told apart, equal rows are one document. A null text has no words. Without
    documents there are no rows, without items no hits. Long texts are searched whole.
    """
    windows = checkpoint_small(benchmark_windows(items, window))
    n_blocks = -(-windows.count() // (MAX_BITS // BITS_LEAST))
    block = F.pmod(F.shiftright("hash", 16), F.lit(max(n_blocks, 1)))
    windows = windows.withColumn("block", block)
    sizes = windows.groupBy("block", "length").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("gram")).alias("bytes")
    )
    sizes = sizes.collect()  # for each block one row for each length from 1 to the window
    worded = docs.select(
        F.col("doc_id"), text_tag(F.col("text")).alias("tag"), words_of(F.col("text")).alias("words")
    ).withColumn("n_words", F.size("words"))
    spread = None
    for number in range(max(n_blocks, 1)):
        own = [row for row in sizes if row["block"] == number]
        part = _candidates(worded, windows.where(F.col("block") == number), own)
        spread = part if spread is None else spread.unionByName(part)
    known = windows.select(F.col("gram").alias("key"), "items")
    if sum(row["bytes"] for row in sizes) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    # Beyond that the join shuffles; documents without a candidate have a key each, not one for all.
    none = F.concat(F.lit("\x00"), F.hex(F.xxhash64("doc_id", "tag")))
    verified = spread.withColumn("key", F.coalesce("gram", none)).join(known, "key", "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("first", "length"))
    return (
        verified.groupBy("doc_id", "tag")
        .agg(
            F.max("n_words").alias("n_words"),
            F.collect_set(hit).alias("hits"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .select("doc_id", "tag", "n_words", "hits", "items")
    )


def hit_words(hits: Column) -> Column:
    """The different words, by number from 0, that lie inside any hit."""
    spans = F.transform(
        hits, lambda hit: F.sequence(hit["first"], hit["first"] + hit["length"] - 1)
    )
    return F.array_distinct(F.flatten(spans))


def _with_hits(docs: DataFrame, hits: DataFrame, how: str) -> tuple[DataFrame, str]:
    tag = free_name(docs, "_tag")
    found = hits.where(F.size("hits") > 0).select(
        F.col("doc_id").alias("_hit_doc"), F.col("tag").alias("_hit_tag"), F.col("hits").alias("_hits")
    )
    tagged = docs.withColumn(tag, text_tag(F.col("text")))
    same = tagged["doc_id"].eqNullSafe(found["_hit_doc"]) & (tagged[tag] == found["_hit_tag"])
    return tagged.join(found, same, how), tag


def remove_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, columns unchanged."""
    joined, _ = _with_hits(docs, find_hits(docs, items, window), "left_anti")
    return joined.select(*[F.col(f"`{name}`") for name in docs.columns])


def remove_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, the words inside hits taken out; what stands between words stays.

    A null text stays null.
    """
    joined, _ = _with_hits(docs, find_hits(docs, items, window), "left")
    text = F.col("text")
    # Words and what separates them take turns, so a piece's number gives its word's.
    pieces = F.regexp_extract_all(
        text, F.lit(r"[0-9A-Za-z[^\x00-\x7F]]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)
    )
    first_is_word = text.rlike(r"^[0-9A-Za-z[^\x00-\x7F]]").cast("int")
    gone = hit_words(F.col("_hits"))
    kept = F.filter(
        pieces,
        lambda piece, i: ((i + first_is_word) % 2 == 0)
        | ~F.array_contains(gone, F.floor((i + first_is_word - 1) / 2).cast("int")),
    )
    cut = F.when(F.col("_hits").isNull(), text).otherwise(F.array_join(kept, ""))
    return joined.select(
        *[cut.alias(name) if name == "text" else F.col(f"`{name}`") for name in docs.columns]
    )
