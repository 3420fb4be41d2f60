"""Byte-level BPE by ranks: Spark's higher-order functions fold the merges of distinct words.

A word is an array of pieces, one for each byte at first, each with the rank of the pair it makes with the
next. Each step of a fold joins the leftmost pair of the lowest rank and looks up the two pairs it has
changed, until no pair has a rank. The ranks are one literal: an array of small maps, addressed by
hash, from a piece (its bytes as hexadecimal digits) to its rank.

The words of all documents are counted, and those that come most often are folded once for the
whole corpus and remembered by the tasks. Texts are cut and looked up by the batch, each different part of
a batch once. A document takes the ids of remembered words from there, its
other words go through the same fold within the row, and their ids are filled in. No text and no id
is shuffled. Decoding joins the pieces' bytes.
"""

from __future__ import annotations

import base64
import contextlib
import heapq
import json
import re
import unicodedata
import uuid
import zlib
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from chirplake.llm.common import checkpoint, free_name, whole_text, worker_cache
from chirplake.llm.encoders import _AFTER_LETTERS, ByteEncoder, is_letters, trailing_marks

# Words folded once and sent to the tasks, at most: some 40 bytes each.
REMEMBERED = 600_000
# Chunks a task keeps in mind: between two reports of its counts, and with their ids.
COUNTED_CHUNKS, MEMORY_CHUNKS, LONGEST_CHUNK = 100_000, 100_000, 48
# The fold takes time by the square of a word's bytes; longer words are merged by a heap.
FOLD_BYTES = 256
BUCKETS = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Piece to rank, the id, of a file with a line of base64 and rank for each piece."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    if any(bytes([byte]) not in ranks for byte in range(256)):
        raise ValueError("the ranks lack a single byte")
    return ranks


def _ranks(path: str) -> dict[bytes, int]:
    """The ranks in a worker, read once for each process."""
    kept = worker_cache("ranks")
    if path not in kept:
        kept[path] = read_ranks(path)
    return kept[path]


def rank_literal(ranks: dict[bytes, int], buckets: int = BUCKETS) -> Column:
    """The ranks as a constant array of maps; Spark's maps are searched in turn, so each holds few."""
    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for piece, rank in ranks.items():
        digits = piece.hex().upper()
        maps[zlib.crc32(digits.encode()) % buckets][digits] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def _rank(ranks: Column, piece: Column, buckets: int) -> Column:
    place = F.crc32(piece.cast("binary")).bitwiseAND(F.lit(buckets - 1)).cast("int")
    return F.element_at(F.get(ranks, place), piece)


def _let(value: Column, use) -> Column:
    """``use(value)``, the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold_words(words: Column, ranks: Column, buckets: int = BUCKETS) -> Column:
    """The ids of each word of an array of strings: a word that is a piece is its id, the others are merged."""

    def rank(piece: Column, known: Column) -> Column:
        return _rank(known, piece, buckets)

    def joined(parts: Column, k: Column, known: Column) -> Column:
        """``parts`` with the pair that begins at part k, from 1, made one part."""

        def ranked(piece: Column, following: Column) -> Column:
            return F.struct(piece.alias("piece"), rank(F.concat(piece, following), known).alias("pair"))

        def with_piece(new: Column) -> Column:
            def changed(part: Column, i: Column) -> Column:
                return (
                    F.when(i == k - 1, ranked(new, F.get(parts, k + 1)["piece"]))
                    .when(i == k - 2, ranked(part["piece"], new))
                    .when(i != k, part)
                )

            return F.filter(F.transform(parts, changed), lambda part: part.isNotNull())

        return _let(F.concat(F.get(parts, k - 1)["piece"], F.get(parts, k)["piece"]), with_piece)

    def merged(digits: Column, known: Column) -> Column:
        def step(parts: Column, _: Column) -> Column:
            lowest = F.array_position(parts["pair"], F.array_min(parts["pair"])).cast("int")
            return _let(lowest, lambda k: F.when(k.isNull(), parts).otherwise(joined(parts, k, known)))

        def of_bytes(single: Column) -> Column:
            parts = F.transform(
                single,
                lambda piece, i: F.struct(
                    piece.alias("piece"),
                    rank(F.concat(piece, F.get(single, i + 1)), known).alias("pair"),
                ),
            )
            return F.aggregate(F.sequence(F.lit(2), F.size(single)), parts, step)

        parts = _let(F.regexp_extract_all(digits, F.lit(".."), F.lit(0)), of_bytes)
        return F.transform(parts, lambda part: rank(part["piece"], known))

    def ids(word: Column, known: Column) -> Column:
        return _let(
            F.hex(word),
            lambda digits: _let(
                rank(digits, known),
                lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(merged(digits, known)),
            ),
        )

    # The literal is named once, however often the fold refers to it.
    return _let(ranks, lambda known: F.transform(words, lambda word: ids(word, known)))


def merge_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges as the fold, lowest rank and leftmost first, for words too long for it."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n))  # of the piece that begins at a byte
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, left, stop = heapq.heappop(heap)
        right = end[left]
        # An entry holds if both its pieces are still there and end where they did.
        if right < 0 or right >= n or end[right] != stop:
            continue
        end[left], end[right] = stop, -1
        if stop < n:
            before[stop] = left
            if (rank := ranks.get(word[left : end[stop]])) is not None:
                heapq.heappush(heap, (rank, left, end[stop]))
        first = before[left]
        if first >= 0 and (rank := ranks.get(word[first:stop])) is not None:
            heapq.heappush(heap, (rank, first, stop))
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


# The pattern that cuts a text into words, for the signs below.
_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
)
# Code points beyond ASCII that are white space.
_SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Letters and digits that came with version 16 of Unicode, which Python may not know yet.
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
_NEW_DIGITS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)


# The bytes of ASCII by kind, and the same as expressions for whole parts.
_WHITE, _MARKS, _LETTER = np.zeros((3, 256), bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_MARKS[list(_AFTER_LETTERS.encode())] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_WIDE = "".join(map(chr, _SPACES))
_ONE_WORD = rf"\A( ?[A-Za-zÀ-ÖØ-öø-ƺ]+|[{re.escape(_AFTER_LETTERS)}]+|\n)\z"


class _Signs(dict):
    """For each character one of ASCII that the pattern treats alike: a letter, digit, space or other sign."""

    def __missing__(self, point: int) -> str:
        kind = unicodedata.category(chr(point))[0]
        if point < 128:
            sign = chr(point)
        elif point in _SPACES:
            sign = "\t"
        elif kind == "L" or any(a <= point <= b for a, b in _NEW_LETTERS):
            sign = "Z"
        elif kind == "N" or any(a <= point <= b for a, b in _NEW_DIGITS):
            sign = "0"
        else:
            sign = "!"
        self[point] = sign
        return sign


_SIGNS = _Signs()


def words_of_chunk(chunk: str) -> list[str]:
    """The words of a chunk: contractions, runs of letters, digits or other signs with a space before, white space."""
    if is_letters(chunk):
        return [chunk]
    word, marks = trailing_marks(chunk)
    if marks and is_letters(word):
        return [word, marks]
    if chunk.isascii():
        return _WORDS.findall(chunk)
    return [chunk[m.start() : m.end()] for m in _WORDS.finditer(chunk.translate(_SIGNS))]


def cut_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of texts without null that no word reaches across, and the number of parts before each text.

    Cuts lie before a lone space, around a lone line end, and between a letter and one of ``_AFTER_LETTERS``.
    Beside signs beyond ASCII no space counts as alone if the text holds wide white space.
    """
    size = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int32, size + 1, 4 * texts.offset)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = (ends - ends[0]).astype(np.int64)
    white, high = _WHITE[raw], raw >= 0x80
    if high.any():
        wide = pc.match_substring_regex(texts, f"[{_WIDE}]").to_numpy(zero_copy_only=False)
        if wide.any():
            white |= high & np.repeat(wide, np.diff(ends))
    begins, stops = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
    stops[ends] = True
    at = np.flatnonzero((raw == 32) | (raw == 10))
    at = at[(at > 0) & (at + 1 < len(raw))]
    at = at[~(white[at - 1] | white[at + 1] | stops[at] | stops[at + 1])]
    begins[at] = True
    begins[at[raw[at] == 10] + 1] = True
    at = np.flatnonzero(_MARKS[raw])
    at = at[at > 0]
    before = raw[at - 1]
    letter = _LETTER[before]
    # The letters of Latin-1 from its second half on begin with this byte.
    letter |= (raw[at - 2] == 0xC3) & (at > 1) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    begins[at[letter]] = True
    begins |= stops
    begins[-1] = False
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(raw)).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw)))
    return parts, np.searchsorted(starts, ends)


def _single(parts: pa.Array) -> np.ndarray:
    """Which parts are one word for certain: letters with a space before or not, marks, a line end."""
    return pc.match_substring_regex(parts, _ONE_WORD).to_numpy(zero_copy_only=False)


def _utf8_pieces(path: str) -> tuple[pa.Array, np.ndarray]:
    """The pieces that can be words, and their ranks."""
    kept = worker_cache("rank_words")
    if path not in kept:
        words = []
        for piece, rank in _ranks(path).items():
            with contextlib.suppress(UnicodeDecodeError):
                words.append((piece.decode(), rank))
        kept[path] = pa.array([word for word, _ in words]), np.array([rank for _, rank in words], np.uint32)
    return kept[path]


def _count_words(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts = pc.value_counts(cut_texts(batch.column("text"))[0])
                counted.append(pa.RecordBatch.from_struct_array(parts))
                held += len(parts)
            if held > COUNTED_CHUNKS:
                yield report(counted)
                counted, held = [], 0
        if counted:
            yield report(counted)

    def report(counted: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(counted).combine_chunks()
        single = _single(table["values"].combine_chunks())
        others: Counter[str] = Counter()
        split = table.filter(pa.array(~single))
        for chunk, times in zip(split["values"].to_pylist(), split["counts"].to_pylist(), strict=True):
            for word in words_of_chunk(chunk):
                others[word] += times
        listed = pa.table({"values": pa.array(others, pa.string()), "counts": pa.array(others.values(), pa.int64())})
        words = pa.concat_tables([table.filter(pa.array(single)), listed])
        words = words.group_by("values").aggregate([("counts", "sum")])
        chosen = words.filter(
            (pc.field("counts_sum") > 1)
            & (pc.utf8_length(pc.field("values")) <= LONGEST_CHUNK)
            & ~pc.field("values").isin(_utf8_pieces(path)[0])
        ).combine_chunks()
        columns = [pa.array(chosen[name].to_pylist(), kind) if not len(chosen) else chosen[name].combine_chunks()
                   for name, kind in (("values", pa.string()), ("counts_sum", pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["word", "times"])

    return count


def frequent_words(texts: DataFrame, path: str, most: int = REMEMBERED) -> DataFrame:
    """The words that are no pieces themselves and come most often, no more than ``most``.

    The least number of times is chosen so that the words of that number and above are few enough. It only
    decides which words are folded beforehand, and so a task leaves out words it has met once.
    """
    counted = texts.mapInArrow(_count_words(path), "word string, times long")
    words = checkpoint(counted.groupBy("word").agg(F.sum("times").alias("times")))
    least, held = 0, 0
    # One row for each number of times: fewer than the root of twice the words of the corpus.
    sizes = words.groupBy("times").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("times"))
    for row in sizes.toLocalIterator():
        if held + row["words"] > most:
            break
        least, held = row["times"], held + row["words"]
    return words.where(F.col("times") >= least).select("word") if held else words.select("word").limit(0)


class Remembered:
    """Words and their ids in a few flat arrays, by ascending hash of the word; see ``flat_words``.

    A dictionary of as many words would fill several times the memory of every worker process.
    """

    def __init__(self, hashes: array, word_ends: array, words: bytes, id_ends: array, ids: bytes) -> None:
        self.hashes = hashes
        self.word_ends, self.words = word_ends, words
        self.id_ends, self.ids = id_ends, ids

    def get(self, word: bytes) -> bytes | None:
        hashed = xxhash.xxh64_intdigest(word)
        at = bisect_left(self.hashes, hashed)
        while at < len(self.hashes) and self.hashes[at] == hashed:
            if self.words[self.word_ends[at] : self.word_ends[at + 1]] == word:
                return self.ids[self.id_ends[at] : self.id_ends[at + 1]]
            at += 1
        return None


def flat_words(words: pa.Array, ids: pa.Array) -> tuple[array, array, bytes, array, bytes]:
    """Words and the ids of each as the arrays of ``Remembered``, plain values that any process can read."""
    hashes = np.zeros(len(words), np.uint64)
    for at in range(0, len(words), 100_000):  # as objects of Python they take several times the room
        some = words.slice(at, 100_000).to_pylist()
        hashes[at : at + len(some)] = np.fromiter(map(xxhash.xxh64_intdigest, some), np.uint64, len(some))
    order = pa.array(np.argsort(hashes, kind="stable"))
    words, ids = words.cast(pa.binary()).take(order), ids.take(order)
    numbers = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
    flat_hashes = array("Q", hashes[order.to_numpy()].tobytes())
    return flat_hashes, _ends(pc.binary_length(words)), _joined(words), _ends(pc.list_value_length(ids), 4), numbers


def _ends(lengths: pa.Array, width: int = 1) -> array:
    """Where each part begins and the last one ends."""
    ends = np.zeros(len(lengths) + 1, np.uint32)
    np.cumsum(lengths.to_numpy(zero_copy_only=False) * width, out=ends[1:])
    return array("I", ends.tobytes())


def _joined(parts: pa.Array) -> bytes:
    whole = pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts)
    return pc.binary_join(whole, b"")[0].as_py()


class _Lookup(dict):
    """Ids of chunks made of remembered words; other chunks give their parts: ids, or words to fold."""

    def __init__(self, remembered: Remembered, ranks: dict[bytes, int]) -> None:
        self.remembered, self.ranks = remembered, ranks

    def word(self, word: str) -> bytes | str:
        raw = word.encode()
        if (rank := self.ranks.get(raw)) is not None:
            return rank.to_bytes(4, "little")
        if (ids := self.remembered.get(raw)) is not None:
            return ids
        if len(raw) > FOLD_BYTES:
            return np.array(merge_by_heap(raw, self.ranks), "<u4").tobytes()
        return word

    def __missing__(self, chunk: str) -> bytes | tuple:
        parts = tuple(map(self.word, words_of_chunk(chunk))) if chunk else (b"",)
        found = b"".join(parts) if all(type(part) is bytes for part in parts) else parts
        if type(found) is bytes and len(chunk) <= LONGEST_CHUNK:
            if len(self) >= MEMORY_CHUNKS:
                self.clear()
            self[chunk] = found
        return found

    def known_and_open(self, text: str) -> tuple[bytes, list[int], list[str]]:
        """The ids known so far, and where among them which words are still open."""
        found = list(map(self.__getitem__, ByteEncoder.chunks(text)))
        at, words = [], []
        open_ones = [i for i, part in enumerate(found) if type(part) is not bytes]
        size = done = 0
        for i in open_ones:
            size += sum(map(len, found[done:i]))
            done = i + 1
            known = []
            for part in found[i]:
                if type(part) is bytes:
                    known.append(part)
                    size += len(part)
                else:
                    at.append(size)
                    words.append(part)
            found[i] = b"".join(known)
        return b"".join(found), at, words


def _binary(lengths: np.ndarray, values: bytes | np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _binary_of(ends: array, values: bytes) -> pa.Array:
    return _binary(np.diff(np.frombuffer(ends, np.uint32)), values, pa.binary())


class _Batches:
    """``_Lookup.known_and_open`` for the texts of a batch at once: each different part is looked up once."""

    def __init__(self, remembered: Remembered, path: str) -> None:
        self.lookup = _Lookup(remembered, _ranks(path))
        self.pieces, ranks = _utf8_pieces(path)
        self.hashes = np.frombuffer(remembered.hashes, np.uint64)
        self.words = _binary_of(remembered.word_ends, remembered.words)
        of_pieces = _binary(np.full(len(ranks), 4), ranks.astype("<u4"), pa.binary())
        self.ids = pa.concat_arrays([of_pieces, _binary_of(remembered.id_ends, remembered.ids)])

    def known(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The ids of words, null where they are to be folded, and the places of words to look up one by one."""
        place = pc.index_in(words, self.pieces)
        missing = place.is_null().to_numpy(zero_copy_only=False)
        place = place.fill_null(0).to_numpy().astype(np.int64)
        rest = np.flatnonzero(missing)
        raw = words.take(pa.array(rest)).cast(pa.binary())
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, raw.to_pylist()), np.uint64, len(raw))
        at = np.searchsorted(self.hashes, hashes)
        found = at < len(self.hashes)
        found[found] = self.hashes[at[found]] == hashes[found]
        at = at[found]
        same = pc.equal(self.words.take(pa.array(at)), raw.filter(pa.array(found))).to_numpy(zero_copy_only=False)
        single = pc.binary_length(raw).to_numpy(zero_copy_only=False) > FOLD_BYTES
        single[np.flatnonzero(found)[~same]] = True
        place[rest[found]] = at + len(self.pieces)
        missing[rest[found]] = False
        return self.ids.take(pa.array(place, mask=missing)), rest[single]

    def known_and_open(self, texts: pa.Array) -> pa.StructArray:
        parts, before = cut_texts(texts)
        coded = parts.dictionary_encode()
        different, places = coded.dictionary, coded.indices.to_numpy()
        single = _single(different)
        alone = np.flatnonzero(single)
        words = different.take(pa.array(alone))
        known, apart = self.known(words)
        # A unit is some ids or one open word; a part that is no word for certain may be several units.
        first, counts = np.zeros(len(different), np.int64), np.ones(len(different), np.int64)
        first[alone] = np.arange(len(alone))
        more: list[bytes | str] = []
        looked_up = np.concatenate((np.flatnonzero(~single), alone[apart]))
        for place, part in zip(looked_up.tolist(), different.take(pa.array(looked_up)).to_pylist(), strict=True):
            entry = self.lookup[part]
            entry = entry if type(entry) is tuple else (entry,)
            first[place], counts[place] = len(alone) + len(more), len(entry)
            more += entry
        known = pa.concat_arrays([known, pa.array([x if type(x) is bytes else None for x in more], pa.binary())])
        words = pa.concat_arrays([words, pa.array([x if type(x) is str else None for x in more], pa.string())])
        is_open = known.is_null().to_numpy(zero_copy_only=False)
        known = known.fill_null(b"")
        taken = first[places]
        if (counts != 1).any():
            times = counts[places]
            after = np.cumsum(times)
            taken = np.repeat(taken - (after - times), times) + np.arange(int(times.sum()))
            before = np.concatenate(([0], after))[before]
        joined = known.take(pa.array(taken))
        at = np.zeros(len(taken) + 1, np.int64)
        np.cumsum(pc.binary_length(joined).to_numpy(zero_copy_only=False), out=at[1:])
        opened = np.flatnonzero(is_open[taken])
        opens = np.searchsorted(opened, before)
        owner = np.repeat(at[before[:-1]], np.diff(opens))
        values = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined), b"")
        words = words.take(pa.array(taken[opened]))
        offsets = pa.array(opens, pa.int32())
        return pa.StructArray.from_arrays(
            [
                _binary(np.diff(at[before]), values.buffers()[2] or b"", pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(at[opened] - owner, pa.int32())),
                pa.ListArray.from_arrays(offsets, words),
            ],
            names=["ids", "at", "words"],
        )


_OPEN = "struct<ids:binary,at:array<int>,words:array<string>>"


def _look_up(remembered, path: str):
    key = uuid.uuid4().hex

    @arrow_udf(_OPEN)
    def look_up(texts: pa.Array) -> pa.Array:
        kept = worker_cache("rank_lookup")
        if kept.get("key") != key:
            kept.update(key=key, lookup=_Batches(Remembered(*remembered.value), path))
        return kept["lookup"].known_and_open(texts)

    # So marked, it stays a step of its own: the optimizer does not take it into the fold.
    return look_up.asNondeterministic()


@arrow_udf(BinaryType())
def _fill(known: pa.Array, at: pa.Array, folded: pa.Array, sizes: pa.Array) -> pa.Array:
    """Known ids with the folded ones put in; these follow each other, ``sizes`` of them at each place."""
    out = []
    columns = (column.to_pylist() for column in (known, at, sizes))
    raw = np.ascontiguousarray(folded.values.to_numpy(zero_copy_only=False), "<u4").tobytes()
    read = 4 * int(folded.offsets[0].as_py()) if len(folded) else 0
    for ids, places, lengths in zip(*columns, strict=True):
        if not places:
            out.append(ids)
            continue
        parts, done = [], 0
        for place, length in zip(places, lengths, strict=True):
            parts += (ids[done:place], raw[read : read + 4 * length])
            done, read = place, read + 4 * length
        out.append(b"".join((*parts, ids[done:])))
    return pa.array(out, pa.binary())


def encode(docs: DataFrame, path: str, remembered: int = REMEMBERED, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with ``ids``: the ids of the whole ``text`` as little-endian 32-bit numbers, one after the other.

    ``path`` names the file of ranks. Texts are cut into words as the pattern of byte-level vocabularies has
    it (see ``words_of_chunk``), and each word is merged by itself. A null or empty text has no ids and an
    empty table no rows; repeated rows are repeated. Among equal ranks the leftmost pair is joined first. A
    word over ``FOLD_BYTES`` bytes, in a text of any length, is merged by a heap in place of the fold. A
    column ``ids`` is replaced, other columns stay as they are.
    """
    ranks = rank_literal(read_ranks(path), buckets)
    text = whole_text(F.col("text"))
    frequent = frequent_words(docs.select(text.alias("text")), path, remembered)
    folded = frequent.select("word", fold_words(F.array("word"), ranks, buckets)[0].alias("ids"))
    table = folded.toArrow()  # ``remembered`` rows at most
    flat = flat_words(*(table.column(name).combine_chunks() for name in ("word", "ids")))
    sent = docs.sparkSession.sparkContext.broadcast(flat)
    at, words = (free_name(docs, name) for name in ("_open", "_folded"))
    found = docs.withColumn(at, _look_up(sent, path)(text))
    found = found.withColumn(words, fold_words(F.col(f"{at}.words"), ranks, buckets))
    # The folded column is named twice, so the optimizer leaves the fold before the function.
    filled = _fill(
        F.col(f"{at}.ids"), F.col(f"{at}.at"), F.flatten(words), F.transform(words, lambda ids: F.size(ids))
    )
    others = [F.col(f"`{name}`") for name in docs.columns if name.lower() != "ids"]
    return found.select(*others, filled.alias("ids"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of all pieces that ``ids`` names, joined. Null stays null."""

    @arrow_udf("binary")
    def joined(ids: pa.Array) -> pa.Array:
        kept = worker_cache("rank_pieces")
        if path not in kept:
            ranks = _ranks(path)
            places = np.full(max(ranks.values()) + 1, -1, np.int64)
            places[list(ranks.values())] = np.arange(len(ranks))
            kept[path] = pa.array(list(ranks), pa.binary()), places
        pieces, places = kept[path]
        lengths = pc.binary_length(ids).fill_null(0).to_numpy(zero_copy_only=False) // 4
        numbers = np.frombuffer(b"".join(raw for raw in ids.to_pylist() if raw), "<u4")
        if (places[numbers] < 0).any():
            raise KeyError("ids that name no piece")
        bytes_of = pieces.take(pa.array(places[numbers]))
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(bytes_of).to_numpy(zero_copy_only=False))))
        before = np.concatenate(([0], np.cumsum(lengths)))
        values = b"".join(bytes_of.to_pylist()) if bytes_of.offset else bytes_of.buffers()[2]
        out = _binary(np.diff(ends[before]), values or b"", pa.binary())
        return pc.if_else(ids.is_valid(), out, None) if ids.null_count else out

    others = [F.col(f"`{name}`") for name in encoded.columns if name.lower() != "decoded"]
    return encoded.select(*others, joined("ids").alias("decoded"))
