"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three machines are compiled from a model file, each a table of transitions. The normaliser has one
state before the text, from which it writes the word-start sign, and one within it, where it writes
that sign for a space and any other character as it is. The pieces are a trie: a state for each prefix of a
piece, an output where a piece ends, and a weight for it in the tropical semiring (weights add along a
path, the smallest total wins). Byte fallback has a transition for each character without a piece, which
writes the pieces of its UTF-8 bytes and has the library's weight for the unknown.

An input is composed with the normaliser, and its output, position by position, with pieces and fallback:
the arcs of that lattice are made as the search reaches them. One search relaxes them by weight and the
smallest total at the end gives the encoding.

The weight of a piece in a unigram model is its negative log probability. A byte-pair model has no
such weights: it merges neighbours in order of rank. That order is finite-state as well. A sequence
of pieces is what the merges give if and only if each two neighbours are what the merges give for
the two together, so the piece before is part of the state and a transition has the weight 0 where the
merges would leave it and infinite weight where they would not. A path of finite weight is the model's own
encoding. Weights are not negative, so an arc cannot improve on a position whose total is no larger than that
of the position it leaves; for both kinds of model the search leaves such arcs out.

Decoding runs the pieces the other way round.

A null or empty text has no ids; an empty table gives no rows, repeated rows are repeated, and a text of any
length is encoded whole. Of equal totals the path found first stays, as in the library.
"""

from __future__ import annotations

import codecs
import re
import sys
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirplake.llm.common import whole_text, worker_cache

SPACE = "▁"
MEMORY_CHUNKS = 1_200_000
MEMORY_PAIRS = 500_000
LONGEST_REMEMBERED = 48
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_INFINITE = float("inf")
_NOWHERE: dict = {}


def _replace_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


class _Memory(dict):
    """Ids by chunk; finds those it has not met and forgets all when it is full."""

    def __init__(self, machine: PieceTransducer) -> None:
        self.machine = machine
        self.most = MEMORY_CHUNKS

    def __missing__(self, chunk: str) -> bytes:
        ids = self.machine.ids_of(chunk)
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = ids
        return ids


class PieceTransducer:
    """The compiled machines of one model.

    Normalisers that map characters, treat white space as a suffix or remove any, and user-defined
    pieces are refused.
    """

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rule, trained = proto.normalizer_spec, proto.trainer_spec
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces:
            raise ValueError("the model's normaliser changes more than spaces")
        if trained.treat_whitespace_as_suffix:
            raise ValueError("the model puts word signs at the end")
        kinds = type(proto.pieces[0])
        if any(piece.type in (kinds.USER_DEFINED, kinds.UNUSED) for piece in proto.pieces):
            raise ValueError("the model has user-defined or unused pieces")
        self.merges = trained.model_type == trained.BPE
        if not self.merges and trained.model_type != trained.UNIGRAM:
            raise ValueError("the model is neither of byte pairs nor unigram")
        # The normaliser: what it writes on entering a text, and its transitions within.
        self.before_text = SPACE if rule.add_dummy_prefix else ""
        self.within_text = {" ": SPACE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        self.ids: dict[str, int] = {}
        self.weights: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.surface: list[bytes] = []
        for i, piece in enumerate(proto.pieces):
            out = piece.piece.replace(SPACE, " ").encode()
            if piece.type == kinds.NORMAL:
                self.ids[piece.piece], self.weights[piece.piece] = i, -piece.score
            elif piece.type == kinds.BYTE:
                self.bytes[int(piece.piece[1:-1], 16)] = i
                out = bytes([int(piece.piece[1:-1], 16)])
            elif piece.type == kinds.CONTROL:
                out = b""
            else:
                out = trained.unk_surface.encode()
            self.surface.append(out)
        self.byte_ids = set(self.bytes.values())
        self.fallback = trained.byte_fallback and len(self.bytes) == 256
        # What the fallback writes for a character, added as they come.
        self.outputs: dict[str, tuple[int, ...]] = {}
        # One state per prefix of a piece; the empty string leads to the piece that ends there.
        self.trie: dict = {}
        for piece in self.weights:
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = piece
        # The library's own cost of a character without a piece.
        self.unknown_weight = max(self.weights.values(), default=0.0) + 10.0
        # Characters side by side in any piece; between others every lattice falls apart.
        self.neighbours = {
            pair for piece in self.ids for pair in zip(piece, piece[1:], strict=False)
        }
        self.apart = not any(after == SPACE and before != SPACE for before, after in self.neighbours)
        self.histories: dict[str, tuple[bool, list[tuple[float, str, str]]]] = {}
        self.arc_weights: dict[tuple[str, str], float] = {}
        self.memory = _Memory(self)
        codecs.register_error("one_byte", _replace_byte)

    def normalise(self, text: str) -> str:
        """The text composed with the normaliser, one transition after the other: none reads what another wrote."""
        if not text:
            return ""
        for char, sign in self.within_text.items():
            text = text.replace(char, sign)
        return self.before_text + text

    def _history(self, piece: str) -> tuple[bool, list[tuple[float, str, str]]]:
        """Whether merges reach a piece, and each step: rank of the next merge, first and last part."""
        known = self.histories.get(piece)
        if known is None:
            parts, steps, weights = list(piece), [], self.weights
            while True:
                ranks = [weights.get(a + b, _INFINITE) for a, b in zip(parts, parts[1:], strict=False)]
                best = min(ranks, default=_INFINITE)
                steps.append((best, parts[0], parts[-1]))
                if best == _INFINITE:
                    break
                at = ranks.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.histories[piece] = (len(parts) == 1, steps)
        return known

    def _allowed(self, left: str, right: str) -> bool:
        """Whether the merges of two neighbouring pieces' characters end with these two pieces.

        Each piece's own merges go on side by side, the better rank first and the left one first
        of equals, until a merge across the border would come before both.
        """
        (reached, lefts), (reached_too, rights) = self._history(left), self._history(right)
        if not (reached and reached_too):
            return False
        i = j = 0
        weights = self.weights
        while True:
            next_left, _, last = lefts[i]
            next_right, first, _ = rights[j]
            across = weights.get(last + first, _INFINITE)
            if across < next_left and across <= next_right and across < _INFINITE:
                return False
            if next_left <= next_right:
                if next_left == _INFINITE:
                    return True
                i += 1
            else:
                j += 1

    def _weight(self, before: str, piece: str, start: int) -> float:
        """The weight of the transition that ends a piece, after the piece before it.

        In a unigram model the piece's own, or that of the unknown. In a byte-pair model 0 if the merges
        leave the two side by side, infinite if not.
        """
        if not self.merges:
            return self.weights.get(piece, self.unknown_weight)
        allowed = self._allowed(before, piece) if start else self._history(piece)[0]
        return 0.0 if allowed else _INFINITE

    def shortest_path(self, chunk: str) -> list[str]:
        """The pieces, and characters without one, along the path of the smallest total weight."""
        n, root, known = len(chunk), self.trie, self.arc_weights
        # A position that no arc has reached yet has no total.
        total, arc = [0.0] + [_INFINITE] * n, [""] * (n + 1)
        for start in range(n):
            here, before, node = total[start], arc[start], root
            if here == _INFINITE:
                continue
            for stop in range(start + 1, n + 1):
                node = node.get(chunk[stop - 1])
                if node is None:
                    if stop > start + 1:
                        break
                    node = _NOWHERE
                if total[stop] <= here:  # no arc from here is better
                    continue
                piece = node.get("")
                if piece is None:
                    if stop > start + 1:
                        continue
                    piece = chunk[start]  # the fallback's transition
                weight = known.get((before, piece))
                if weight is None:
                    weight = self._weight(before, piece, start)
                    if len(known) >= MEMORY_PAIRS:
                        known.clear()
                    known[before, piece] = weight
                weight += here
                if weight < total[stop]:
                    total[stop], arc[stop] = weight, piece
        path, at = [], n
        while at:
            path.append(arc[at])
            at -= len(arc[at])
        return path[::-1]

    def _fallback(self, char: str) -> tuple[int, ...]:
        """What the fallback writes for a character, compiled when it is first met."""
        ids = tuple(self.bytes[b] for b in char.encode("utf-8", "surrogatepass")) if self.fallback else (self.unknown,)
        if len(self.outputs) < MEMORY_PAIRS:
            self.outputs[char] = ids
        return ids

    def _cut(self, chunk: str) -> list[str]:
        """The chunk cut where two characters meet that no piece has side by side."""
        cuts = [
            i
            for i, pair in enumerate(zip(chunk, chunk[1:], strict=False), 1)
            if pair not in self.neighbours
        ]
        return [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True)]

    def ids_of(self, chunk: str) -> bytes:
        """Ids of a chunk that is not in the memory yet."""
        # Letters alone are seldom cut.
        if not chunk.lstrip(SPACE).isalpha() and len(parts := self._cut(chunk)) > 1:
            return b"".join(map(self.memory.__getitem__, parts))
        out = array("i")
        for piece in self.shortest_path(chunk):
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            else:
                out.extend(self.outputs.get(piece) or self._fallback(piece))
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        normal = self.normalise(text)
        if not normal:
            return b""
        chunks = _CHUNK.findall(normal) if self.apart else [normal]
        return b"".join(map(self.memory.__getitem__, chunks))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become one replacement sign each."""
        ids = list(ids)
        raw = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if self.surface[i]), self.unknown)
        if self.before_text and first != self.unknown and raw[:1] == b" " and first not in self.byte_ids:
            raw = raw[1:]
        return raw.decode("utf-8", "one_byte")


def transducer(path: str, memory: int | None = None) -> PieceTransducer:
    """The machines of a model file, compiled once per worker process; ``memory`` bounds its chunks from now on."""
    cache = worker_cache("piece_transducers")
    if path not in cache:
        with open(path, "rb") as file:
            cache[path] = PieceTransducer(file.read())
    machine = cache[path]
    if memory is not None:
        machine.memory.most = memory
    return machine


def encode(docs: DataFrame, model: str, ids: str = "ids", memory: int = MEMORY_CHUNKS) -> DataFrame:
    """The rows with their texts' ids as ``array<int>``; a null or empty text has none.

    ``model`` is the path of a model file that every executor has. A column of that name is
    replaced. Each worker process remembers ``memory`` chunks of text at most, at some 200 bytes each: fewer
    cost time, and no results.
    """

    @arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        machine = transducer(model, memory)
        found = [machine.encode(text) for text in texts.to_pylist()]
        offsets = np.zeros(len(found) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
        values = pa.array(np.frombuffer(b"".join(found), "<i4"))
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    return docs.withColumn(ids, encoded(whole_text(F.col("text"))))


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text their ids stand for; null ids give null."""

    @arrow_udf("string")
    def decoded(arrays: pa.Array) -> pa.Array:
        machine = transducer(model)
        offsets = arrays.offsets.to_numpy()
        values = arrays.values.to_numpy(zero_copy_only=False)
        texts = [
            machine.decode(values[a:b].tolist()) if known else None
            for a, b, known in zip(offsets[:-1], offsets[1:], arrays.is_valid().to_pylist(), strict=True)
        ]
        return pa.array(texts, pa.string())

    return rows.withColumn(text, decoded(F.col(ids)))
