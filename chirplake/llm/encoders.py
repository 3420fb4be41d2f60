"""Byte-level and piece tokenizers with a memory of the words they have met.

Both split a text where no token can reach across, encode each different chunk once with the
tokenizer's library and put the ids together again. The memory belongs to the worker process
and is emptied when it is full.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np

from chirplake.llm.common import worker_cache

MEMORY_CHUNKS = 1_000_000
MEMORY_PIECE_CHUNKS = 900_000
LONGEST_REMEMBERED = 48

# White space besides a lone space or line end: the byte-level rule looks across runs of it.
_RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Where a space or a line end stands alone between other characters, a token ends before it.
_ALONE = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
_MARK = "\x00"
# Letters any version of Unicode knows.
_LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ƺ]+")
# What ends a run of letters and is a run of its own; the apostrophe begins endings.
_AFTER_LETTERS = ".,!?;:#$%&*|<>()"


def is_letters(chunk: str) -> bool:
    if chunk.isascii():
        return chunk.isalpha() or (chunk[:1] == " " and chunk[1:].isalpha())
    return _LETTERS.fullmatch(chunk) is not None


def trailing_marks(chunk: str) -> tuple[str, str]:
    """A chunk without the marks at its end, and those."""
    word = chunk.rstrip(_AFTER_LETTERS)
    return word, chunk[len(word) :]


def _shown_bytes() -> dict[int, int]:
    """The signs byte-level vocabularies write for bytes: printable Latin-1 stands for itself, the
    others are numbered from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in printable]
    return {byte: 256 + number for number, byte in enumerate(hidden)}


_SHOWN_BYTES = _shown_bytes()


def _byte_level_model(path: str):
    """The tokenizer of a file and its merges without the library's own cache, which the memory replaces.

    Runs of letters go to the merges directly, so files that do more than byte-level merges are refused.
    """
    from tokenizers import Tokenizer
    from tokenizers.models import BPE

    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    cut, merging = rules["pre_tokenizer"] or {}, rules["model"]
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if rules["normalizer"] or not plain or merging["type"] != "BPE" or any(map(merging.get, options)):
        raise ValueError("only tokenizers that merge the bytes of a text as it is are supported")
    merges = [tuple(pair.split(" ") if isinstance(pair, str) else pair) for pair in merging["merges"]]
    tokenizer = Tokenizer.from_file(path)
    tokenizer.model = BPE(vocab=merging["vocab"], merges=merges, cache_capacity=0)
    return tokenizer


class ByteEncoder(dict):
    """A text's ids under a byte-level tokenizer file, as little-endian 32-bit numbers.

    The file is that of the tokenizers library. Texts that hold one of its added tokens as
    plain text go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = _byte_level_model(path)
        self.merges = self.tokenizer.model
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.space = chr(_SHOWN_BYTES[ord(" ")])

    @staticmethod
    def chunks(text: str) -> list[str]:
        if _MARK in text or any(run in text for run in _RUNS):
            return _ALONE.split(text)
        if not text.isascii() and _WIDE.search(text):
            return _ALONE.split(text)
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split(_MARK)

    def letters(self, chunk: str) -> bytes:
        """Ids of one run of letters, a space before it or not: the rule splits it no further."""
        if chunk.isascii():
            shown = self.space + chunk[1:] if chunk[0] == " " else chunk
        else:
            shown = chunk.encode().decode("latin-1").translate(_SHOWN_BYTES)
        ids = array("I", [token.id for token in self.merges.tokenize(shown)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def library(self, text: str) -> bytes:
        return np.array(
            self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4"
        ).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        word, marks = trailing_marks(chunk)
        if not is_letters(word):
            ids = self.library(chunk) if chunk else b""
        elif not marks:
            ids = self.letters(chunk)
        else:
            # A word met for the first time is remembered alone: most such pairs do not come again.
            known = word in self
            ids = self[word] + self[marks]
            if not known:
                return ids
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self) >= MEMORY_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self.library(text)
        return b"".join(map(self.__getitem__, self.chunks(text)))


class PieceEncoder(dict):
    """A text's ids under a sentencepiece model without a piece that spans a word start.

    Ids come as little-endian 16-bit numbers, so the vocabulary must be under 65,536. Models that
    normalise more than spaces are refused.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rule = model.normalizer_spec
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.add_dummy_prefix:
            raise ValueError("only models that keep the text as it is are supported")
        if any("▁" in piece.piece.lstrip("▁") for piece in model.pieces):
            raise ValueError("a piece spans a word start")
        if len(model.pieces) >= 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)

    _WORD = re.compile("▁+[^▁]*")

    def __missing__(self, chunk: str) -> bytes:
        # The library puts the first word start back, but not before nothing.
        if chunk == "▁":
            ids = [self.processor.piece_to_id(chunk)]
        else:
            ids = self.processor.encode(chunk[1:].replace("▁", " "), num_threads=1)
        ids = np.array(ids, "<u2").tobytes()
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self) >= MEMORY_PIECE_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.__getitem__, self._WORD.findall("▁" + text.replace(" ", "▁"))))


def byte_encoder(path: str) -> ByteEncoder:
    cache = worker_cache("byte_encoders")
    if path not in cache:
        cache[path] = ByteEncoder(path)
    return cache[path]


def piece_encoder(path: str) -> PieceEncoder:
    cache = worker_cache("piece_encoders")
    if path not in cache:
        cache[path] = PieceEncoder(path)
    return cache[path]
