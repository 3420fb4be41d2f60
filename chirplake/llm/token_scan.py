"""Token counts of flat token files: find the end-of-document ids by scanning.

A flat file is nothing but ids, one after the other; no index says where documents begin. Each
file is searched block by block with vector operations. A block's summary (ids, ends, ids after the
last end) says nothing about what came before; a prefix scan over the summaries gives every
block the ids, the documents and the open document in front of it, and so the documents that reach
over the edges of blocks and files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirplake.llm.common import checkpoint, in_order, whole_text
from chirplake.llm.encoders import piece_encoder

END_ID = 2
BLOCK_IDS = 1 << 20
# Bytes of text that go to one file, on average; a file is read by one task, and its ids are shorter.
FILE_BYTES = 32 << 20
DTYPE = "<u2"

_BLOCKS = "file string, block long, n_ids long, ends array<int>"
_SPANS = "document long, file string, start long, n_tokens long, complete boolean"


def write_flat(docs: DataFrame, path: str, model: str, end_id: int = END_ID) -> None:
    """Encode all texts with a piece model and write them as flat files of 16-bit ids.

    Each document ends with ``end_id``, which the model never gives for text. The rows stay in the
    partitions they are in, and a partition makes a file for about every ``FILE_BYTES`` of text. A null text
    is a document of no ids but the end.

    The files are raw: the text writer puts out the bytes of each row as they are, and the
    end id as its line separator, for which its two bytes must be ASCII.
    """
    if not 0 < end_id < 128:
        raise ValueError("the end id must be from 1 to 127")

    @arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        encoder = piece_encoder(model)
        return pa.array([encoder.encode(text) for text in texts.to_pylist()], pa.binary())

    text = whole_text(F.col("text"))
    mean = docs.agg(F.avg(F.octet_length(text))).first()[0] or 1
    ids = docs.select(encode(text).cast("string").alias("value"))
    (
        ids.write.option("lineSep", chr(end_id) + "\x00")
        .option("compression", "none")
        .option("maxRecordsPerFile", max(1, int(FILE_BYTES // max(mean, 1))))
        .text(path)
    )


def _scan_blocks(end_id: int, dtype: str, block_ids: int):
    width = np.dtype(dtype).itemsize

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("file"), batch.column("content"), strict=True):
                raw = content.as_buffer()
                if raw is None or raw.size % width:
                    raise ValueError(f"{path} does not hold whole ids of {width} bytes")
                ids = np.frombuffer(raw, dtype)
                for block, at in enumerate(range(0, len(ids), block_ids)):
                    part = ids[at : at + block_ids]
                    ends = np.flatnonzero(part == end_id).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path.as_py()]),
                            pa.array([block], pa.int64()),
                            pa.array([len(part)], pa.int64()),
                            pa.array([ends], pa.list_(pa.int32())),
                        ],
                        names=["file", "block", "n_ids", "ends"],
                    )

    return scan


def read_blocks(
    spark: SparkSession, path: str, end_id: int = END_ID, dtype: str = DTYPE, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """(file, block, n_ids, ends): the places of the end id in each block of each file.

    A file is read by one task as a whole; ``write_flat`` bounds its size.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "[!._]*")
        .load(path)
        .select(F.col("path").alias("file"), "content")
    )
    return files.mapInArrow(_scan_blocks(end_id, dtype, block_ids), _BLOCKS)


def _joined(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """(ids, ends, ids after the last end) of two stretches one after the other."""
    return (
        left[0] + right[0],
        left[1] + right[1],
        right[2] if right[1] else left[2] + right[2],
    )


def _summary(n_ids: int, ends: np.ndarray) -> tuple[int, int, int]:
    return n_ids, len(ends), n_ids - int(ends[-1]) - 1 if len(ends) else n_ids


def _fold_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, part = (0, 0, 0), None
    for batch in batches:
        for i in range(batch.num_rows):
            part = batch.column("_part")[i].as_py()
            ends = batch.column("ends")[i].values
            ends = ends.to_numpy(zero_copy_only=False) if ends is not None else np.zeros(0, np.int32)
            total = _joined(total, _summary(batch.column("n_ids")[i].as_py(), ends))
    if part is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([value], pa.int64()) for value in (part, *total)],
            names=["part", "n_ids", "n_ends", "open"],
        )


def _spans(before: dict[int, tuple[int, int, int]], last_part: int):
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part, file = None, -1, None
        for batch in batches:
            for i in range(batch.num_rows):
                part, file = batch.column("_part")[i].as_py(), batch.column("file")[i].as_py()
                state = before[part] if state is None else state
                ends = batch.column("ends")[i].values.to_numpy(zero_copy_only=False)
                n_ids = batch.column("n_ids")[i].as_py()
                stops = state[0] + ends.astype(np.int64) + 1
                starts = np.concatenate(([state[0] - state[2]], stops[:-1])) if len(stops) else stops
                yield _span_rows(state[1], file, starts, stops, True)
                state = _joined(state, _summary(n_ids, ends))
        if part == last_part and state is not None and state[2]:
            yield _span_rows(state[1], file, np.array([state[0] - state[2]]), np.array([state[0]]), False)

    return spans


def _span_rows(
    first: int, file: str, starts: np.ndarray, stops: np.ndarray, complete: bool
) -> pa.RecordBatch:
    n = len(stops)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(first, first + n, dtype=np.int64)),
            pa.array([file] * n, pa.string()),
            pa.array(starts.astype(np.int64)),
            pa.array((stops - starts).astype(np.int64)),
            pa.array([complete] * n, pa.bool_()),
        ],
        names=["document", "file", "start", "n_tokens", "complete"],
    )


def count_tokens(
    spark: SparkSession, path: str, end_id: int = END_ID, dtype: str = DTYPE, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """(document, file, start, n_tokens, complete) of every document in the files at ``path``.

    The files, in the order of the numbers in their names and then of the names, are one stream; a document may reach over the edges
    of blocks and files, and belongs to the file it ends in. ``document`` counts from 0, ``start``
    is its first id's place in the stream, ``n_tokens`` includes the end id. Ids after the last
    end of all are one more document that is not ``complete``. No file, or empty files, give no row.
    """
    found = read_blocks(spark, path, end_id, dtype, block_ids)
    # Numbers in names are numbers, however many digits they have.
    name = F.substring_index("file", "/", -1)
    numbers = {
        "part": F.coalesce(F.try_to_number(F.regexp_extract(name, r"part-(\d+)", 1), F.lit("9" * 18)), F.lit(0)),
        "piece": F.coalesce(F.try_to_number(F.regexp_extract(name, r"-c(\d+)", 1), F.lit("9" * 18)), F.lit(0)),
    }
    # Stored first, as putting rows in order looks at them twice.
    blocks = in_order(checkpoint(found.withColumns(numbers)), "part", "piece", "file", "block")
    parts = blocks.select("_part", "n_ids", "ends").mapInArrow(
        _fold_parts, "part long, n_ids long, n_ends long, open long"
    )
    before, so_far, last_part = {}, (0, 0, 0), -1
    for row in sorted(parts.collect(), key=lambda row: row["part"]):  # one row for each partition
        before[row["part"]], last_part = so_far, row["part"]
        so_far = _joined(so_far, (row["n_ids"], row["n_ends"], row["open"]))
    kept = blocks.select("_part", "file", "n_ids", "ends")
    return kept.mapInArrow(_spans(before, last_part), _SPANS)
