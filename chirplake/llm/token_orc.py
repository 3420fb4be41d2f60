"""Token ids in ORC: one row per document, in ascending order of document ids.

ORC keeps integers run-length encoded in stripes, with minima and maxima per row group and a Bloom
filter on the document ids. A reader takes stripes in parallel; a look-up by id skips files,
stripes and row groups by that metadata.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from chirplake.llm.common import checkpoint, in_order, part_offsets, text_tag, whole_text
from chirplake.llm.encoders import byte_encoder

END_ID = 0
ROWS_PER_INDEX = 1000
STRIPE_BYTES = 64 << 20


def _encoder(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    @arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        encoder = byte_encoder(path)
        encoded = [encoder.encode(text) + end for text in texts.to_pylist()]
        offsets = np.zeros(len(encoded) + 1, np.int32)
        np.cumsum([len(ids) // 4 for ids in encoded], out=offsets[1:])
        values = pa.array(np.frombuffer(b"".join(encoded), "<i4"))
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode all texts and write them at ``path``.

    Each document's ids end with ``end_id``; a null text is empty. Rows are sorted over all files:
    by id, null ids first, and rows of one id by ``tag``, the hash of their text, which the files keep.
    An empty table gives files without rows; a long text is encoded whole and stored as one row.
    """
    text = whole_text(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keys = ("doc_id", "tag")
    placed = rows.withColumn("tag", text_tag(F.col("text"))).repartitionByRange(*keys).sortWithinPartitions(*keys)
    encode = _encoder(tokenizer, end_id)
    (
        placed.select(*keys, encode("text").alias("ids"))
        .write.option("compression", "snappy")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, tag long, ids array<int>").orc(path)


@arrow_udf(LongType())
def _crc32(ids: pa.Array) -> pa.Array:
    offsets = ids.offsets.to_numpy()
    values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")
    return pa.array(
        [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.int64()
    )


def _with_starts(offsets: dict[int, int]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = None
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column("n_tokens").to_numpy()
            if start is None:
                start = offsets[batch.column("_part")[0].as_py()]
            ends = start + np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ends - lengths),
                    batch.column("n_tokens"),
                    batch.column("ids_crc32"),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )
            start = int(ends[-1])

    return add


def token_spans(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each stored document.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is the checksum of its ids
    as little-endian 32-bit numbers. The order is that of the files. Only four numbers per document
    are put in order, and only the sum of each partition comes to the driver.
    """
    read = tokens.select(
        "doc_id", "tag", F.size("ids").cast("long").alias("n_tokens"), _crc32("ids").alias("ids_crc32")
    )
    # Stored first, as putting rows in order looks at them twice.
    placed = in_order(checkpoint(read), "doc_id", "tag")
    offsets = part_offsets(placed, F.col("n_tokens"))
    columns = placed.select("doc_id", "n_tokens", "ids_crc32", "_part")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return columns.mapInArrow(_with_starts(offsets), schema)
