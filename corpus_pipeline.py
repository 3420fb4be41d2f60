"""The corpus pipeline: five stages over the documents, each calling one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplake.llm import decontaminate, host_rules, line_dedup, piece_fst, simhash
from chirplake.llm.common import prepare, table
from chirplake.llm.queries import PIECE_MODEL, tokenizer_file
from chirplake.settings import new_run_folder
from chirplake.sources.folders import delete_folder


# Fewer than the operator alone would remember: the workers and the JVM have served four stages before.
REMEMBERED_CHUNKS = 300_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or come from a host that does, go."""
    prepare(spark)
    return host_rules.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; ``n_chars`` follows the text."""
    prepare(spark)
    deduped = line_dedup.dedup_lines(docs)
    return deduped.withColumn("n_chars", F.char_length("text").cast("long")).select(
        *[F.col(f"`{name}`") for name in docs.columns]
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    prepare(spark)
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    prepare(spark)
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with what they decode to in place of the text."""
    prepare(spark)
    model = tokenizer_file(PIECE_MODEL)
    encoded = piece_fst.encode(docs.select("doc_id", "text"), model, memory=REMEMBERED_CHUNKS)
    return piece_fst.decode(encoded, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# The stages rest on hashes, components and a tokenizer that SQL does not have.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next.

    What a stage has read is deleted once its own result is written.
    """
    docs, read = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = new_run_folder(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if read is not None:
            delete_folder(spark, read)
        docs, read = spark.read.parquet(path), path
    return docs
