"""The chain raw -> bronze -> silver -> gold -> application as streams.

Each stage has one definition, made of the same functions the batch queries use.
A stage appends to a table owned by it alone and keeps its place in a checkpoint
beside it, so a stage that is run again, or again after a failure, takes up what
is new and nothing twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from chirplake.functions.scoring import Scorer, lexicon_scorer
from chirplake.operators.application import application_partials, fold_partials, merge_partials
from chirplake.operators.layers import to_bronze, to_gold, to_silver
from chirplake.schemas import BRONZE, CORRUPT_RECORD, GOLD, RAW, SILVER, enforce
from chirplake.settings import Settings, configure
from chirplake.sources.folders import delete_folder, list_folders
from chirplake.sources.raw import raw_stream, with_corrupt_record
from chirplake.sources.tables import load_or_none, newest_batch, stream_table


# Batches whose partial results share a folder, so that a reader lists only the folders after a fold.
BATCHES_PER_SPAN = 100


@dataclass(frozen=True)
class Layout:
    """Where the tables and checkpoints of one pipeline lie."""

    root: str

    def table(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def checkpoint(self, layer: str) -> str:
        return f"{self.root}/checkpoints/{layer}"


def append_stream(df: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    """Append a stream to a table, batch by batch, until its source is drained."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start(path)
    )


def _append_layer(df: DataFrame, layout: Layout, layer: str) -> StreamingQuery:
    return append_stream(
        df, layout.table(layer), layout.checkpoint(layer), name=f"{layer}_stream"
    )


def bronze_stream(
    spark: SparkSession, landing: str, layout: Layout, settings: Settings, schema: StructType = RAW
) -> StreamingQuery:
    """Raw files to bronze. A ``schema`` with more columns makes the table wider."""
    bronze = to_bronze(raw_stream(spark, landing, settings, schema))
    return _append_layer(enforce(bronze, BRONZE, allow_new_columns=True), layout, "bronze")


def silver_stream(spark: SparkSession, layout: Layout, settings: Settings) -> StreamingQuery:
    bronze = stream_table(spark, layout.table("bronze"), BRONZE, settings)
    return _append_layer(enforce(to_silver(bronze), SILVER), layout, "silver")


def gold_stream(
    spark: SparkSession, layout: Layout, settings: Settings, scorer: Scorer = lexicon_scorer
) -> StreamingQuery:
    silver = stream_table(spark, layout.table("silver"), SILVER, settings)
    gold = to_gold(silver, scorer, settings.scoring_partitions)
    return _append_layer(enforce(gold, GOLD), layout, "gold")


def gold_batches(
    spark: SparkSession, layout: Layout, settings: Settings, scorer: Scorer
) -> StreamingQuery:
    """Silver to gold by a scorer that runs jobs of its own, such as one with a memo of scores.

    Each batch is scored as a table and kept in a folder of its own number, so a batch that is run
    twice replaces itself; what a memo has learnt from it the first time it looks up the second.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        gold = enforce(to_gold(batch, scorer, settings.scoring_partitions), GOLD)
        gold.write.mode("overwrite").parquet(f"{layout.table('gold_batches')}/batch_id={batch_id}")

    return (
        stream_table(spark, layout.table("silver"), SILVER, settings)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", layout.checkpoint("gold_batches"))
        .queryName("gold_batches_stream")
        .trigger(availableNow=True)
        .start()
    )


def read_gold_batches(spark: SparkSession, layout: Layout) -> DataFrame:
    """The gold rows of the batches that are committed."""
    newest = newest_batch(spark, layout.checkpoint("gold_batches"))
    if newest < 0:
        return spark.createDataFrame([], GOLD)
    schema = StructType([*GOLD.fields, StructField("batch_id", LongType())])
    stored = spark.read.schema(schema).parquet(layout.table("gold_batches"))
    return stored.filter(F.col("batch_id") <= newest).drop("batch_id")


def application_stream(spark: SparkSession, layout: Layout, settings: Settings) -> StreamingQuery:
    """Keep what each batch of gold adds to the application table.

    A batch writes its partial result to a folder of its own number, so a batch
    that is run twice replaces itself. No state is held between batches.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        span = _span_folder(layout, batch_id // BATCHES_PER_SPAN)
        application_partials(batch).write.mode("overwrite").parquet(f"{span}/batch_id={batch_id}")

    return (
        stream_table(spark, layout.table("gold"), GOLD, settings)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", layout.checkpoint("application"))
        .queryName("application_stream")
        .trigger(availableNow=True)
        .start()
    )


def _span_folder(layout: Layout, span: int) -> str:
    return f"{layout.table('application')}/span={span}"


def _newest_fold(spark: SparkSession, layout: Layout) -> tuple[int, str | None]:
    folds = load_or_none(spark.read.format("parquet"), layout.table("application_folds"))
    if folds is None:
        return -1, None
    newest = folds.orderBy(F.desc("upto")).first()
    return newest.upto, newest.path


def _application_partials(spark: SparkSession, layout: Layout, upto: int) -> DataFrame:
    """The newest fold and the partials of the committed batches after it.

    Only the spans with such batches are listed; those a fold covers whole may be deleted.
    """
    folded_upto, folded = _newest_fold(spark, layout)
    batch = F.col("batch_id")
    if upto <= folded_upto:  # nothing after the fold, or before the first batch
        partials = application_partials(spark.createDataFrame([], GOLD))
    else:
        spans = range((folded_upto + 1) // BATCHES_PER_SPAN, upto // BATCHES_PER_SPAN + 1)
        reader = spark.read.option("basePath", layout.table("application"))
        stored = reader.parquet(*[_span_folder(layout, span) for span in spans])
        partials = stored.filter((batch > folded_upto) & (batch <= upto)).drop("span", "batch_id")
    return partials if folded is None else partials.unionByName(spark.read.parquet(folded))


def read_application(spark: SparkSession, layout: Layout) -> DataFrame:
    """The application table so far: what all committed batches add up to."""
    newest = newest_batch(spark, layout.checkpoint("application"))
    return fold_partials(_application_partials(spark, layout, newest))


def fold_application(spark: SparkSession, layout: Layout) -> int:
    """Add the committed partials up once, so that later reads need only those after.

    The fold counts from the moment its one-row entry is written, so one that
    breaks off half-way is never read. Gives the last batch in it.
    """
    newest = newest_batch(spark, layout.checkpoint("application"))
    folded = f"{layout.table('application_folded')}/{uuid.uuid4().hex}"
    merge_partials(_application_partials(spark, layout, newest)).write.parquet(folded)
    entry = spark.createDataFrame([(newest, folded)], "upto bigint, path string")
    entry.coalesce(1).write.mode("append").parquet(layout.table("application_folds"))
    return newest


def retire_application(spark: SparkSession, layout: Layout, grace_seconds: float = 86_400) -> int:
    """Delete what the newest fold has made needless; gives the number of folders deleted.

    These are the spans it covers whole and the folds before it, once they and the fold have been there for
    the grace period, in which readers that began before the fold can end.
    """
    upto, folded = _newest_fold(spark, layout)
    folds = dict(list_folders(spark, layout.table("application_folded")))
    current = [age for folder, age in folds.items() if folded and folder.endswith(folded.rpartition("/")[2])]
    if not current or current[0] < grace_seconds:
        return 0
    old = [f for f, age in folds.items() if not f.endswith(folded.rpartition("/")[2]) and age >= grace_seconds]
    for span, age in list_folders(spark, layout.table("application")):
        number = span.rpartition("span=")[2]
        if number.isdigit() and (int(number) + 1) * BATCHES_PER_SPAN <= upto + 1 and age >= grace_seconds:
            old.append(span)
    return sum(delete_folder(spark, folder) for folder in old)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until a stream has worked off its source; raises if it failed."""
    query.awaitTermination()
    return query


def run_layers(
    spark: SparkSession,
    landing: str,
    layout: Layout,
    settings: Settings,
    scorer: Scorer = lexicon_scorer,
    schema: StructType | None = None,
) -> list[StreamingQuery]:
    """Run the three stages in order, each after the one before has ended.

    The session gets the run's settings first. Bronze keeps the source of lines that are no
    JSON, see ``rejected_lines``, unless ``schema`` says otherwise.
    """
    configure(spark, settings)
    schema = with_corrupt_record(RAW) if schema is None else schema
    return [
        drain(bronze_stream(spark, landing, layout, settings, schema)),
        drain(silver_stream(spark, layout, settings)),
        drain(gold_stream(spark, layout, settings, scorer)),
    ]


def rejected_lines(spark: SparkSession, layout: Layout) -> DataFrame:
    """(source_file, processing_time, line) of the landing lines that are no JSON."""
    kept = StructType([*BRONZE.fields, *with_corrupt_record(StructType()).fields])
    bronze = spark.read.schema(kept).parquet(layout.table("bronze"))
    return bronze.where(F.col(CORRUPT_RECORD).isNotNull()).select(
        "source_file", "processing_time", F.col(CORRUPT_RECORD).alias("line")
    )
