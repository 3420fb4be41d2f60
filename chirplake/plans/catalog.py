"""All registered queries by name. Each reads whole tables below ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from chirplake.functions.labels import given_class_id, predicted_class_id
from chirplake.functions.scoring import (
    PREDICTED,
    fit_pipeline,
    lexicon_scorer,
    load_lexicon_model,
    model_scorer,
    pipeline_scorer,
    publish_pipeline,
)
from chirplake.functions.text import (
    has_at_sign,
    has_mention,
    is_mention,
    parse_post_date,
    strip_mentions,
    token_count,
    token_text,
    tokens,
)
from chirplake.functions.memo import memo_scorer
from chirplake.operators import application as app
from chirplake.operators import balance, evaluation, layers, profiling, skew
from chirplake.operators.layers import bronze_to_gold, to_gold, to_silver
from chirplake.plans.posts import land, landing_files, posts
from chirplake.plans.runs import streamed_posts
from chirplake.schemas import BRONZE, CORRUPT_RECORD, GOLD, RAW, SILVER, STREAM_PROGRESS, TEXT
from chirplake.settings import Settings, configure, new_run_folder
from chirplake.sources import compaction, generations, raw, tables
from chirplake.streaming import landing as landings
from chirplake.streaming import monitor, stages
from chirplake.streaming.stages import Layout, append_stream, drain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Tables of the test data, profiled whole.
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
# Parts in which a table arrives to be compacted.
ARRIVALS = 10
TEXT_COLUMNS = {
    "documents": "text",
    "benchmark": "text",
    "conversations": "text",
    "pages": "html",
}


def query(build: Query) -> Query:
    """Register a query under the name of its function, with times shown without a zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        result = build(spark, sf_dir)
        zoned = [f.name for f in result.schema.fields if isinstance(f.dataType, TimestampType)]
        if not zoned:
            return result
        return result.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})

    QUERIES[build.__name__] = run
    return build


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(posts(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_to_gold(posts(spark, sf_dir))


# Layers


@query
def application_table(spark, sf_dir):
    return app.application_table(_gold(spark, sf_dir))


@query
def silver_mentions(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def silver_by_tokens(spark, sf_dir):
    """Mentions the long way: all tokens as rows, then a filter; counted per mention."""
    token = posts(spark, sf_dir).select(F.explode(tokens(F.col("text"))).alias("mention"))
    return token.filter(is_mention(F.col("mention"))).groupBy("mention").agg(
        F.count("*").alias("rows")
    )


@query
def gold_scored(spark, sf_dir):
    return to_gold(_silver(spark, sf_dir))


@query
def gold_scored_per_post(spark, sf_dir):
    return _gold(spark, sf_dir)


@query
def silver_flags(spark, sf_dir):
    return layers.silver_flags(posts(spark, sf_dir)).withColumn(
        "has_processing_time", F.col("processing_time").isNotNull()
    ).drop("processing_time")


# Scalar functions, per post


@query
def parsed_timestamp(spark, sf_dir):
    return posts(spark, sf_dir).select(
        "post_id", "date", parse_post_date(F.col("date")).alias("timestamp")
    )


@query
def cleaned_text(spark, sf_dir):
    return posts(spark, sf_dir).select("post_id", strip_mentions(F.col("text")).alias("cleaned_text"))


@query
def post_tokens(spark, sf_dir):
    return posts(spark, sf_dir).select(
        "post_id",
        token_text(F.col("text")).alias("token_text"),
        F.array_size(tokens(F.col("text"))).cast("bigint").alias("tokens"),
    )


@query
def class_ids(spark, sf_dir):
    scored = lexicon_scorer(posts(spark, sf_dir), "text")
    return scored.select(
        "post_id",
        given_class_id(F.col("sentiment")).alias("sentiment_id"),
        predicted_class_id(F.col(f"{PREDICTED}.label")).alias("predicted_sentiment_id"),
    )


@query
def text_tables_presence(spark, sf_dir):
    """At-signs, mentions and tokens in the whole texts of every text table."""

    def profile(table: str, column: str) -> DataFrame:
        text = F.col(column)
        return (
            spark.read.parquet(f"{sf_dir}/{table}.parquet")
            .agg(
                F.count("*").alias("rows"),
                F.count_if(has_at_sign(text)).alias("with_at_sign"),
                F.count_if(has_mention(text)).alias("with_mention"),
                F.sum(token_count(text).cast("bigint")).alias("tokens"),
                F.sum(F.length(strip_mentions(text)).cast("bigint")).alias("cleaned_chars"),
            )
            .withColumn("table_name", F.lit(table))
        )

    return reduce(DataFrame.unionByName, [profile(*entry) for entry in TEXT_COLUMNS.items()])


# Profiles


@query
def layer_row_counts(spark, sf_dir):
    run = streamed_posts(spark, sf_dir)
    return profiling.row_counts({"bronze": run.bronze, "silver": run.silver, "gold": run.gold})


@query
def layer_preview(spark, sf_dir):
    return profiling.preview(_gold(spark, sf_dir))


@query
def silver_preview(spark, sf_dir):
    return profiling.preview(_silver(spark, sf_dir))


@query
def bronze_preview(spark, sf_dir):
    return profiling.preview(streamed_posts(spark, sf_dir).bronze.select(*RAW.names))


@query
def null_profile(spark, sf_dir):
    return profiling.null_profile(posts(spark, sf_dir), "posts")


@query
def null_profile_all_tables(spark, sf_dir):
    profiles = [
        profiling.null_profile(spark.read.parquet(f"{sf_dir}/{name}.parquet"), name)
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, profiles)


@query
def posts_per_user(spark, sf_dir):
    return profiling.posts_per_user(posts(spark, sf_dir))


@query
def top_users(spark, sf_dir):
    return profiling.top_users(posts(spark, sf_dir))


@query
def at_sign_presence(spark, sf_dir):
    return profiling.at_sign_presence(posts(spark, sf_dir))


@query
def mention_presence(spark, sf_dir):
    return profiling.mention_presence(posts(spark, sf_dir))


@query
def key_skew_profile(spark, sf_dir):
    return profiling.key_skew(_silver(spark, sf_dir), "mention")


@query
def partition_balance(spark, sf_dir):
    """Rows of silver per partition a shuffle on the mention would make; no row is moved to find out."""
    silver = _silver(spark, sf_dir)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return profiling.balance_of_sizes(skew.partition_sizes(silver, "mention", partitions))


@query
def heavy_mentions(spark, sf_dir):
    """Mentions with a hundredth of all rows: whether the sketch gives them, and bounds that hold."""
    silver = _silver(spark, sf_dir)
    counted = silver.groupBy("mention").agg(F.count("*").alias("rows"))
    given = skew.heavy_keys(silver, "mention", 0.01).drop("rows")
    heavy = counted.where(F.col("rows") * 100 >= F.lit(silver.count()))
    return heavy.join(F.broadcast(given), "mention", "left").select(
        "mention",
        "rows",
        F.col("at_most").isNotNull().alias("is_given"),
        F.col("rows").between(F.col("at_least"), F.col("at_most")).alias("is_inside"),
    )


@query
def length_quantile_bounds(spark, sf_dir):
    """Quantiles of the bytes of all posts by a sketch, and whether their true ranks are near."""
    frame = posts(spark, sf_dir).select(F.octet_length("text").alias("size")).where("size is not null")
    shares = (0.05, 0.25, 0.5, 0.75, 0.95)
    given = skew.length_quantiles(frame, F.col("size"), shares).collect()
    ranks = [
        F.struct(
            F.lit(row["share"]).alias("share"),
            (F.count_if(F.col("size") < row["quantile"]) / F.count("*")).alias("below"),
            (F.count_if(F.col("size") <= row["quantile"]) / F.count("*")).alias("upto"),
        )
        for row in given
    ]
    each = frame.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks"))
    off = F.lit(skew.QUANTILE_ERROR)
    near = (F.col("below") <= F.col("share") + off) & (F.col("upto") >= F.col("share") - off)
    return each.select("share", near.alias("is_near"))


@query
def salted_join_counts(spark, sf_dir):
    """Gold with the number of rows of its mention, heavy mentions spread over many tasks."""
    gold = _gold(spark, sf_dir)
    counted = app.salted_mention_totals(gold, Settings().salts)
    joined = skew.salted_join(gold, counted, "mention", salts=Settings().salts)
    return joined.select("timestamp", "mention", "predicted_sentiment", "total")


# Application


@query
def mention_total(spark, sf_dir):
    return app.mention_total(_gold(spark, sf_dir))


@query
def mention_pivot(spark, sf_dir):
    return app.mention_pivot(_gold(spark, sf_dir))


@query
def mention_time_range(spark, sf_dir):
    return app.mention_time_range(_gold(spark, sf_dir))


@query
def top_positive_mentions(spark, sf_dir):
    return app.top_mentions(_gold(spark, sf_dir), "positive")


@query
def top_negative_mentions(spark, sf_dir):
    return app.top_mentions(_gold(spark, sf_dir), "negative")


@query
def most_mentioned(spark, sf_dir):
    return app.top_mentions(_gold(spark, sf_dir), "total", 10)


@query
def salted_mention_totals(spark, sf_dir):
    return app.salted_mention_totals(_gold(spark, sf_dir), Settings().salts)


# Evaluation


@query
def classifier_metrics(spark, sf_dir):
    return evaluation.classifier_metrics(_gold(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(_gold(spark, sf_dir))


@query
def per_class_metrics(spark, sf_dir):
    return evaluation.per_class_metrics(_gold(spark, sf_dir))


@query
def evaluation_run(spark, sf_dir):
    """A stored run over the streamed gold table; values that differ per run only as present."""
    run = streamed_posts(spark, sf_dir)
    gold, home = run.gold, new_run_folder(spark, "evaluation")
    artifact = f"{home}/confusion_matrix"
    evaluation.cell_counts(gold).write.parquet(f"{home}/cells")
    cells = spark.read.parquet(f"{home}/cells")
    evaluation.matrix_of_cells(cells).write.parquet(artifact)
    rows = evaluation.evaluation_run(
        gold,
        run_name="post_scores",
        params={
            "scorer": "lexicon",
            "engine_version": spark.version,
            "silver_batch": str(
                tables.newest_batch(spark, run.layout.checkpoint("silver"))
            ),
            "scored_table": run.layout.table("gold"),
        },
        tags={"task": "post sentiment", "posts_from": "events", "layer": "gold"},
        artifacts={"confusion_matrix": artifact},
        cells=cells,
    )
    evaluation.record_run(rows, f"{home}/runs")
    varying = ["engine_version", "silver_batch", "scored_table", "confusion_matrix"]
    is_metric = F.col("kind") == "metric"
    return tables.read_table(spark, f"{home}/runs").select(
        "run_name",
        "kind",
        "key",
        F.when(~is_metric & ~F.col("key").isin(varying), F.col("value")).alias("text_value"),
        F.when(is_metric, F.col("value").cast("double")).alias("metric_value"),
        (F.col("run_id").isNotNull() & F.col("value").isNotNull()).alias("is_set"),
    )


# Scorers


@query
def scorer_agreement(spark, sf_dir):
    """The native scorer against the same rule as a Python model, row by row."""
    both = model_scorer(load_lexicon_model)(
        lexicon_scorer(_silver(spark, sf_dir), "cleaned_text").withColumnRenamed(
            PREDICTED, "native"
        ),
        "cleaned_text",
    )
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("native").eqNullSafe(F.col(PREDICTED))).alias("different"),
    )


@query
def gold_model_scored(spark, sf_dir):
    """Gold by the Python model, each post scored once."""
    return bronze_to_gold(posts(spark, sf_dir), model_scorer(load_lexicon_model))


@query
def gold_memo_scored(spark, sf_dir):
    """Gold in two batches over one memo of scores: the second looks most of its texts up."""
    frame = posts(spark, sf_dir)
    scorer = memo_scorer(
        f"{new_run_folder(spark, 'memo')}/lexicon", model_scorer(load_lexicon_model)
    )
    is_early = F.col("sentiment") != "negative"
    return bronze_to_gold(frame.filter(is_early), scorer).unionByName(
        bronze_to_gold(frame.filter(~is_early), scorer)
    )


@query
def gold_memo_stream(spark, sf_dir):
    """Gold batch by batch from the stream of silver, texts scored once over all batches."""
    run = streamed_posts(spark, sf_dir)
    run.silver  # noqa: B018
    memo = f"{new_run_folder(spark, 'memo')}/lexicon"
    scorer = memo_scorer(memo, model_scorer(load_lexicon_model))
    drain(stages.gold_batches(spark, run.layout, Settings(files_per_trigger=4), scorer))
    return stages.read_gold_batches(spark, run.layout)


@query
def gold_cost_balanced(spark, sf_dir):
    """Gold by the Python model, silver first cut into partitions of equally many text bytes."""
    silver = _silver(spark, sf_dir)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cost = F.octet_length("cleaned_text") + F.lit(1)
    return to_gold(balance.by_cost(silver, cost, partitions), model_scorer(load_lexicon_model))


@query
def ml_scored(spark, sf_dir):
    """Gold by a pipeline fitted on the given labels, stored and loaded by name and stage."""
    frame = posts(spark, sf_dir)
    labelled = frame.withColumn("cleaned_text", strip_mentions(F.col("text")))
    registry = new_run_folder(spark, "models")
    publish_pipeline(fit_pipeline(labelled), registry, "post-sentiment", "production")
    return bronze_to_gold(frame, pipeline_scorer(registry, "post-sentiment"))


@query
def ml_scored_profile(spark, sf_dir):
    """What holds for any fitted model: known labels, scores in range, one prediction per text."""
    by_text = ml_scored(spark, sf_dir).groupBy("cleaned_text").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("predicted_sentiment").isin("POS", "NEG", "NEU")).alias("known"),
        F.count_if(F.col("predicted_score").between(0, 100)).alias("in_range"),
        (F.count_distinct("predicted_sentiment", "predicted_score") > 1).alias("torn"),
    )
    return by_text.agg(
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known_labels"),
        F.sum("in_range").alias("scores_in_range"),
        F.count_if("torn").alias("texts_with_two_predictions"),
    )


# Raw files


@query
def source_file_inventory(spark, sf_dir):
    return raw.list_files(spark, streamed_posts(spark, sf_dir).landing)


@query
def source_file_totals(spark, sf_dir):
    return raw.count_files(spark, streamed_posts(spark, sf_dir).landing)


@query
def json_inferred_scan(spark, sf_dir):
    return raw.peek_json(spark, streamed_posts(spark, sf_dir).landing)


@query
def text_line_scan(spark, sf_dir):
    return raw.peek_text(spark, streamed_posts(spark, sf_dir).landing)


# Streams


@query
def bronze_stream(spark, sf_dir):
    return streamed_posts(spark, sf_dir).bronze.select(
        *RAW.names,
        F.col("source_file").isNotNull().alias("has_source_file"),
        F.col("processing_time").isNotNull().alias("has_processing_time"),
    )


@query
def silver_stream(spark, sf_dir):
    return streamed_posts(spark, sf_dir).silver


@query
def gold_stream(spark, sf_dir):
    return streamed_posts(spark, sf_dir).gold


@query
def application_stream(spark, sf_dir):
    return streamed_posts(spark, sf_dir).application


@query
def table_streamed_directly(spark, sf_dir):
    """The events table itself as a stream, appended to a table of its own."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    layout = Layout(new_run_folder(spark, "events"))
    stream = tables.stream_table(spark, f"{sf_dir}/events*.parquet", events, Settings())
    drain(append_stream(stream, layout.table("events"), layout.checkpoint("events"), "events_stream"))
    return tables.read_table(spark, layout.table("events"), events)


@query
def rows_per_source_file(spark, sf_dir):
    return streamed_posts(spark, sf_dir).bronze.groupBy("source_file").agg(F.count("*").alias("rows"))


@query
def source_file_coverage(spark, sf_dir):
    return streamed_posts(spark, sf_dir).bronze.agg(
        F.count_distinct("source_file").alias("files"),
        F.count("*").alias("rows"),
        F.count_if(F.col("source_file").isNull()).alias("rows_without_file"),
    )


@query
def batches_per_stream(spark, sf_dir):
    """How many bronze batches took how many files; a batch has one processing time."""
    batches = streamed_posts(spark, sf_dir).bronze.groupBy("processing_time").agg(
        F.count_distinct("source_file").alias("files_in_batch")
    )
    return batches.groupBy("files_in_batch").agg(F.count("*").alias("batches"))


@query
def rerun_is_noop(spark, sf_dir):
    """Silver run again on its checkpoint with nothing new: no row is read, none added."""
    run = streamed_posts(spark, sf_dir)
    run.silver  # noqa: B018
    watched = f"{new_run_folder(spark, 'rerun')}/progress"
    with monitor.ProgressLog(spark, watched) as log:
        log.await_end(drain(stages.silver_stream(spark, run.layout, run.settings)))
    seen = tables.load_or_none(spark.read.schema(STREAM_PROGRESS).format("parquet"), watched)
    reread = 0 if seen is None else seen.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return tables.read_table(spark, run.layout.table("silver"), SILVER).agg(
        F.count("*").alias("rows"), F.lit(reread).cast("bigint").alias("rows_read_again")
    )


@query
def incremental_ingest(spark, sf_dir):
    """Two arrivals into one folder, one run after each: the second reads only what is new."""
    frame = posts(spark, sf_dir)
    files = landing_files(frame.count())
    layout = Layout(new_run_folder(spark, "incremental"))
    landing, settings = layout.table("landing"), Settings()
    is_early = F.col("sentiment") != "negative"

    land(frame.filter(is_early), landing, files)
    drain(stages.bronze_stream(spark, landing, layout, settings))
    first_end = tables.read_table(spark, layout.table("bronze"), BRONZE).agg(
        F.max("processing_time")
    ).first()[0]
    land(frame.filter(~is_early), landing, files)
    drain(stages.bronze_stream(spark, landing, layout, settings))

    run = F.when(F.col("processing_time") <= F.lit(first_end), 1).otherwise(2)
    bronze = tables.read_table(spark, layout.table("bronze"), BRONZE)
    return bronze.groupBy(run.alias("run"), "sentiment").agg(F.count("*").alias("rows"))


@query
def schema_merge_read(spark, sf_dir):
    """A second arrival brings a new column; the stream restarts with the wider schema."""
    frame = posts(spark, sf_dir, "event_type")
    files = landing_files(frame.count())
    layout = Layout(new_run_folder(spark, "evolving"))
    landing, settings = layout.table("landing"), Settings()
    is_early = F.col("sentiment") != "negative"

    land(frame.filter(is_early).drop("event_type"), landing, files)
    drain(stages.bronze_stream(spark, landing, layout, settings))
    land(frame.filter(~is_early), landing, files)
    wider = StructType([*RAW.fields, StructField("event_type", TEXT, True)])
    drain(stages.bronze_stream(spark, landing, layout, settings, schema=wider))

    return tables.read_merged(spark, layout.table("bronze")).select(*wider.names)


@query
def malformed_json_split(spark, sf_dir):
    """Landing lines of which some lack their closing brace: rows kept, lines put aside."""
    frame = posts(spark, sf_dir)
    files = landing_files(frame.count())
    layout = Layout(new_run_folder(spark, "malformed"))
    landing, settings = layout.table("landing"), Settings()

    line = F.to_json(F.struct(*RAW.names))
    broken = F.col("post_id") % 97 == 0
    lines = frame.select(F.when(broken, F.rtrim(line, F.lit("}"))).otherwise(line).alias("value"))
    lines.repartition(files).write.text(landing)
    drain(stages.bronze_stream(spark, landing, layout, settings, raw.with_corrupt_record(RAW)))

    good, bad = raw.split_malformed(tables.read_merged(spark, layout.table("bronze")))
    as_rows = good.select(*RAW.names, F.lit(None).cast("string").alias("rejected_line"))
    as_lines = bad.select(*RAW.names, F.col(CORRUPT_RECORD).alias("rejected_line"))
    return as_rows.unionByName(as_lines)


@query
def nested_landing_ingest(spark, sf_dir):
    """Posts landed at several depths, all of them read."""
    frame = posts(spark, sf_dir)
    files = landing_files(frame.count())
    layout = Layout(new_run_folder(spark, "nested"))
    landing = layout.table("landing")
    is_early = F.col("sentiment") != "negative"
    land(frame.filter(is_early), landing, files)
    land(frame.filter(~is_early), f"{landing}/2026/12", files)
    drain(stages.bronze_stream(spark, landing, layout, Settings()))
    return tables.read_table(spark, layout.table("bronze"), BRONZE).select(*RAW.names)


@query
def archived_landing(spark, sf_dir):
    """Three arrivals in one landing folder, which is empty again after each."""
    frame = posts(spark, sf_dir)
    files = landing_files(frame.count())
    layout = Layout(new_run_folder(spark, "archived"))
    folder = layout.table("landing")
    settings = replace(Settings(), archive=layout.table("archive"))
    left = 0
    for sentiment in ("positive", "neutral", "negative"):
        land(frame.filter(F.col("sentiment") == sentiment), folder, files)
        left += landings.ingest_and_archive(spark, folder, layout, settings)
    bronze = tables.read_table(spark, layout.table("bronze"), BRONZE).select(*RAW.names)
    return bronze.withColumn("files_left", F.lit(left).cast("bigint"))


@query
def chained_quarantine(spark, sf_dir):
    """Layers run over lines of which some are broken: the mentions, and the lines put aside."""
    frame = posts(spark, sf_dir)
    layout = Layout(new_run_folder(spark, "quarantine"))
    landing = layout.table("landing")
    line = F.to_json(F.struct(*RAW.names))
    broken = F.col("post_id") % 97 == 0
    lines = frame.select(F.when(broken, F.rtrim(line, F.lit("}"))).otherwise(line).alias("value"))
    lines.repartition(landing_files(frame.count())).write.text(landing)
    stages.run_layers(spark, landing, layout, Settings())
    gold = tables.read_table(spark, layout.table("gold"), GOLD)
    good = gold.select("mention", "cleaned_text", F.lit(None).cast("string").alias("rejected_line"))
    bad = stages.rejected_lines(spark, layout).select(
        F.lit(None).cast("string").alias("mention"),
        F.lit(None).cast("string").alias("cleaned_text"),
        F.col("line").alias("rejected_line"),
    )
    return good.unionByName(bad)


@query
def table_versions(spark, sf_dir):
    """The version of bronze: the last of its batches, which the files and the trigger fix."""
    run = streamed_posts(spark, sf_dir)
    run.bronze  # noqa: B018
    version = tables.newest_batch(spark, run.layout.checkpoint("bronze"))
    return run.bronze.groupBy().agg(F.lit(version).cast("bigint").alias("bronze_version"))


# Tables and monitoring


def _progress_of_events(event: DataFrame) -> DataFrame:
    number = F.col("event_id")
    return event.select(
        F.col("ts").cast("timestamp").alias("observed_at"),
        F.col("event_type").alias("stream"),
        number.alias("batch_id"),
        (number % 13).alias("rows"),
        F.when(number % 5 != 0, number % 700).alias("duration_ms"),
    )


@query
def throughput_of_events(spark, sf_dir):
    """The throughput report over events taken as progress rows."""
    progress = _progress_of_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return monitor.throughput(progress).withColumn(
        "slot_start", F.col("slot_start").cast("timestamp_ntz")
    )


@query
def live_throughput_of_events(spark, sf_dir):
    """The same report as a stream over the rows in the order of time, given slot by slot."""
    progress = _progress_of_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    layout = Layout(new_run_folder(spark, "live"))
    rows, report = layout.table("progress"), layout.table("throughput")
    span = progress.agg(F.min("observed_at").alias("first"), F.max("observed_at").alias("last")).first()
    # Files may be taken in any order, so a row is late by the whole span at most.
    late = span["last"] - span["first"] + timedelta(minutes=1)
    progress.write.parquet(rows)
    stages.drain(_live(spark, layout, late))
    monitor.closing_row(spark, span["last"] + 2 * late).coalesce(1).write.mode("append").parquet(rows)
    stages.drain(_live(spark, layout, late))
    return tables.read_table(spark, report)


def _live(spark: SparkSession, layout: Layout, late: timedelta):
    stream = tables.stream_table(spark, layout.table("progress"), STREAM_PROGRESS, Settings())
    report = monitor.live_throughput(stream, late=f"{int(late.total_seconds())} seconds")
    return append_stream(report, layout.table("throughput"), layout.checkpoint("throughput"), "throughput_stream")


@query
def compacted_table(spark, sf_dir):
    run = streamed_posts(spark, sf_dir)
    run.gold  # noqa: B018
    target = f"{new_run_folder(spark, 'compacted')}/gold"
    return tables.compact(spark, run.layout.table("gold"), target, Settings().target_file_bytes)


@query
def compacted_then_appended(spark, sf_dir):
    """Bronze compacted between two arrivals and after them, then read whole."""
    frame = posts(spark, sf_dir)
    files = landing_files(frame.count())
    layout = Layout(new_run_folder(spark, "compacting"))
    landing, settings = layout.table("landing"), Settings()
    table, size = layout.table("bronze"), settings.target_file_bytes
    arrivals = ("positive", "neutral", "negative")
    for sentiment in arrivals:
        land(frame.filter(F.col("sentiment") == sentiment), landing, files)
        drain(stages.bronze_stream(spark, landing, layout, settings))
        if sentiment != arrivals[-1]:
            compaction.compact_table(spark, table, size, BRONZE)
    return compaction.read_current(spark, table, BRONZE).select(*RAW.names)


@query
def levelled_compaction(spark, sf_dir):
    """Gold arriving in ten parts, compacted after each: all rows, from a number of copies that stays small."""
    gold = _gold(spark, sf_dir)
    path = f"{new_run_folder(spark, 'levelled')}/gold"
    part = F.pmod(F.xxhash64("mention", "timestamp"), F.lit(ARRIVALS))
    for number in range(ARRIVALS):
        gold.filter(part == number).coalesce(4).write.mode("append").parquet(path)
        compaction.compact_table(spark, path, Settings().target_file_bytes, GOLD)
    copies = len(compaction.copies_of(spark, path))
    current = compaction.read_current(spark, path, GOLD)
    return current.withColumn("few_copies", F.lit(copies <= ARRIVALS.bit_length()))


@query
def clustered_mention(spark, sf_dir):
    """The rows of one mention, read from gold laid out by mention and time."""
    path = f"{new_run_folder(spark, 'clustered')}/gold"
    _gold(spark, sf_dir).write.parquet(path)
    cluster = compaction.Cluster("mention", "timestamp")
    compaction.compact_table(spark, path, Settings().target_file_bytes, GOLD, cluster)
    return compaction.read_current(spark, path, GOLD).filter(F.col("mention") == "@h3")


@query
def reconciled_generations(spark, sf_dir):
    """Posts whose user was a number in a table's first files and is text in the later ones."""
    event = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = f"{new_run_folder(spark, 'generations')}/posts"
    early = F.col("event_id") % 2 == 0
    number, name = F.col("user_id").cast("int"), F.concat(F.lit("user"), F.col("user_id"))
    event.filter(early).select("event_id", number.alias("user")).write.parquet(path)
    later = event.filter(~early).select("event_id", name.alias("user"), "event_type")
    later.write.mode("append").parquet(path)
    return generations.read_reconciled(spark, path)


@query
def file_size_profile(spark, sf_dir):
    """Files and sizes per layer as the streams left them."""
    run = streamed_posts(spark, sf_dir)
    run.gold  # noqa: B018
    profiles = [
        tables.file_profile(spark, run.layout.table(layer)).withColumn("layer", F.lit(layer))
        for layer in ("bronze", "silver", "gold")
    ]
    return reduce(DataFrame.unionByName, profiles)


@query
def stream_progress(spark, sf_dir):
    return streamed_posts(spark, sf_dir).progress


@query
def stream_throughput(spark, sf_dir):
    return monitor.throughput(streamed_posts(spark, sf_dir).progress)


@query
def stream_rows(spark, sf_dir):
    return monitor.rows_per_stream(streamed_posts(spark, sf_dir).progress)
