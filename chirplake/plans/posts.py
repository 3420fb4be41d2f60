"""Posts derived from the events table, one per event, and their landing files."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplake.settings import new_run_folder

# The shapes of a post's text, and what fills {w}. {k} and {j} are handles.
SHAPES = (
    "{w}",
    "@{k} {w}",
    "{w} @{k}",
    "@{k} @{j} {w}",
    "mail {k}@example.com {w}",
    "@{k}@{j} {w}",
    "@@{k} {w}",
    "(@{k}), {w}!",
    "a @ b {w}",
    "@{k} @{k} {w}",
    None,
    "@José {w}",
)
WORDS = ("love it", "great day", "so so", "hate it", "awful news")
ROWS_PER_FILE = 1_000_000
FEWEST_FILES = 12


def posts(spark: SparkSession, sf_dir: str, *carried: str) -> DataFrame:
    """All events as posts: post_id, date, user, text, sentiment, and event columns carried along."""
    event = F.col("event_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        event.alias("post_id"),
        _date().alias("date"),
        F.when(event % 211 != 0, F.concat(F.lit("user"), F.col("user_id"))).alias("user"),
        _text().alias("text"),
        _sentiment().alias("sentiment"),
        *carried,
    )


def _date() -> Column:
    event, text = F.col("event_id"), F.date_format("ts", "EEE MMM dd HH:mm:ss 'UTC' yyyy")
    return F.when(event % 101 == 0, None).when(event % 103 == 0, "not a date").otherwise(text)


def _text() -> Column:
    """Shape and words go by the event's number; the two cycles together are one of 60."""
    cycle = math.lcm(len(SHAPES), len(WORDS))
    pairs = [(SHAPES[i % len(SHAPES)], WORDS[i % len(WORDS)]) for i in range(cycle)]
    choices = [F.lit(shape and shape.replace("{w}", words)) for shape, words in pairs]
    text = F.element_at(F.array(*choices), (F.col("event_id") % cycle + 1).cast("int"))
    k = F.concat(F.lit("h"), F.col("user_id") % 23)
    j = F.concat(F.lit("h"), F.col("event_id") % 7)
    return F.replace(F.replace(text, F.lit("{k}"), k), F.lit("{j}"), j)


def _sentiment() -> Column:
    event_type = F.col("event_type")
    return (
        F.when(event_type.isin("purchase", "signup"), "positive")
        .when(event_type == "view", "neutral")
        .otherwise("negative")
    )


def landing_files(rows: int) -> int:
    """Files to land for a number of posts: they grow in number and not in size."""
    return max(FEWEST_FILES, math.ceil(rows / ROWS_PER_FILE))


def land(posts_frame: DataFrame, folder: str, files: int) -> str:
    """Write posts as JSON lines, spread evenly over a number of files."""
    posts_frame.drop("post_id").repartition(files).write.mode("append").json(folder)
    return folder


def land_all(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Land all posts in a new folder; gives the folder and its number of files."""
    frame = posts(spark, sf_dir)
    files = landing_files(frame.count())
    return land(frame, new_run_folder(spark, "landing"), files), files
