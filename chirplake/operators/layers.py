"""The layers: bronze, silver, gold and the flagged variant of silver.

Each step is a pure DataFrame -> DataFrame function used by batch and stream
alike. All are narrow: no step here shuffles unless asked to spread the rows
before scoring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirplake.functions.labels import given_class_id, predicted_class_id
from chirplake.functions.scoring import PREDICTED, Scorer, lexicon_scorer
from chirplake.functions.text import (
    at_sign_flag,
    has_mention,
    mentions,
    parse_post_date,
    strip_mentions,
)


def to_bronze(raw: DataFrame) -> DataFrame:
    """Raw rows plus the file they came from and the time they were read."""
    return raw.withColumns(
        {
            "source_file": F.col("_metadata.file_path"),
            "processing_time": F.current_timestamp(),
        }
    )


def prepare_posts(bronze: DataFrame) -> DataFrame:
    """One row per post that holds an ``@``, date parsed and text cleaned.

    Dates and texts are worked on here, once per post, and not again for each
    of its mentions. The ``@`` test reaches the Parquet scan.
    """
    return bronze.filter(F.col("text").contains("@")).select(
        parse_post_date(F.col("date")).alias("timestamp"),
        "text",
        strip_mentions(F.col("text")).alias("cleaned_text"),
        "sentiment",
    )


def one_row_per_mention(posts: DataFrame) -> DataFrame:
    """Repeat each post for every mention in its text; posts without one vanish.

    The matcher stands inside the generator on purpose: over a named array column
    the optimizer adds a size filter that runs the matcher again.
    """
    kept = [name for name in posts.columns if name != "text"]
    return posts.select(F.explode(mentions(F.col("text"))).alias("mention"), *kept)


def to_silver(bronze: DataFrame) -> DataFrame:
    """One row per mention occurrence."""
    return one_row_per_mention(prepare_posts(bronze)).select(
        "timestamp", "mention", "cleaned_text", "sentiment"
    )


def to_gold(
    silver: DataFrame, scorer: Scorer = lexicon_scorer, partitions: int | None = None
) -> DataFrame:
    """Silver rows with the predicted sentiment and both class ids.

    ``partitions`` spreads the rows evenly first, which pays for a costly model
    behind few large scan partitions and is wasted on native scorers.
    """
    spread = silver if partitions is None else silver.repartition(partitions)
    return _with_classes(scorer(spread, "cleaned_text"))


def bronze_to_gold(
    bronze: DataFrame, scorer: Scorer = lexicon_scorer, partitions: int | None = None
) -> DataFrame:
    """Gold straight from bronze, scoring each post once instead of once per mention."""
    posts = prepare_posts(bronze).filter(has_mention(F.col("text")))
    spread = posts if partitions is None else posts.repartition(partitions)
    return _with_classes(one_row_per_mention(scorer(spread, "cleaned_text")))


def _with_classes(scored: DataFrame) -> DataFrame:
    return (
        scored.withColumns(
            {
                "predicted_score": F.col(f"{PREDICTED}.score") * 100,
                "predicted_sentiment": F.col(f"{PREDICTED}.label"),
            }
        )
        .drop(PREDICTED)
        .select(
            "timestamp",
            "mention",
            "cleaned_text",
            "sentiment",
            "predicted_score",
            "predicted_sentiment",
            given_class_id(F.col("sentiment")).alias("sentiment_id"),
            predicted_class_id(F.col("predicted_sentiment")).alias("predicted_sentiment_id"),
        )
    )


def silver_flags(bronze: DataFrame) -> DataFrame:
    """One row per post with text: the date as given, an @ flag and quality columns."""
    return bronze.filter(F.col("text").isNotNull()).select(
        F.col("date").alias("timestamp"),
        at_sign_flag(F.col("text")).alias("mention"),
        strip_mentions(F.col("text")).alias("text"),
        "sentiment",
        F.lit("silver").alias("data_layer"),
        F.current_timestamp().alias("processing_time"),
    )
