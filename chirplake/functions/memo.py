"""Scores kept by the content of the text, so that a text is scored once and for all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chirplake.functions.scoring import PREDICTED, Scorer
from chirplake.operators.skew import salted_join
from chirplake.schemas import PREDICTION
from chirplake.sources.tables import load_or_none

_KEY = "_text_key"
MEMO = StructType([StructField(_KEY, StringType()), StructField(PREDICTED, PREDICTION)])


def text_key(text: Column) -> Column:
    """The address of a text by its content; a missing text has one of its own."""
    return F.when(text.isNull(), F.lit("missing")).otherwise(F.sha2(text, 256))


def _known(df: DataFrame, path: str) -> DataFrame:
    stored = load_or_none(df.sparkSession.read.schema(MEMO).format("parquet"), path)
    return df.sparkSession.createDataFrame([], MEMO) if stored is None else stored


def score_unseen(df: DataFrame, text: str, path: str, scorer: Scorer) -> None:
    """Score the texts that the memo at ``path`` does not have, each once, and add them to it.

    Equal texts are folded in the map tasks before the shuffle. The scores of one run are committed together,
    so a run that breaks off leaves nothing behind. Only one run may add to a memo at a time.
    """
    column = F.col(f"`{text}`")
    texts = df.groupBy(text_key(column).alias(_KEY)).agg(F.min(column).alias("_text"))
    unseen = texts.join(_known(df, path).select(_KEY), _KEY, "left_anti")
    scorer(unseen, "_text").select(_KEY, PREDICTED).write.mode("append").parquet(path)


def memo_scorer(path: str, scorer: Scorer) -> Scorer:
    """``scorer`` with a memo: what has been scored in any earlier batch or run is looked up.

    A memo belongs to one model; give a new model a new ``path``. The scorer runs when it is applied to
    a table, not when the result is read. It takes tables and the batches of ``foreachBatch``, not streams.
    Texts that fill many rows are spread when the scores are joined back.
    """

    def score(df: DataFrame, text: str) -> DataFrame:
        score_unseen(df, text, path, scorer)
        keyed = df.withColumn(_KEY, text_key(F.col(f"`{text}`")))
        return salted_join(keyed, _known(df, path), _KEY, "left").select(*df.columns, PREDICTED)

    return score
