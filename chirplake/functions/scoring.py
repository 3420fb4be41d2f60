"""Sentiment scorers.

A scorer takes a DataFrame with a text column and adds ``prediction``, a struct
of ``label`` (POS, NEU or NEG) and ``score`` (0 to 1). Three are given:

* ``lexicon_scorer``: a word-count rule as native columns. It is a stand-in that
  makes results exact and testable; its accuracy says nothing about a trained model.
* ``model_scorer``: any Python model behind an iterator pandas UDF, loaded once
  per Python worker.
* ``pipeline_scorer``: a fitted Spark ML pipeline, found by name and stage.
"""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirplake.functions.labels import NEG, NEGATIVE_ID, NEU, POS, POSITIVE_ID, given_class_id
from chirplake.schemas import PREDICTION

Scorer = Callable[[DataFrame, str], DataFrame]
Model = Callable[[pd.Series], pd.DataFrame]

PREDICTED = "prediction"
# Models a worker process keeps.
MODELS_KEPT = 2
POSITIVE_WORDS = ("love", "great")
NEGATIVE_WORDS = ("hate", "awful")


def _count_words(text: Column, words: tuple[str, ...]) -> Column:
    """How often any of the words stands alone, by ASCII word characters.

    The literal comes before its look-behind so that the matcher can skip ahead,
    and a plain byte search spares texts that hold none of the words.
    """
    standing = "|".join(rf"{word}(?<!\w{word})" for word in words)
    present = reduce(Column.__or__, [text.contains(word) for word in words])
    return F.when(present, F.regexp_count(text, F.lit(rf"(?:{standing})(?!\w)"))).otherwise(0)


def lexicon_scorer(df: DataFrame, text: str) -> DataFrame:
    """More positive words give POS, more negative ones NEG, else NEU.

    The score is 0.5 for no evidence and grows to 1 with the lead of one side.
    """
    counted = df.withColumns(
        {
            "_positive": _count_words(F.col(text), POSITIVE_WORDS),
            "_negative": _count_words(F.col(text), NEGATIVE_WORDS),
        }
    )
    positive, negative = F.col("_positive"), F.col("_negative")
    label = F.when(positive > negative, POS).when(negative > positive, NEG).otherwise(NEU)
    lead = F.coalesce(
        F.try_divide(F.lit(0.5) * F.abs(positive - negative), positive + negative), F.lit(0.0)
    )
    struct = F.struct(label.alias("label"), (F.lit(0.5) + lead).alias("score"))
    return counted.withColumn(PREDICTED, struct).drop("_positive", "_negative")


def load_lexicon_model() -> Model:
    """The lexicon rule as a Python model, the shape a trained one would have."""
    positive, negative = (
        re.compile(rf"\b(?:{'|'.join(words)})\b", re.ASCII)
        for words in (POSITIVE_WORDS, NEGATIVE_WORDS)
    )

    def predict(texts: pd.Series) -> pd.DataFrame:
        known = texts.fillna("")
        up, down = known.str.count(positive), known.str.count(negative)
        evidence = up + down
        label = pd.Series(NEU, index=texts.index).mask(up > down, POS).mask(down > up, NEG)
        score = 0.5 + (0.5 * (up - down).abs() / evidence.where(evidence > 0)).fillna(0.0)
        return pd.DataFrame({"label": label, "score": score})

    return predict


def model_scorer(load_model: Callable[[], Model]) -> Scorer:
    """Apply a Python model batch by batch; ``load_model`` runs once per worker process.

    The model stays with the process, which serves many tasks, under a name of its own: this
    package reaches workers by value, anew for each task, so its globals would not last.

    A process keeps the few models it used last.

    Equal texts of a batch are scored once: the mentions of one post share their
    text, and a text that is posted over and over costs little.
    """

    model_id = uuid.uuid4().hex

    @F.pandas_udf(PREDICTION)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        module = sys.modules.setdefault("_chirplake_models", types.ModuleType("_chirplake_models"))
        kept = module.__dict__.setdefault("models", {})
        if model_id not in kept:
            while len(kept) >= MODELS_KEPT:
                del kept[next(iter(kept))]
            kept[model_id] = load_model()
        model = kept[model_id] = kept.pop(model_id)  # the last one used is the last to go
        for texts in batches:
            positions, distinct = pd.factorize(texts, use_na_sentinel=False)
            yield model(pd.Series(distinct)).iloc[positions].reset_index(drop=True)

    return lambda df, text: df.withColumn(PREDICTED, predict(F.col(text)))


def fit_pipeline(
    labelled: DataFrame, text: str = "cleaned_text", sentiment: str = "sentiment", features: int = 4096
) -> PipelineModel:
    """Fit words -> hashed counts -> logistic regression on the given labels.

    The feature count is fixed, so the model does not grow with the data, and each
    iteration sends back one gradient per partition.
    """
    training = labelled.select(
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        given_class_id(F.col(sentiment)).cast("double").alias("_class"),
    )
    return Pipeline(
        stages=[
            Tokenizer(inputCol="_text", outputCol="_words"),
            HashingTF(inputCol="_words", outputCol="_features", numFeatures=features),
            LogisticRegression(
                featuresCol="_features",
                labelCol="_class",
                predictionCol="_predicted",
                probabilityCol="_probability",
                rawPredictionCol="_raw",
                maxIter=10,
                regParam=0.01,
            ),
        ]
    ).fit(training)


def model_path(registry: str, name: str, stage: str) -> str:
    return f"{registry.rstrip('/')}/{name}/{stage}"


def publish_pipeline(model: PipelineModel, registry: str, name: str, stage: str) -> str:
    """Store a fitted pipeline under a name and stage, replacing the one before."""
    path = model_path(registry, name, stage)
    model.write().overwrite().save(path)
    return path


def pipeline_scorer(registry: str, name: str, stage: str = "production") -> Scorer:
    """Load a stored pipeline by name and stage and apply it as native columns."""
    model = PipelineModel.load(model_path(registry, name, stage))

    def score(df: DataFrame, text: str) -> DataFrame:
        ready = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
        label = (
            F.when(F.col("_predicted") == POSITIVE_ID, POS)
            .when(F.col("_predicted") == NEGATIVE_ID, NEG)
            .otherwise(NEU)
        )
        best = F.array_max(vector_to_array("_probability"))
        struct = F.struct(label.alias("label"), best.alias("score"))
        return model.transform(ready).withColumn(PREDICTED, struct).select(*df.columns, PREDICTED)

    return score
