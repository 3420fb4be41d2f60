from __future__ import annotations

import subprocess
import sys

import pandas as pd
import pytest
from helpers import assert_same_rows, plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

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
from chirplake.operators.layers import bronze_to_gold, to_gold, to_silver
from chirplake.plans.posts import posts


def test_given_class_ids(spark):
    labels = ["positive", "negative", "neutral", None, "Positive"]
    frame = spark.createDataFrame([(label,) for label in labels], "sentiment string")
    assert rows(frame.select(given_class_id(F.col("sentiment")))) == [(1,), (0,), (2,), (2,), (2,)]


def test_predicted_class_ids(spark):
    frame = spark.createDataFrame([("POS",), ("NEU",), ("NEG",), (None,)], "label string")
    assert rows(frame.select(predicted_class_id(F.col("label")))) == [(1,), (0,), (0,), (0,)]


LEXICON = [
    ("love it", "POS", 1.0),
    ("hate love great", "POS", 0.5 + 0.5 / 3),
    ("hate awful love", "NEG", 0.5 + 0.5 / 3),
    ("love hate", "NEU", 0.5),
    ("lovely greatness", "NEU", 0.5),
    ("glove LOVE", "NEU", 0.5),
    ("élove, lové love-love", "POS", 1.0),
    ("love_ _love", "NEU", 0.5),
    ("lovelove", "NEU", 0.5),
    ("", "NEU", 0.5),
    (None, "NEU", 0.5),
]
SCORERS = {"native": lexicon_scorer, "python": model_scorer(load_lexicon_model)}


@pytest.mark.parametrize("name", SCORERS)
def test_lexicon(spark, name):
    frame = spark.createDataFrame(LEXICON, "text string, label string, score double")
    scored = SCORERS[name](frame, "text").select("text", f"{PREDICTED}.*")
    assert sorted(rows(scored), key=str) == sorted(LEXICON, key=str)


WORDS = st.lists(
    st.sampled_from(["love", "great", "hate", "awful", "é", "_", " ", ".", "x", "\n", "1"]),
    max_size=10,
).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(WORDS, min_size=30, max_size=60))
def test_native_and_python_scorer_agree(spark, texts):
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    native, python = (
        SCORERS[name](frame, "text").select("text", f"{PREDICTED}.*") for name in SCORERS
    )
    assert_same_rows(native, python)


def test_workers_need_no_copy_of_the_package(tmp_path):
    code = (
        "import sys, pandas; from pyspark import cloudpickle;"
        "load = cloudpickle.loads(sys.stdin.buffer.read());"
        "print(load()(pandas.Series(['hate'])).label[0])"
    )
    pickled = cloudpickle.dumps(load_lexicon_model)
    done = subprocess.run(
        [sys.executable, "-c", code], input=pickled, capture_output=True, cwd=tmp_path, timeout=120
    )
    assert done.stdout.strip() == b"NEG", done.stderr


def test_equal_texts_of_a_batch_are_scored_once(spark):
    def load():
        return lambda texts: load_lexicon_model()(texts).assign(score=1.0 / len(texts))

    frame = spark.createDataFrame([("love",)] * 6 + [(None,), ("x",)], "text string").coalesce(1)
    scored = model_scorer(load)(frame, "text").select("text", f"{PREDICTED}.*")
    want = [("love", "POS", 1 / 3)] * 6 + [(None, "NEU", 1 / 3), ("x", "NEU", 1 / 3)]
    assert rows(scored) == want


def test_model_is_called_once_per_row(spark, sf_dir):
    gold = to_gold(to_silver(posts(spark, sf_dir)), model_scorer(load_lexicon_model))
    assert plan_of(gold).count("ArrowEvalPython") == 1


def test_scoring_per_post_calls_the_model_before_the_rows_multiply(spark, sf_dir):
    plan = plan_of(bronze_to_gold(posts(spark, sf_dir), model_scorer(load_lexicon_model)))
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("Generate explode") < plan.index("ArrowEvalPython")


def test_pipeline_by_name_and_stage(spark, tmp_path):
    labelled = spark.createDataFrame(
        [("good day", "positive"), ("bad day", "negative"), ("a day", "neutral")] * 20,
        "cleaned_text string, sentiment string",
    )
    publish_pipeline(fit_pipeline(labelled, features=64), str(tmp_path), "model", "staging")
    scored = pipeline_scorer(str(tmp_path), "model", "staging")(
        labelled.dropDuplicates(), "cleaned_text"
    )
    found = {text: (label, score) for text, _, (label, score) in rows(scored)}
    assert {text: label for text, (label, _) in found.items()} == {
        "good day": "POS",
        "bad day": "NEG",
        "a day": "NEU",
    }
    assert all(0 <= score <= 1 for _, score in found.values())
    assert scored.columns == [*labelled.columns, PREDICTED]


def test_a_model_is_loaded_once_per_process(spark, tmp_path):
    """More tasks than workers: as many loads as processes."""
    marks = str(tmp_path)

    def load():
        import os
        import uuid

        open(f"{marks}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return load_lexicon_model()

    frame = spark.range(64).repartition(32).selectExpr("cast(id as string) as text")
    model_scorer(load)(frame, "text").collect()
    loads = [mark.name.split("-")[0] for mark in tmp_path.iterdir()]
    assert len(loads) == len(set(loads))


def test_workers_keep_few_models(spark):
    """Models of many scorers in turn, in one worker process; the last ones stay."""
    seen = spark.range(1).select(F.lit("love it").alias("text"))
    for _ in range(4):
        assert model_scorer(load_lexicon_model)(seen, "text").first()["prediction"]["label"] == "POS"

    @F.pandas_udf("int")
    def kept(ids: pd.Series) -> pd.Series:
        import sys

        module = sys.modules.get("_chirplake_models")
        return pd.Series([len(module.models) if module else 0] * len(ids))

    assert spark.range(1).select(kept("id")).first()[0] <= 2
