from __future__ import annotations

import pandas as pd
import pytest
from helpers import assert_same_rows, rows
from pyspark.sql import functions as F

from chirplake import schemas
from chirplake.functions.memo import memo_scorer
from chirplake.functions.scoring import lexicon_scorer, load_lexicon_model, model_scorer
from chirplake.operators.layers import to_gold
from chirplake.settings import Settings
from chirplake.streaming import stages
from chirplake.streaming.stages import Layout


@pytest.fixture()
def counting(tmp_path):
    """A scorer that leaves a file for each batch of texts its model is given."""
    folder = tmp_path / "calls"
    folder.mkdir()

    def load():
        import uuid

        model = load_lexicon_model()

        def predict(texts: pd.Series) -> pd.DataFrame:
            (folder / uuid.uuid4().hex).write_text("\n".join(map(str, texts)))
            return model(texts)

        return predict

    def calls() -> list[str]:
        return sorted(line for file in folder.iterdir() for line in file.read_text().split("\n"))

    return model_scorer(load), calls


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(5)


def test_each_text_is_scored_once_over_all_batches(spark, tmp_path, counting):
    scorer, calls = counting
    memo = memo_scorer(str(tmp_path / "memo"), scorer)
    first = frame(spark, ["love it", "hate it", None, "", "so so"] + ["love it"] * 300)
    scored = memo(first, "text")
    assert scored.columns == ["id", "text", "prediction"]
    assert_same_rows(scored, lexicon_scorer(first, "text"))
    assert calls() == sorted(["love it", "hate it", "nan", "", "so so"])
    assert_same_rows(memo(first, "text"), lexicon_scorer(first, "text"))
    assert len(calls()) == 5
    second = frame(spark, ["love it", "great day"])
    assert_same_rows(memo_scorer(str(tmp_path / "memo"), scorer)(second, "text"), lexicon_scorer(second, "text"))
    assert len(calls()) == 6


def test_a_run_that_fails_leaves_no_scores(spark, tmp_path, counting):
    scorer, calls = counting

    def load():
        def predict(texts):
            raise RuntimeError("no model")

        return predict

    path, texts = str(tmp_path / "memo"), frame(spark, ["a", "b"])
    with pytest.raises(Exception, match="no model"):
        memo_scorer(path, model_scorer(load))(texts, "text")
    assert_same_rows(memo_scorer(path, scorer)(texts, "text"), lexicon_scorer(texts, "text"))
    assert calls() == ["a", "b"]


def test_no_rows(spark, tmp_path, counting):
    scorer, calls = counting
    empty = frame(spark, ["a"]).where(F.lit(False))
    assert memo_scorer(str(tmp_path / "memo"), scorer)(empty, "text").collect() == []
    assert rows(memo_scorer(str(tmp_path / "memo"), scorer)(empty, "text")) == [] and calls() == []


def test_a_memo_serves_the_batches_of_a_stream(spark, tmp_path, counting):
    scorer, calls = counting
    layout, settings = Layout(str(tmp_path / "lake")), Settings(files_per_trigger=1)
    memo = memo_scorer(str(tmp_path / "memo"), scorer)

    def arrive(*texts):
        rows_ = [(None, "@m", text, "positive") for text in texts]
        table = spark.createDataFrame(rows_, schemas.SILVER)
        table.coalesce(1).write.mode("append").parquet(layout.table("silver"))
        stages.drain(stages.gold_batches(spark, layout, settings, memo))

    assert stages.read_gold_batches(spark, layout).collect() == []
    arrive("love it", "hate it", "love it")
    arrive("love it", "so so")
    arrive("hate it", "love it")
    gold = stages.read_gold_batches(spark, layout)
    assert_same_rows(gold, to_gold(spark.read.schema(schemas.SILVER).parquet(layout.table("silver"))))
    assert calls() == ["hate it", "love it", "so so"]
