from __future__ import annotations

from collections import Counter

import pytest
from helpers import assert_same_rows, rows
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from chirplake import schemas
from chirplake.operators import application as app
from chirplake.operators import evaluation, profiling
from chirplake.operators.layers import bronze_to_gold, silver_flags, to_gold, to_silver
from chirplake.plans.posts import posts

GOLD_ROWS = "mention string, predicted_sentiment string"


def test_layer_schemas(spark, sf_dir):
    silver = to_silver(posts(spark, sf_dir))
    gold = to_gold(silver)

    def kinds(fields):
        return [(field.name, field.dataType) for field in fields]

    assert kinds(silver.schema.fields) == kinds(schemas.SILVER.fields)
    assert kinds(gold.schema.fields) == kinds(schemas.GOLD.fields)
    assert_same_rows(gold, bronze_to_gold(posts(spark, sf_dir)))
    table = app.application_table(gold)
    assert kinds(table.schema.fields) == kinds(schemas.APPLICATION.fields)


def test_silver_flags(spark):
    bronze = spark.createDataFrame(
        [("d1", "@a x", "positive"), ("d2", "x", None), ("d3", None, "negative")],
        "date string, text string, sentiment string",
    )
    assert rows(silver_flags(bronze).drop("processing_time")) == [
        ("d1", 1, " x", "positive", "silver"),
        ("d2", 0, "x", None, "silver"),
    ]


def test_null_profile_counts_nan_as_missing(spark):
    frame = spark.createDataFrame(
        [(1.0, "a"), (float("nan"), None), (None, None)], "`a.b` double, s string"
    )
    assert rows(profiling.null_profile(frame, "t")) == [("t", "a.b", 3, 2), ("t", "s", 3, 2)]


def test_users_without_a_name_form_a_group_and_ties_are_ordered(spark):
    frame = spark.createDataFrame([("b",), ("a",), (None,), (None,)], "user string")
    assert rows(profiling.posts_per_user(frame)) == [(None, 2), ("a", 1), ("b", 1)]
    assert rows(profiling.top_users(frame, 2)) == [(None, 2), ("a", 1)]


def test_presence_counts_missing_text_as_without(spark):
    frame = spark.createDataFrame([("@a",), ("a@b",), ("x",), (None,)], "text string")
    assert rows(profiling.at_sign_presence(frame)) == [(4, 2, 2)]
    assert rows(profiling.mention_presence(frame)) == [(4, 1, 3)]


def test_key_skew(spark):
    frame = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2 + [("c",)], "key string")
    assert rows(profiling.key_skew(frame, "key")) == [(3, 9, 6, 2.0, 3.0, 6 / 9)]


def test_partition_balance(spark):
    frame = spark.range(1000).repartition(4)
    found = profiling.partition_balance(frame).first()
    assert (found.partitions, found.rows) == (4, 1000)
    assert found.smallest <= 250 <= found.largest < 260


def test_pivot_leaves_unknown_labels_out_of_the_total(spark):
    gold = spark.createDataFrame(
        [("@a", "POS"), ("@a", "NEG"), ("@a", None), ("@b", None), ("@c", "ODD")], GOLD_ROWS
    )
    assert rows(app.mention_pivot(gold)) == [
        ("@a", 1, 0, 1, 2),
        ("@b", 0, 0, 0, 0),
        ("@c", 0, 0, 0, 0),
    ]


def test_top_mentions_break_ties_by_name(spark):
    gold = spark.createDataFrame([("@b", "POS"), ("@a", "POS"), ("@c", "NEG")], GOLD_ROWS)
    assert rows(app.top_mentions(gold, "positive", 2)) == [("@a", 1), ("@b", 1)]
    assert rows(app.top_mentions(gold, "negative", 1)) == [("@c", 1)]


@pytest.mark.parametrize("salts", [1, 3, 16])
def test_salted_totals_with_a_hot_mention(spark, salts):
    gold = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "@hot")
        .otherwise(F.concat(F.lit("@"), F.col("id") % 500))
        .alias("mention")
    )
    want = Counter(row.mention for row in gold.collect())
    assert dict(rows(app.salted_mention_totals(gold, salts))) == want


def test_partials_fold_to_the_whole(spark, sf_dir):
    gold = to_gold(to_silver(posts(spark, sf_dir)))
    early = F.col("timestamp") < "2024-01-10"
    parts = app.application_partials(gold.filter(early)).unionByName(
        app.application_partials(gold.filter(early.isNull() | ~early))
    )
    assert_same_rows(app.fold_partials(parts), app.application_table(gold))


IDS = "sentiment_id int, predicted_sentiment_id int"
PAIRS = [(1, 1)] * 4 + [(0, 1)] * 2 + [(1, 0)] * 3 + [(0, 0)] * 5 + [(2, 1)] * 7 + [(2, 0)]


def test_metrics_leave_the_third_class_out(spark):
    assert evaluation.classifier_metrics(spark.createDataFrame(PAIRS, IDS)).first().asDict() == {
        "true_positive": 4,
        "false_positive": 2,
        "false_negative": 3,
        "true_negative": 5,
        "precision": 4 / 6,
        "recall": 4 / 7,
        "f1_score": 8 / 13,
    }


@pytest.mark.parametrize("pairs", [[], [(1, 0)], [(0, 0)], [(2, 1)]])
def test_metrics_are_zero_without_a_true_positive(spark, pairs):
    found = evaluation.classifier_metrics(spark.createDataFrame(pairs, IDS)).first()
    assert (found.precision, found.recall, found.f1_score) == (0.0, 0.0, 0.0)


def test_confusion_matrix_is_the_full_grid(spark):
    want = Counter(PAIRS)
    assert rows(evaluation.confusion_matrix(spark.createDataFrame(PAIRS, IDS))) == [
        (a, p, want[a, p]) for a in range(3) for p in range(3)
    ]


def test_per_class_metrics_agree_with_the_library(spark):
    frame = spark.createDataFrame([*PAIRS, (2, 2), (0, 2)], IDS)
    evaluator = MulticlassClassificationEvaluator(
        labelCol="sentiment_id", predictionCol="predicted_sentiment_id"
    )
    as_real = frame.select(*[F.col(c).cast("double").alias(c) for c in frame.columns])
    names = {
        "precision": "precisionByLabel",
        "recall": "recallByLabel",
        "f1_score": "fMeasureByLabel",
    }
    for row in evaluation.per_class_metrics(frame).collect():
        for column, metric in names.items():
            want = evaluator.evaluate(
                as_real, {evaluator.metricName: metric, evaluator.metricLabel: float(row.class_id)}
            )
            assert row[column] == pytest.approx(want, abs=1e-12)


def test_runs_are_appended(spark, tmp_path):
    gold, path = spark.createDataFrame(PAIRS, IDS), str(tmp_path / "runs")
    for name in ("first", "second"):
        evaluation.record_run(
            evaluation.evaluation_run(gold, name, {"model_name": "m"}, {"t": "v"}, {"a": "p"}), path
        )
    stored = spark.read.parquet(path)
    assert stored.select("run_id").distinct().count() == 2
    first = stored.filter("run_name = 'first'").select("kind", "key", "value")
    assert sorted(rows(first)) == [
        ("artifact", "a", "p"),
        ("metric", "f1_score", str(8 / 13)),
        ("metric", "precision", str(4 / 6)),
        ("metric", "recall", str(4 / 7)),
        ("param", "model_name", "m"),
        ("tag", "t", "v"),
    ]
