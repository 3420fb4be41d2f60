"""Predicted against given sentiment.

All measures come from counts taken in one pass. Rows never leave the executors;
what the shuffle carries is one row of counts per task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirplake.functions.labels import CLASS_IDS, NEGATIVE_ID, POSITIVE_ID
from chirplake.schemas import EVAL_RUN, enforce

ACTUAL, PREDICTED = "sentiment_id", "predicted_sentiment_id"


def _cell(actual: int, predicted: int) -> str:
    return f"cell_{actual}_{predicted}"


def cell_counts(gold: DataFrame) -> DataFrame:
    """One row holding a count for each pair of classes."""
    return gold.agg(
        *[
            F.count_if((F.col(ACTUAL) == a) & (F.col(PREDICTED) == p)).alias(_cell(a, p))
            for a in CLASS_IDS
            for p in CLASS_IDS
        ]
    )


def _ratio(part: Column, whole: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _measures(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def classifier_metrics(gold: DataFrame) -> DataFrame:
    """Precision, recall and F1 of the positive class.

    Rows whose given label is neither positive nor negative take no part: the
    measures are defined on two classes.
    """
    return metrics_of_cells(cell_counts(gold))


def metrics_of_cells(cells: DataFrame) -> DataFrame:
    """``classifier_metrics`` from counts already taken."""
    cells = cells.select(
        F.col(_cell(POSITIVE_ID, POSITIVE_ID)).alias("true_positive"),
        F.col(_cell(NEGATIVE_ID, POSITIVE_ID)).alias("false_positive"),
        F.col(_cell(POSITIVE_ID, NEGATIVE_ID)).alias("false_negative"),
        F.col(_cell(NEGATIVE_ID, NEGATIVE_ID)).alias("true_negative"),
    )
    return cells.withColumns(
        _measures(F.col("true_positive"), F.col("false_positive"), F.col("false_negative"))
    )


def confusion_matrix(gold: DataFrame) -> DataFrame:
    """Rows per (given, predicted) class pair, pairs that never occur included."""
    return matrix_of_cells(cell_counts(gold))


def matrix_of_cells(cells: DataFrame) -> DataFrame:
    """``confusion_matrix`` from counts already taken."""
    grid = [
        F.struct(
            F.lit(a).alias(ACTUAL), F.lit(p).alias(PREDICTED), F.col(_cell(a, p)).alias("rows")
        )
        for a in CLASS_IDS
        for p in CLASS_IDS
    ]
    return cells.select(F.inline(F.array(*grid)))


def per_class_metrics(gold: DataFrame) -> DataFrame:
    """Precision, recall, F1 and number of rows for each given class."""

    def total(cells: list[str]) -> Column:
        return sum((F.col(cell) for cell in cells[1:]), F.col(cells[0]))

    def of_class(c: int) -> Column:
        others = [x for x in CLASS_IDS if x != c]
        tp = F.col(_cell(c, c))
        fp = total([_cell(a, c) for a in others])
        fn = total([_cell(c, p) for p in others])
        named = [measure.alias(name) for name, measure in _measures(tp, fp, fn).items()]
        return F.struct(F.lit(c).alias("class_id"), *named, (tp + fn).alias("support"))

    return cell_counts(gold).select(F.inline(F.array(*[of_class(c) for c in CLASS_IDS])))


def evaluation_run(
    gold: DataFrame,
    run_name: str,
    params: dict[str, str],
    tags: dict[str, str] | None = None,
    artifacts: dict[str, str] | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """One evaluation as rows: its metrics, parameters, tags and stored artifacts.

    ``cells`` are the ``cell_counts`` of ``gold`` where they are at hand, and save a scan.
    """
    metrics = [
        (F.lit("metric"), F.lit(name), F.col(name).cast("string"))
        for name in ("precision", "recall", "f1_score")
    ]
    given = [
        (F.lit(kind), F.lit(key), F.lit(value))
        for kind, entries in (("param", params), ("tag", tags or {}), ("artifact", artifacts or {}))
        for key, value in entries.items()
    ]
    records = F.array(
        *[
            F.struct(kind.alias("kind"), key.alias("key"), value.alias("value"))
            for kind, key, value in metrics + given
        ]
    )
    metrics_row = classifier_metrics(gold) if cells is None else metrics_of_cells(cells)
    run = metrics_row.select(
        F.lit(uuid.uuid4().hex).alias("run_id"), F.lit(run_name).alias("run_name"), F.inline(records)
    )
    return enforce(run, EVAL_RUN)


def record_run(run: DataFrame, path: str) -> None:
    """Append a run to the table of all runs."""
    run.write.mode("append").parquet(path)
