from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return [tuple(row) for row in df.select(*columns or df.columns).collect()]


def assert_same_rows(left: DataFrame, right: DataFrame) -> None:
    """The same rows the same number of times, whatever their order."""
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty()
    assert right.exceptAll(left).isEmpty()


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
