"""Schemas of the layers, fixed on read and on write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


TEXT, TIME, COUNT, ID, REAL = StringType(), TimestampType(), LongType(), IntegerType(), DoubleType()

RAW = _schema(date=TEXT, user=TEXT, text=TEXT, sentiment=TEXT)
BRONZE = StructType(RAW.fields + _schema(source_file=TEXT, processing_time=TIME).fields)
SILVER = _schema(timestamp=TIME, mention=TEXT, cleaned_text=TEXT, sentiment=TEXT)
GOLD = StructType(
    SILVER.fields
    + _schema(
        predicted_score=REAL,
        predicted_sentiment=TEXT,
        sentiment_id=ID,
        predicted_sentiment_id=ID,
    ).fields
)
APPLICATION = _schema(
    mention=TEXT,
    min_timestamp=TIME,
    max_timestamp=TIME,
    negative=COUNT,
    neutral=COUNT,
    positive=COUNT,
    total=COUNT,
)
PREDICTION = _schema(label=TEXT, score=REAL)
STREAM_PROGRESS = _schema(
    observed_at=TIME, stream=TEXT, batch_id=COUNT, rows=COUNT, duration_ms=COUNT
)
EVAL_RUN = _schema(run_id=TEXT, run_name=TEXT, kind=TEXT, key=TEXT, value=TEXT)

CORRUPT_RECORD = "_corrupt_record"


def enforce(df: DataFrame, schema: StructType, allow_new_columns: bool = False) -> DataFrame:
    """Bring ``df`` to ``schema`` or fail: same names, order and types.

    With ``allow_new_columns`` columns beyond the schema are kept at its end, so a
    table can grow wider; without it they are an error.
    """
    extra = [field for field in df.schema.fields if field.name not in schema.names]
    if extra and not allow_new_columns:
        raise ValueError(f"columns not in the schema: {[field.name for field in extra]}")
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    return df.to(StructType(schema.fields + extra))
