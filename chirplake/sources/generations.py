"""Tables whose columns have changed type over time."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from chirplake.sources.raw import list_files

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
# A whole number fits a floating one if the latter holds all its digits.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def widest(one: DataType, other: DataType) -> DataType:
    """The narrowest type that holds all values of both; text, where no other type does."""
    if one == other:
        return one
    kinds = {type(one), type(other)}
    if kinds <= set(_WHOLE):
        return max(one, other, key=lambda kind: _DIGITS[type(kind)])
    if kinds <= {FloatType, DoubleType, ByteType, ShortType, IntegerType}:
        wide = DoubleType in kinds or IntegerType in kinds
        return DoubleType() if wide else FloatType()
    if kinds <= {DecimalType, *_WHOLE}:
        parts = [
            (k.precision - k.scale, k.scale) if isinstance(k, DecimalType) else (_DIGITS[type(k)], 0)
            for k in (one, other)
        ]
        whole, scale = (max(values) for values in zip(*parts, strict=True))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    if kinds == {DateType, TimestampType}:
        return TimestampType()
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if kinds == {StructType}:
        return _merged(one, other)
    return StringType()


def _merged(one: StructType, other: StructType) -> StructType:
    """The fields of both, in the order they came up, each with its widest type."""
    known = {field.name: field.dataType for field in one.fields}
    for field in other.fields:
        known[field.name] = widest(known[field.name], field.dataType) if field.name in known else field.dataType
    return StructType([StructField(name, kind, True) for name, kind in known.items()])


def generations(spark: SparkSession, files: list[str]) -> list[tuple[StructType, list[str]]]:
    """The files in groups whose footers agree, and each group's columns.

    Footers are read by Spark's tasks, many at once, in one job where all agree. Otherwise files are
    taken by halves until those of a part do, which takes few steps where the files of a generation lie together.
    """

    def agreeing(part: list[str]) -> list[tuple[StructType, list[str]]]:
        try:
            return [(spark.read.option("mergeSchema", "true").parquet(*part).schema, part)]
        except (PySparkException, Py4JJavaError) as error:  # the latter where a task has found it
            if len(part) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
        half = len(part) // 2
        return [*agreeing(part[:half]), *agreeing(part[half:])]

    groups: dict[str, tuple[StructType, list[str]]] = {}
    for schema, part in agreeing(files):
        types = StructType(sorted(schema.fields, key=lambda field: field.name)).json()
        groups.setdefault(types, (schema, []))[1].extend(part)
    return list(groups.values())


def read_reconciled(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the Parquet files below ``path`` under one schema, whatever types the columns have had.

    Each column gets the widest type it has had, text if there is no other; columns a file lacks are
    null. Files are taken in the order of their time and name. No file is an error.
    """
    listed = list_files(spark, path).where(F.col("path").endswith(".parquet"))
    files = [row["path"] for row in listed.orderBy("modified", "path").toLocalIterator()]
    if not files:
        raise FileNotFoundError(f"no Parquet file below {path}")
    groups = generations(spark, files)
    whole = reduce(_merged, [schema for schema, _ in groups])

    def as_whole(schema: StructType, part: list[str]) -> DataFrame:
        rows = spark.read.schema(schema).parquet(*part)
        return rows.select(
            *[
                (F.col(f"`{f.name}`") if f.name in schema.names else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in whole.fields
            ]
        )

    return reduce(DataFrame.unionByName, [as_whole(*group) for group in groups])
