"""Tables written by the streams."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chirplake.settings import Settings
from chirplake.sources.raw import count_files, list_files


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All committed rows of a table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All rows under the union of the columns the files have had over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def stream_table(
    spark: SparkSession, path: str, schema: StructType, settings: Settings
) -> DataFrame:
    """A table as a stream of what is appended to it; uncommitted files are not seen."""
    return spark.readStream.schema(schema).options(**settings.source_options()).parquet(path)


def load_or_none(reader: DataFrameReader, path: str) -> DataFrame | None:
    """What lies at a path, or None if nothing does."""
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch a stream has committed, the version of its table; -1 if none."""
    commits = load_or_none(spark.read.format("binaryFile"), f"{checkpoint}/commits")
    if commits is None:
        return -1
    number = F.regexp_extract("path", r"/(\d+)$", 1)
    numbers = commits.select(number.alias("batch")).filter("batch <> ''")
    newest = numbers.agg(F.max(F.col("batch").cast("bigint"))).first()[0]
    return -1 if newest is None else newest


def file_profile(spark: SparkSession, path: str, suffix: str = "parquet") -> DataFrame:
    """Number and sizes of the data files of a table."""
    return (
        list_files(spark, path)
        .filter(F.col("path").endswith(f".{suffix}"))
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.avg("length").alias("mean_bytes"),
            F.max("length").alias("largest_bytes"),
        )
    )


def compact(spark: SparkSession, path: str, target: str, target_file_bytes: int) -> DataFrame:
    """Write the table at ``path`` again at ``target``, in files of about the given size.

    A table that a stream owns lists its files in a log, so the rewrite goes to a
    new folder and the reader moves over. The scan packs small files into
    partitions, and merging whole partitions needs no shuffle: each byte is read
    once and written once. Files that are large enough already are not split further.
    """
    total = count_files(spark, path).first()["bytes"]
    files = max(1, math.ceil(total / target_file_bytes))
    read_table(spark, path).coalesce(files).write.parquet(target)
    return read_table(spark, target)
