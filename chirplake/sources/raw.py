"""Raw post files: one JSON object per line."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chirplake.schemas import CORRUPT_RECORD, RAW
from chirplake.settings import Settings
from chirplake.sources.folders import qualified

# Landing folders may be nested, by date for example.
NESTED = {"recursiveFileLookup": "true"}


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and time of change of each file at any depth; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .options(**NESTED)
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def count_files(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def peek_json(spark: SparkSession, path: str) -> DataFrame:
    """Posts with the schema found in the files; for looking, not for pipelines."""
    return spark.read.options(**NESTED).json(path)


def peek_text(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """The lines as they are, the first ``n`` of them if asked."""
    lines = spark.read.options(**NESTED).text(path)
    return lines if n is None else lines.limit(n)


def raw_batch(spark: SparkSession, path: str, schema: StructType = RAW) -> DataFrame:
    return spark.read.schema(schema).options(**NESTED).json(path)


def check_archive(spark: SparkSession, landing: str, archive: str) -> None:
    """An archive must lie apart from its landing folder and on the same file system."""
    landing, archive = (f"{qualified(spark, path).rstrip('/')}/" for path in (landing, archive))
    if landing.startswith(archive) or archive.startswith(landing):
        raise ValueError(f"the archive {archive} and the landing folder {landing} lie in each other")
    if urlsplit(landing)[:2] != urlsplit(archive)[:2]:
        raise ValueError(f"the archive {archive} is on another file system than {landing}")


def raw_stream(
    spark: SparkSession, path: str, settings: Settings, schema: StructType = RAW
) -> DataFrame:
    """Post files as they arrive, a limited number per batch, by a fixed schema.

    A line that is no JSON gives a row of nulls, unless the schema has the
    corrupt-record column, which then keeps the line. With ``settings.archive`` the files of a batch
    are moved there when the next one begins.
    """
    if settings.archive is not None:
        check_archive(spark, path, settings.archive)
    return (
        spark.readStream.schema(schema)
        .options(**settings.landing_options(), **NESTED)
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .json(path)
    )


def with_corrupt_record(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT_RECORD, StringType(), True)])


def split_malformed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the others with their source line.

    Meant for a stored table: over a scan of the files, the columns a query asks
    for decide which lines are found broken.
    """
    broken = F.col(CORRUPT_RECORD).isNotNull()
    return rows.filter(~broken).drop(CORRUPT_RECORD), rows.filter(broken)
