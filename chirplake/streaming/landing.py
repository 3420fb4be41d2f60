"""Landing folders that stay small: ingested files move to an archive.

The stream's source moves the files of a batch when the next batch begins. What it leaves behind, the
files of the last batch and those a failure kept, is moved after the stream has ended, by the source's own
log of the files it took. So a listing of the landing folder finds what is new, however long the pipeline
has run, and the source has to remember files for a short time only. A file whose time of change is older
than that is not lost: as it is still there after the run, it gets a new time and is read by the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chirplake.schemas import RAW
from chirplake.settings import Settings, session_settings
from chirplake.sources.folders import move_file, touch_file
from chirplake.sources.raw import list_files
from chirplake.sources.tables import load_or_none, newest_batch
from chirplake.streaming.stages import Layout, bronze_stream, drain

# Moves run with the stream's own thread, so that none is pending when it ends.
CLEANER_THREADS = "spark.sql.streaming.fileSource.cleaner.numThreads"
# Runs of a stream over one landing folder, at most; each takes all it can see.
MOST_RUNS = 3


def _plain(path: Column) -> Column:
    """A path as listings write it: no empty host, no escapes."""
    unescaped = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(unescaped, "^([A-Za-z0-9+.-]+):///", "$1:/")


def ingested_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path): the landing files of all batches that a stream has committed, by its source's log."""
    newest = newest_batch(spark, checkpoint)
    lines = load_or_none(spark.read.format("text"), f"{checkpoint}/sources/0")
    if newest < 0 or lines is None:
        return spark.createDataFrame([], "path string")
    begun = spark.read.text(f"{checkpoint}/offsets/{newest}").where(F.col("value").contains("logOffset"))
    upto = begun.select(F.get_json_object("value", "$.logOffset").cast("bigint").alias("upto"))
    entry = F.from_json("value", "path string, batchId bigint")
    logged = lines.where(F.col("value").startswith("{")).select(entry.alias("e")).select("e.*")
    last = upto.first()["upto"]
    return logged.where(F.col("batchId") <= last).select(_plain(F.col("path")).alias("path")).distinct()


def archive_ingested(spark: SparkSession, landing: str, checkpoint: str, archive: str) -> int:
    """Move the ingested files still in the landing folder; gives their number. For a stream that has ended."""
    left = list_files(spark, landing).select("path")
    taken = left.join(ingested_files(spark, checkpoint), "path", "left_semi")
    return sum(move_file(spark, row["path"], archive) for row in taken.toLocalIterator())


def ingest_and_archive(
    spark: SparkSession, landing: str, layout: Layout, settings: Settings, schema: StructType = RAW
) -> int:
    """Ingest all landing files into bronze and move them to ``settings.archive``; gives the files left over.

    Files the source passes over for their age are given a new time and read by another run. Files that
    arrive meanwhile may be left over, and are read the next time.
    """
    if settings.archive is None:
        raise ValueError("no archive is set")
    left = 0
    with session_settings(spark, {CLEANER_THREADS: "0"}):
        for _ in range(MOST_RUNS):
            drain(bronze_stream(spark, landing, layout, settings, schema))
            archive_ingested(spark, landing, layout.checkpoint("bronze"), settings.archive)
            left = 0
            for row in list_files(spark, landing).select("path").toLocalIterator():
                touch_file(spark, row["path"])
                left += 1
            if not left:
                break
    return left
