"""What the operators share: session limits, checkpoints, global order, worker-side caches."""

from __future__ import annotations

import sys
import types
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplake.settings import new_run_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = " \t\n\x0b\x0c\r"

# Rows and bytes handed to Python at once; texts may be long.
ARROW_BATCH_ROWS = "1000"
ARROW_BATCH_BYTES = "16m"

# Files of a checkpoint of small rows, at most; a cluster of more cores writes one for each core.
FEW_FILES = 40


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; every query calls it first."""
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_BATCH_ROWS,
        "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BATCH_BYTES,
    }
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the folder the cluster shares."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(new_run_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def checkpoint_small(df: DataFrame) -> DataFrame:
    """``checkpoint`` in few files, for rows that are small beside the input: counts, hosts, links.

    Partitions that share a file are still read one after the other. Each new file costs a request of a store
    and, on a local disk, a process of the executor's that sets its mode.
    """
    return checkpoint(df.coalesce(max(FEW_FILES, df.sparkSession.sparkContext.defaultParallelism)))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name the frame does not have yet."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def whole_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def text_tag(text: Column) -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(whole_text(text))


def in_order(df: DataFrame, *keys: str | Column) -> DataFrame:
    """The rows sorted over all partitions, with their place: ``_part`` and ``_row`` in it.

    Ranges are cut by sampled quantiles of all keys, so rows that share the first keys
    are spread over several partitions if the later keys differ. The result is
    checkpointed: the cuts are drawn once, and a task that is run again finds the same rows.
    """
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    return checkpoint(
        placed.withColumns(
            {
                "_part": F.shiftright(number, 33).cast("int"),
                "_row": number.bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )


def totals_before(parts: Sequence[tuple[int, int]]) -> dict[int, int]:
    """Of (partition, total) pairs, the sum of all totals before each partition."""
    before, so_far = {}, 0
    for part, total in sorted(parts):
        before[part] = so_far
        so_far += total
    return before


def part_offsets(placed: DataFrame, value: Column | None = None) -> dict[int, int]:
    """Rows, or the sum of a value, before each partition of an ordered frame.

    One number for each partition comes to the driver, whatever the number of rows.
    """
    total = F.count(F.lit(1)) if value is None else F.sum(value)
    rows = placed.groupBy("_part").agg(total.alias("total")).collect()
    return totals_before([(row["_part"], row["total"] or 0) for row in rows])


def offset_column(offsets: dict[int, int]) -> Column:
    """``offsets`` by the column ``_part``; it has an entry for each partition."""
    highest = max(offsets, default=0)
    values = ",".join(str(offsets.get(part, 0)) for part in range(highest + 1))
    return F.get(F.split(F.lit(values), ",").cast("array<bigint>"), F.col("_part"))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process.

    The package's own modules reach the workers by value, anew for each task, so their
    globals do not last; a module kept under its own name does.
    """
    holder = sys.modules.setdefault("_chirplake_worker", types.ModuleType("_chirplake_worker"))
    return holder.__dict__.setdefault(name, {})
