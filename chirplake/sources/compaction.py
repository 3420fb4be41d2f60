"""Levelled compaction of tables that streams append to, with an optional layout by two columns.

A compaction merges the files that came since the last one, and with them the latest copies as long as
these are not clearly larger. Each copy kept is then at least twice as heavy as the next, so their number
grows with the logarithm of the bytes, and a byte is rewritten a logarithmic number of times.
What a reader needs is in one row, the newest version of the table's list of copies; a copy
counts from the moment that row is written. Copies and versions that were replaced stay for a
grace period, so that readers that have begun can end, and are then retired.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructType

from chirplake.settings import session_settings
from chirplake.sources.folders import delete_folder, list_folders
from chirplake.sources.tables import load_or_none, read_table

_VERSION = "upto bigint, edge array<string>, copies array<struct<path:string,bytes:bigint>>"
_WRITTEN = "_metadata.file_modification_time"
# Footers have minima and maxima of times in this form, and none in the older one.
_KEEPS_TIME_RANGES = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
# A copy this many times as heavy as all after it stays as it is.
TIER = 2


@dataclass(frozen=True)
class Cluster:
    """Rows laid out by two columns at once: a filter on either finds its rows in few files.

    Each column is cut into ``2 ** bits`` ranges of about equally many rows, and the files follow the ranges
    with their bits interleaved. ``files`` are made at least.
    """

    first: str
    second: str
    bits: int = 6
    files: int = 16


def _number(df: DataFrame, name: str) -> Column:
    """A number that orders rows as the column does; of a string its first bytes after the first one."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, StringType):
        digits = F.rpad(F.hex(F.substring(column.cast("binary"), 2, 7)), 14, "0")
        return F.conv(digits, 16, 10).cast("bigint")
    return column if isinstance(kind, NumericType) else F.unix_micros(column.cast("timestamp"))


def _range(number: Column, cuts: list, low: int = 0) -> Column:
    """How many of the sorted cuts are at or below a number, by halving."""
    if not cuts:
        return F.lit(low)
    middle = len(cuts) // 2
    above = _range(number, cuts[middle + 1 :], low + middle + 1)
    return F.when(number >= F.lit(cuts[middle]), above).otherwise(_range(number, cuts[:middle], low))


def clustered(df: DataFrame, cluster: Cluster, files: int) -> DataFrame:
    """``df`` in ``files`` ranges of the interleaved bits; nulls come first.

    The cuts are quantiles over all rows, a fixed number of values. Within a cell rows are ordered and dealt
    out by the columns themselves, so a value that fills many rows is spread over files by the other
    column.
    """
    names = (cluster.first, cluster.second)
    shares = [i / 2**cluster.bits for i in range(1, 2**cluster.bits)]
    numbers = [_number(df, name) for name in names]
    cuts = df.agg(*[F.percentile_approx(n, shares, 10_000).alias(f"c{i}") for i, n in enumerate(numbers)]).first()
    cell = F.lit(0)
    for i, number in enumerate(numbers):
        place = F.coalesce(_range(number, sorted(set(cuts[i] or []))), F.lit(0))
        for bit in range(cluster.bits):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1))
            cell = cell.bitwiseOR(F.shiftleft(one, 2 * bit + 1 - i))
    keys = [F.col("_cell"), *[F.col(f"`{name}`") for name in names]]
    placed = df.withColumn("_cell", cell).repartitionByRange(files, *keys)
    return placed.sortWithinPartitions(*keys).drop("_cell")


def _versions_folder(path: str) -> str:
    return f"{path}_compactions"


def _newest(spark: SparkSession, path: str):
    """The newest list of copies, or None before the first compaction."""
    reader = spark.read.schema(f"{_VERSION}, version bigint").format("parquet")
    stored = load_or_none(reader, _versions_folder(path))
    return None if stored is None else stored.orderBy(F.desc("version")).first()


def _later(spark: SparkSession, path: str, schema: StructType | None, newest) -> DataFrame:
    """Rows of the files that no copy covers; the others are not opened.

    A stream writes the files of a batch after it has committed the batch before, so a file
    that is not covered is no older than the newest one that is. Files of that very moment are
    told apart by their names.
    """
    rows = read_table(spark, path, schema)
    if newest is None:
        return rows
    moment = F.timestamp_micros(F.lit(newest["upto"]))
    return rows.filter((F.col(_WRITTEN) >= moment) & ~F.col("_metadata.file_path").isin(newest["edge"]))


def compact_table(
    spark: SparkSession,
    path: str,
    target_file_bytes: int,
    schema: StructType | None = None,
    cluster: Cluster | None = None,
) -> bool:
    """Merge the files that came since the last compaction, and copies no heavier; False if none came.

    The table goes on as it is and ``read_current`` reads the copies in place of the files they cover. Whole
    scan partitions are merged, without a shuffle; with ``cluster`` the merged rows are shuffled into
    its layout. Only one compaction of a table may run at a time. The files covered are no longer needed by
    ``read_current``, but streams that read the table still take them up.
    """
    newest = _newest(spark, path)
    rows = _later(spark, path, schema, newest)
    files = rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_micros(_WRITTEN).alias("written"),
    ).distinct()
    found = files.agg(F.sum("size").alias("bytes"), F.max("written").alias("upto")).first()
    if found["upto"] is None:
        return False
    kept = [] if newest is None else [(copy["path"], copy["bytes"]) for copy in newest["copies"]]
    weight, merged = found["bytes"], []
    while kept and kept[-1][1] < TIER * weight:
        copy, copied = kept.pop()
        merged.append(copy)
        weight += copied
    if merged:
        rows = _copies(spark, merged, schema).unionByName(rows)
    parts = max(1, math.ceil(weight / target_file_bytes))
    if cluster is None:
        laid_out = rows.coalesce(parts)
    else:
        laid_out = clustered(rows, cluster, max(parts, cluster.files))
    copy = f"{path}_compacted/{uuid.uuid4().hex}"
    with session_settings(spark, _KEEPS_TIME_RANGES):
        laid_out.write.parquet(copy)
    version = 0 if newest is None else newest["version"] + 1
    edge = files.where(F.col("written") == found["upto"]).agg(F.collect_list("file").alias("edge"))
    copies = F.array(
        *[F.struct(F.lit(p).alias("path"), F.lit(b).cast("bigint").alias("bytes")) for p, b in [*kept, (copy, weight)]]
    )
    entry = edge.select(F.lit(found["upto"]).cast("bigint").alias("upto"), "edge", copies.alias("copies"))
    entry.coalesce(1).write.parquet(f"{_versions_folder(path)}/version={version}")
    return True


def _copies(spark: SparkSession, paths: list[str], schema: StructType | None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All committed rows of a table: the copies and what came after them."""
    newest = _newest(spark, path)
    later = _later(spark, path, schema, newest)
    if newest is None:
        return later
    copies = [copy["path"] for copy in newest["copies"]]
    return _copies(spark, copies, schema).unionByName(later)


def copies_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes it covers) of the copies a reader reads, heaviest first."""
    newest = _newest(spark, path)
    return [] if newest is None else [(copy["path"], copy["bytes"]) for copy in newest["copies"]]


def retire_copies(spark: SparkSession, path: str, grace_seconds: float = 86_400) -> int:
    """Delete copies that no reader needs any more, and their versions; gives the number of copies.

    A version is needed until the next one has been there for the grace period, and a copy while a needed
    version lists it. Copies that were never listed, as after a crash, go after the same time.
    """
    written = {
        int(folder.rpartition("=")[2]): (folder, age)
        for folder, age in list_folders(spark, _versions_folder(path))
        if "/version=" in folder
    }
    numbers = sorted(written)
    gone = [a for a, b in zip(numbers, numbers[1:], strict=False) if written[b][1] >= grace_seconds]
    needed = {copy.rpartition("/")[2] for number in numbers if number not in gone for copy in _listed(spark, written[number][0])}
    retired = 0
    for folder, age in list_folders(spark, f"{path}_compacted"):
        if folder.rpartition("/")[2] not in needed and age >= grace_seconds:
            retired += delete_folder(spark, folder)
    for number in gone:
        delete_folder(spark, written[number][0])
    return retired


def _listed(spark: SparkSession, version: str) -> list[str]:
    row = spark.read.schema(_VERSION).parquet(version).first()
    return [] if row is None else [copy["path"] for copy in row["copies"]]
