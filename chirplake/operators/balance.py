"""Partitions of equal cost."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

_COST, _TARGET = "_cost", "_target"


def _with_target(before: dict[int, int], each: float, partitions: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if so_far is None:
                so_far = before[batch.column("_part")[0].as_py()]
            cost = batch.column(_COST).to_numpy()
            ends = so_far + np.cumsum(cost)
            # A row goes where its middle lies, so no partition is off by more than a row at each end.
            target = np.minimum((ends - cost / 2) // each, partitions - 1).astype(np.int32)
            so_far = int(ends[-1])
            names = [name for name in batch.schema.names if name not in (_COST, "_part")]
            columns = [*[batch.column(name) for name in names], pa.array(target)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, _TARGET])

    return place


def by_cost(df: DataFrame, cost: Column, partitions: int) -> DataFrame:
    """``df`` in ``partitions`` partitions of equal total ``cost``, a whole number; null costs nothing.

    The running sum of the cost over all rows cuts the partitions: each partition of ``df`` is summed
    first, one number of each comes to the driver, and then every task goes on from the sum before it. Rows
    that follow each other stay together. The largest partition exceeds the mean by no more than the
    costliest row. Rows of no cost at all are dealt out evenly. ``df`` must give the same partitions when
    it is read again, as scans of files do.
    """
    costed = df.withColumn(_COST, F.greatest(F.coalesce(cost.cast("bigint"), F.lit(0)), F.lit(0)))
    costed = costed.withColumn("_part", F.spark_partition_id())
    sums = costed.groupBy("_part").agg(F.sum(_COST).alias("cost")).collect()
    before, total = {}, 0
    for row in sorted(sums, key=lambda row: row["_part"]):
        before[row["_part"]], total = total, total + row["cost"]
    if not total:
        return df.repartition(partitions)
    schema = StructType([*df.schema.fields, StructField(_TARGET, IntegerType())])
    placed = costed.mapInArrow(_with_target(before, total / partitions, partitions), schema)
    return placed.repartitionById(partitions, F.col(_TARGET)).drop(_TARGET)


def partition_costs(df: DataFrame, cost: Column) -> DataFrame:
    """(partition, cost): what lies in each partition that has rows."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.sum(cost.cast("bigint")).alias("cost"))
