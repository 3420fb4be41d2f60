"""Connected components of a link table, by alternating star operations.

Each round replaces the links of a node by links to its smallest neighbour, first for the larger
neighbours and then for the smaller ones. Neighbours are never collected: a round takes the
minimum per node, which is folded before the shuffle, and joins it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirplake.llm.common import checkpoint_small


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b), two longs, that is not its group's smallest.

    Null ends and links of a node to itself say nothing. The number of rounds grows with the
    logarithm of the longest chain.
    """
    links = links.where(F.col("a") != F.col("b"))
    stars = checkpoint_small(
        links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    )
    state = _state(stars)
    while state[0]:
        stars = checkpoint_small(_small_star(_large_star(stars)))
        before, state = state, _state(stars)
        if state == before:
            break
    return stars


def _state(stars: DataFrame) -> tuple:
    digest = F.xxhash64("node", "root")
    return tuple(
        stars.agg(
            F.count(F.lit(1)), F.bit_xor(digest), F.sum(F.shiftright(digest, 24))
        ).first()
    )


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionByName(
        stars.select(F.col("root").alias("node"), F.col("node").alias("root"))
    )
    least = both.groupBy("node").agg(F.min("root").alias("low"))
    # Stored, so that the join sees two plain shuffles and a hot node can be split.
    least = checkpoint_small(least.select("node", F.least("node", "low").alias("low")))
    larger = both.where(F.col("root") > F.col("node"))
    return larger.join(least, "node").select(F.col("root").alias("node"), F.col("low").alias("root")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    stars = checkpoint_small(stars)
    least = checkpoint_small(stars.groupBy("node").agg(F.min("root").alias("low")))
    moved = stars.join(least, "node").where(F.col("root") != F.col("low"))
    return (
        moved.select(F.col("root").alias("node"), F.col("low").alias("root"))
        .unionByName(least.select("node", F.col("low").alias("root")))
        .distinct()
    )
