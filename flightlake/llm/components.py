"""Connected components of a graph given by its edges, without any node's links in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import stored


def _towards_least(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        F.col("a") != F.col("b")
    )


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node with an edge (a, b); root is the least node of its component.

    Alternates two steps until nothing changes: every node links its larger neighbours to the
    least node it knows, then its smaller ones. Both steps keep components together, and each
    is a grouped minimum and a join, so a node with many links is pre-aggregated and may be
    split. Rounds are stored, so that a lost executor costs one round at most.
    """
    current = stored(_towards_least(edges).distinct())
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = both.filter(F.col("b") > F.col("a")).join(least, "a")
        large = larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b"),
        )
        # A node whose links all led to its least neighbour keeps that one link.
        following = stored(
            small.unionByName(down.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        )
        reached = _state(following)
        current = following
        if reached == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = reached


def _state(edges: DataFrame) -> tuple:
    """Number of edges and sums over them, which stay the same once nothing changes."""
    mark = F.xxhash64("a", "b")
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            # Small parts of a hash, whose sums stay within a long for 10^12 edges.
            F.sum(F.pmod(mark, F.lit(1 << 22))),
            F.sum(F.shiftrightunsigned(mark, 42)),
        ).first()
    )
