"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm.common import keep


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b), root being the smallest node reachable.

    Nodes may have any type that Spark orders. Edges from a node to itself and repeated edges change nothing; edges
    with a null end are ignored; no edges give no rows. A hub's neighbours never meet in one task: the smallest
    neighbour is an aggregate combined before the shuffle, and the join that hands it out is one whose large
    partitions Spark splits. Each round is written to the checkpoint folder; the number of rounds grows with the
    logarithm of the number of nodes.
    """
    pairs = edges.select("a", "b").where("a <> b")
    now = keep(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        now = keep(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def _state(edges: DataFrame) -> tuple:
    """Changes whenever the set of edges does."""
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(mark.cast("decimal(38,0)")), F.bit_xor(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node itself, to its smallest neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", "low")).distinct()
