"""Connected components of a graph in Spark, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.session import checkpointed


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node to the least node around it: the larger ones, or the others."""
    around = _both(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    linked = around.join(least, "a")
    if large:
        moved = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        moved = linked.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
            least.select("a", F.col("_m").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def _summary(edges: DataFrame):
    """Count and digest of a set of edges, to see whether a round changed it."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that can be reached, for every node with an edge (a, b).

    Rounds of large and small stars until nothing changes; their number grows with the
    logarithm of the graph's size. Each round is checkpointed in the shared folder. A
    hub's edges are spread over its neighbours, and minima combine before the shuffle.
    """
    now = checkpointed(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    before = None
    while (seen := _summary(now)) != before:
        before = seen
        now = checkpointed(_stars(_stars(now, large=True), large=False))
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
