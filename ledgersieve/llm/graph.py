"""Connected components by alternating stars; links and labels stay in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.sources.cut import cut


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang every neighbour of a node on the least node around it.

    `large`: the neighbours above the node; otherwise those below it, and the node too. The least
    neighbour is an aggregate that combines on the map side; the join that follows it is one that
    Spark can split, so a node with any number of neighbours is never gathered in one place.
    """
    up = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    around = up.union(up.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else up
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    hung = around.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        below = around.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        hung = below.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) that is not itself the least of its component.

    Each round is stored in the shared folder, which cuts the lineage and outlives executors. The
    number of rounds grows with the logarithm of the longest chain. An empty table gives no rows.
    """
    edges = cut(edges.where("a <> b").distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not state["n"] or tuple(state) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(state)
        edges = cut(_stars(_stars(edges, True), False), "links")
