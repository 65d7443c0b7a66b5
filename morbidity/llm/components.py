"""Connected components by contraction, each round a few joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from morbidity.sources.writers import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of edges (a, b); the root is one node of each component.

    Every node is merged into its smallest neighbour, if that is smaller; then the edges between merged nodes are
    taken. Nodes should be hashes: in a random order about a third of the nodes remain after a round, so rounds grow
    as the logarithm of the longest chain. Each round is staged, so that lost executors cost one round at most.
    """
    edges = stage(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        merged = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
        merged = stage(merged, "merged")
        if roots is None:
            roots = merged
        else:
            further = merged.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = stage(
                roots.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots"
            )
        left = merged.select(F.col("node").alias("a"), F.col("root").alias("x"))
        right = merged.select(F.col("node").alias("b"), F.col("root").alias("y"))
        joined = edges.join(left, "a").join(right, "b").where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = stage(joined.distinct(), "edges")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
