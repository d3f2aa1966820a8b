"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge points from the larger node ``a`` to the smaller ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a")
    return (
        linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``edges`` (a, b): one row (node, component) for every node with an edge; the component is its least node.

    Each round sends every neighbour to the least one it can see, until all edges
    are stars; the number of rounds grows with the logarithm of the longest path.
    Nodes with very many edges are split by adaptive execution, and no node's edges
    are gathered. Self-loops and nulls are left out; repeated edges do no harm.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct(), label,
    )
    seen = None
    while True:
        now = stored(_small_star(_large_star(now)), label)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
