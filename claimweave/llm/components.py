"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.tables import materialize


def _large(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node around it."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node it can reach.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    now = edges.where("a <> b").select("a", "b")
    mark = None
    while True:
        now = materialize(_small(_large(now)), "stars")
        new = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()
        if new == mark:
            break
        mark = new
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(now.select("b", "b").distinct())
