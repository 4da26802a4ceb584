"""Connected components by alternating star contractions over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateia.llm.common import discard, written


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung on the node's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its lesser neighbours are hung on the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    hung = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.unionByName(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); the root is the least node of its component.

    Each round halves the depth of the trees and is written, so lost executors
    cost one round at most. A hub in a third of all links is a minimum, combined
    before the shuffle, and a join whose large side can be split.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = written(ordered.distinct(), "links"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        last, now = now, written(_small_star(_large_star(now)), "links")
        discard(last)
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
