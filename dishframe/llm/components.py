"""Connected components of a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dishframe.llm.common import written


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs (node, other) with the least of node's others: combined before the exchange, then joined."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least, "node")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("node", "other").union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    linked = _with_least(both).filter(F.col("other") > F.col("node"))
    return linked.select(F.col("other").alias("node"), F.least("node", "least").alias("other")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")).filter("node != other")
    linked = _with_least(down)
    moved = linked.filter("other != least").select(F.col("other").alias("node"), F.col("least").alias("other"))
    return moved.union(linked.select("node", F.col("least").alias("other"))).distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node, component (its least node) for every node of the edges (columns node, other)."""
    edges = written(_small_star(edges))
    before = None
    for _ in range(max_rounds):
        edges = written(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
    return edges.select("node", F.col("other").alias("component")).union(roots)
