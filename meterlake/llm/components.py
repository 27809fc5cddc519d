"""Connected components of a graph whose nodes are longs, without leaving the cluster.

Large-star and small-star steps alternate until the edges stand still. Each step is an
aggregation by node that keeps one minimum, and a join that gives it to the node's
edges; a node with very many edges is pre-aggregated in the first and split by adaptive
execution in the second. Every step is kept in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges ``(a, b)`` with ``a > b`` to such edges, nearer to a star around the least node."""
    ways = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        ways = ways.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ways.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    found = ways.join(least, "u")
    moved = found.filter("v > u") if large else found
    moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; the component is its least node."""
    now = edges.select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    )
    now = checkpointed(now.filter("a > b").distinct())
    state = None
    while True:
        now = checkpointed(_star(_star(now, large=True), large=False))
        # Order-free: the number of edges and the sum of their hashes.
        found = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(
        stars.select(F.col("component").alias("node"), "component").distinct()
    )
