"""Connected components of a large graph, by alternating stars.

Each round hangs every node's larger neighbours, then its smaller ones, on its smallest neighbour, until all
edges point at the smallest node of their component. A round is two aggregations, which combine on the map
side, and two joins on a node. What is joined to the edges, one row per node, is stored first, so that the
engine sees two plain tables and can split the edges of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "stars")
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("least")), "stars")
    moved = down.join(least, "a").filter(F.col("b") > F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of the edges (a, b); the component is its smallest node.

    Null ends and edges from a node to itself are left out, repeated edges count once. No edge, no row.
    """
    edges = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        edges = stored(_large_star(edges), "edges")
        edges = stored(_small_star(edges).filter(F.col("a") != F.col("b")).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
