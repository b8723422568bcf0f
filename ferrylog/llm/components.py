"""Connected components of a large graph by large and small stars.

Each round moves every node's larger neighbours to its smallest neighbour, then every node and its
smaller neighbours to the smallest of these, until only stars are left, each around the smallest node
of its component. Rounds grow with the logarithm of the longest path. Minima are
partial aggregates and are joined back, so a node with very many neighbours is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    A null end is no link, and an edge from a node to itself only names the node. No edges, no rows.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL")
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    nodes = now.select(F.col("u").alias("node")).union(now.select("v")).distinct()
    now = now.where("u <> v")
    while True:
        both = now.union(now.select("v", "u"))
        lowest = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.join(lowest, F.col("u") == F.col("c")).where("v > u")
        now = stage(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        lowest = now.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        joined = now.join(lowest, F.col("u") == F.col("c")).where("v <> m")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(moved.union(lowest.select("c", "m")).distinct(), "small-star")
        # done when all that is left is stars: one edge from a node, and none from a centre
        ends = now.select("u", F.lit(0).alias("centre")).union(now.select("v", F.lit(1)).distinct())
        if ends.groupBy("u").count().where("count > 1").isEmpty():
            break
    return nodes.join(now, F.col("node") == F.col("u"), "left").select("node", F.coalesce("v", "node").alias("component"))
