"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.session import stable


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b); ``component`` is the smallest node that links lead to.

    Each step hangs neighbours under the smallest one, so the number of rounds grows with the logarithm of the longest
    chain. A hub's links are combined before the shuffle; joins on a hub are split by adaptive execution.
    """
    edges = stable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.select("u", F.col("m").alias("v")).unionByName(hung.select(F.col("v").alias("u"), F.col("m").alias("v")))
        # a node that lost its links above stays below its smallest neighbour
        new = stable(small.where("u > v").distinct())
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            break
        edges = new
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
