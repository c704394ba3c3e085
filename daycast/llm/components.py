"""Connected components of an edge table, by alternating large and small stars.

Every round replaces the edges by stars around smaller neighbours, as
joins and grouped minima; the edges are written to the shared checkpoint
folder after each round, and only their number and a sum of hashes come to
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import compact


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node with an edge that is not the root itself.

    edges: u, v (long); loops and repeated edges don't matter.
    """
    edges = compact(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen == (mark.n, mark.s):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = (mark.n, mark.s)
        edges = compact(_small_star(_large_star(edges)))
