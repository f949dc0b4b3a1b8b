"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, F.col("u") == F.col("w")).select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (u > v in every edge)."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(low.select(F.col("u").alias("w"), "m"), F.col("u") == F.col("w")).where("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).union(others).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) -> (node, component): the smallest node that can be reached.

    Rounds repeat until the edge set stays as it is (about log^2 of the longest
    path); each is written to the shared folder.  Only a count and a checksum
    reach the driver.  Nodes without an edge are not returned.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = None
    while True:
        e = materialise(_small_star(_large_star(e)), "star")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state or now[0] == 0:
            break
        state = tuple(now)
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
