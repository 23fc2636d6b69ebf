"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import checkpoint, discard


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation over edges (u, v): the large star ties every larger
    neighbour of a node to the smallest node around it, the small star every
    smaller neighbour and the node itself."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    moved = near.join(least, "u").where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionAll(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    an edge, from edges (u, v) in either order.

    Every round is a written table; groups with a hot node stay aggregates and
    joins, which AQE can split.  The driver sees a count and a checksum per round.
    """
    edges = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-0")
    seen = None
    while True:
        after = checkpoint(_star(_star(edges, True), False), "cc")
        discard(edges)
        edges = after
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                edges.select("v", "v").distinct())
        seen = now
