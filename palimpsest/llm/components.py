"""Connected components of an edge table, by alternating large and small stars.

Each round is two grouped minima and two joins; no neighbourhood is gathered in one place: the minima of nodes with very
many edges are broadcast (HOT nodes at most) and their edges stay where they are. Only counts come to the driver. Each
round's edges are a table in the shared folder, which the next round's replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT, discard, materialize, skew_join


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """``u, v, m`` for each edge: m is the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree"))
    return skew_join(edges, least, ["u"], F.col("degree") > max(1024, total // HOT)).select("u", "v", "m")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge at most, to a node without any."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return not ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 OR out = 1 AND into = 1").count()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``(u, v)``: root is the least node that can be reached.

    Edges from a node to itself don't count; nodes without another edge are not in the result.
    """
    ordered = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(ordered.distinct(), "edges")
    while not _are_stars(edges):
        total = edges.count()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * total).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = materialize(large, "edges")
        # now every edge goes from a node to a smaller one; a node's smaller neighbours and itself go to the least of them
        small = _with_least(large, total).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        after = materialize(small.filter("u <> v").distinct(), "edges")
        discard(edges)
        discard(large)
        edges = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
