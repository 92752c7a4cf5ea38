"""Connected components of an edge table, by alternating large and small stars.

Every step turns each edge into one to a node's smallest neighbour, so the number of edges
never grows; the steps end when every node but the smallest has one edge, to the smallest. Edges are written after every step, in the
shared folder, so a lost executor costs no earlier step, and what a step shuffled is released.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .common import release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the larger (or the smaller) neighbours of each node, and it, to the smallest of them all."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        found = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        found = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return found.filter(F.col("a") != F.col("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node is at one end of its edges only, and at the upper end of one edge at most: another step would change nothing."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    held = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return held.filter((F.col("up") > 1) | (F.col("up") == 1) & (F.col("down") == 1)).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)`` that are not their component's smallest node."""
    edges = stage(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
    while True:
        edges = stage(_star(_star(edges, large=True), large=False), "edges")
        done = _settled(edges)
        release(edges.sparkSession)
        if done:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
