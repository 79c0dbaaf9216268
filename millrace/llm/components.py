"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); the component is its
    smallest node.

    Large and small stars alternate until nothing changes; every round is one stored
    table of at most as many edges as before, and long paths shrink by half a round.
    Loops and nulls are ignored, repeated edges are one; no edges give no rows.  Nothing
    is collected but a checksum per round.
    """
    scratch = Scratch(edges.sparkSession)
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, seen = scratch.store(edges, "components"), None
    while True:
        total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        checksum = edges.agg(F.count("*"), total).first()
        if checksum == seen or not checksum[0]:
            break
        seen = checksum
        edges = scratch.replace(_small_star(_large_star(edges)), "components")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
