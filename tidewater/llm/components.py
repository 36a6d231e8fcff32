"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a, b; longs), root
    being the smallest node of the component. Each step moves every
    neighbour of a node to the smallest one; edges never grow in number, and
    a node's neighbours are never gathered, only their minimum."""
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), "stars")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is a root, or has one edge, to its root."""
    seen = edges.select(F.col("a").alias("node"), F.lit(0).alias("up")).unionAll(edges.select(F.col("b").alias("node"), F.lit(1).alias("up")))
    ups = seen.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return ups.where("up > 1 or (up = 1 and least = 0)").isEmpty()


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the node's smallest neighbour (or the node)."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()
