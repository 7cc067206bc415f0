"""Connected components of a table of links, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """links has columns a and b of one orderable type; returns node and component, its smallest reachable node.

    Every round turns each node's links to the smallest node it knows (large star, then small star), so
    rounds grow with the logarithm of the longest path. The rows never exceed the links; rounds are
    written to the shared folder. Hot nodes only meet joins and partial sums. No links, no rows.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        small = written(_star(_star(edges, both=True), both=False), "stars")
        if _digest(small) == _digest(edges):
            break
        edges = small
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Large star: each larger neighbour of a node is linked to the smallest neighbour; small star: each smaller one and the node itself."""
    if both:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        pairs = sides.join(least, "a").where("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        pairs = edges.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).unionByName(least.select(F.col("a").alias("x"), F.col("m").alias("y")))
    return pairs.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("b", "a").cast("long"))).first())
