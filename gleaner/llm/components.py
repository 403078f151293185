"""Connected components by alternating stars, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.sources.files import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v")))


def digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for every node of an edge: the component's smallest node.

    Each round is written to the shared folder. What reaches the driver is a count and a sum; the
    number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct()
    edges = staged(edges, "components")
    before = digest(edges)
    while True:
        large = _large_star(edges).filter("u <> v").distinct()
        edges = staged(_small_star(large).filter("u <> v").distinct(), "components")
        # the edges of a finished round are stars, which both steps leave as they are
        now = digest(edges)
        if now == before:
            break
        before = now
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
