"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def _least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least node among u and all its neighbours in the given direction."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of the edges ``a``, ``b``.

    Alternates two steps that hang every node onto smaller neighbours until each component is a star around its least
    node. Both are a grouped minimum, combined before the shuffle, and an equi-join whose hot keys AQE splits. The edges
    of each round are a reliable checkpoint.
    """
    now = settled(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _least(large.where("u <> v").distinct())
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v")))
        now = settled(hung.where("u <> v").distinct())
        fresh = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if fresh == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = fresh
