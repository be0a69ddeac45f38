"""Connected components by alternating large-star and small-star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidedock.llm.tables import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least, "u").where("v > u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them; edges point from larger to smaller."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Ends when a step changes nothing, after about the logarithm of the largest diameter. Minima combine map-side, and
    no node's neighbours are gathered.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stage(edges, "edges")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        edges = stage(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
