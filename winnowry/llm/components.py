"""Connected components by alternating stars, without leaving the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.staging import stage


def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component_id)`` for every id on an edge; the component is its smallest id.

    Each round joins every node's larger neighbours to its smallest one (large
    star), then its smaller neighbours (small star); rounds grow with the
    logarithm of the longest path. Every round is written to the shared folder,
    so a lost executor costs one round at most. Edges with a null end are ignored.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = stage(edges.where(F.col(a) != F.col(b)).select(u, v).distinct(), "edges")
    seen = _checksum(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u").where("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(root.select("u", F.col("m").alias("v"))).distinct()
        )
        edges = stage(small, "edges")
        before, seen = seen, _checksum(edges)
        if seen == before:
            break
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return leaves.union(roots)
