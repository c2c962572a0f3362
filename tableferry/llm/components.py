"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def _checksum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))), F.lit(0))
    ).first()
    return row[0], row[1]


def _to_smallest(directed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``(u, v, m)``: each link with the smallest node next to, or equal to, ``u``."""
    least = directed.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return least, directed.join(least, "u")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Every round points the larger neighbours, then the smaller ones, of each
    node at the smallest one and is written to the shared folder; rounds grow
    with the logarithm of the longest chain. A node with very many links costs
    one partially aggregated minimum and a join whose large partitions Spark splits.
    """
    current = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}-0",
    )
    seen, step = _checksum(current), 0
    while seen[0]:
        step += 1
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        _, joined = _to_smallest(both)
        large = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least, joined = _to_smallest(large)
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = least.select("u", F.col("m").alias("v")).unionByName(small).where("u <> v").distinct()
        current = scratch.keep(stars, f"{name}-{step}")
        now = _checksum(current)
        if now == seen:
            break
        seen = now
    return (
        current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )
