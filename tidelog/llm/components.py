"""Connected components of an edge table, as rounds of joins and aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of an edge: ``root`` is the smallest node reachable.

    Alternating stars: in each round every node's larger neighbours, then its smaller ones, are linked
    to its least neighbour, which keeps the components and about halves the paths.  Groups are only
    reduced by partial aggregates and joins, never listed.  The least neighbours are written before they
    are joined, so both sides of the join are plain shuffles and the edges of a hub can be split.  Every
    round is written to the checkpoint folder; the rounds end when the edges no longer change.
    """
    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """``u, v`` with v < u; large: each node's larger neighbours move to its least one."""
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least")
        near = both.where("v > u") if large else both
        moved = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
        return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pairs = written(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while (now := digest(pairs)) != before:
        before = now
        pairs = written(star(star(pairs, True), False), "edges")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
