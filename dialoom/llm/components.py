"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.session import cut, release

MOST_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star over edges (u > v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    own = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(own, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(own.select("u", F.col("m").alias("v"))).filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node that can be reached, for nodes that are not their own.

    ``edges``: columns a and b.  Neighbours of a node are never gathered; each
    round is joins and least values, and is written to the shared folder.
    """
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(MOST_ROUNDS):
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
        now = cut(_stars(now))
        release(now.sparkSession)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
