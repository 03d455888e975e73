"""Vectors as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """0 where either has no length."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def centroids(df: DataFrame, by: list[str], vector: str) -> DataFrame:
    """Mean vector of each group, by dimension, so that a group is never gathered."""
    long = df.select(*by, F.posexplode(vector).alias("dim", "x"))
    means = long.groupBy(*by, "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("centroid"))


def weighted_means(df: DataFrame, by: list[str], vector: str, weight: str, least: float = 1.0) -> DataFrame:
    """``by``, ``mean`` and ``weight`` (in all) of each group's vectors, longer speech counting more; rows of a weight under ``least`` are left out.

    Sums run by dimension and are combined before the shuffle, so a group is one
    row a dimension and task, and is never gathered.
    """
    long = df.filter(F.col(weight) >= least).select(*by, F.col(weight).cast("double").alias("w"), F.posexplode(vector).alias("dim", "x"))
    sums = long.groupBy(*by, "dim").agg(F.sum(F.col("w") * F.col("x").cast("double")).alias("s"), F.sum("w").alias("w")).filter("w > 0")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("dim", (F.col("s") / F.col("w")).alias("x")))), lambda d: d.x)
    return sums.groupBy(*by).agg(listed.alias("mean"), F.max("w").alias("weight"))
