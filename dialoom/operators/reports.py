"""Choices of a host, samples, lists and summaries, over segments with file_id, seg_idx, start_s, end_s, speaker and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Phrases by which a host is known, each counted once a segment.
GREETINGS = ("哈喽", "你好", "来下一个", "下一位", "拜拜", "欢迎", "谢谢")
#: Phrases that weigh for a host.
MARKERS = {"宝子们": 10, "欢迎大家": 5, "我们直接开始连麦": 20, "每人解忧铺": 10, "哈喽你好": 5, "你好，你说": 5}
#: Usable speech lasts so long, and is so loud.
SHORTEST, LONGEST, LEAST_RMS = 0.8, 12.0, 0.005


def _most(rows: DataFrame, value: str) -> Column:
    """The speaker of the largest value, of those that tie the first seen."""
    return F.min_by("speaker", F.struct((-F.col(value)).alias("v"), F.col("seen")))


def host_by_presence(segments: DataFrame, phrases: tuple[str, ...] = GREETINGS) -> DataFrame:
    """``file_id`` and ``host``: who says most of the phrases, one point for each that a segment holds; without any, who speaks longest."""
    points = sum((F.coalesce(F.contains("text", F.lit(p)), F.lit(False)).cast("long") for p in phrases), F.lit(0))
    by = segments.groupBy("file_id", F.coalesce("speaker", F.lit("UNKNOWN")).alias("speaker")).agg(
        F.sum(points).alias("points"), F.sum(F.greatest(F.col("end_s") - F.col("start_s"), F.lit(0.0))).alias("seconds"), F.min("seg_idx").alias("seen")
    )
    return by.groupBy("file_id").agg(F.when(F.max("points") > 0, _most(by, "points")).otherwise(_most(by, "seconds")).alias("host"))


def host_by_markers(segments: DataFrame, weights: dict[str, int] | None = None, unknown: str = "UNKNOWN") -> DataFrame:
    """``file_id`` and ``host``: the known speaker whose phrases weigh most, null where none is said."""
    score = sum((F.when(F.contains("text", F.lit(p)), w).otherwise(0) for p, w in (weights or MARKERS).items()), F.lit(0))
    rows = segments.withColumn("score", F.when(F.col("speaker") != unknown, score).otherwise(0))
    by = rows.groupBy("file_id", "speaker").agg(F.sum("score").alias("points"), F.min(F.when(F.col("score") > 0, F.col("seg_idx"))).alias("seen"))
    return by.groupBy("file_id").agg(F.min_by("speaker", F.when(F.col("points") > 0, F.struct((-F.col("points")).alias("v"), F.col("seen")))).alias("host"))


def without_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"[\p{P}\p{S}\s]", "")


def substantial(text: Column, least: int = 15) -> Column:
    return F.length(without_punctuation(text)) >= least


def usable(seconds: Column, rms: Column, text: Column) -> Column:
    return seconds.between(SHORTEST, LONGEST) & (rms >= LEAST_RMS) & (F.trim(text) != "")


def widened(lo: Column, hi: Column, least: float = 0.2) -> tuple[Column, Column]:
    """Bounds in order; a range under ``least`` is widened by 1 s before and 3 s after."""
    a, b = F.least(lo, hi), F.greatest(lo, hi)
    short = b - a < least
    return F.when(short, a - 1).otherwise(a), F.when(short, b + 3).otherwise(b)


def evenly(rows: DataFrame, by: str, order: str, most: int = 30) -> DataFrame:
    """Of each group at most so many rows, every n-th in order."""
    place = F.row_number().over(W.partitionBy(by).orderBy(order)) - 1
    step = F.greatest(F.lit(1), F.floor(F.count("*").over(W.partitionBy(by)) / most))
    return rows.withColumns({"__p": place, "__s": step}).filter((F.col("__p") % F.col("__s") == 0) & (F.col("__p") / F.col("__s") < most)).drop("__p", "__s")


def listing(rows: DataFrame, filters: dict[str, str | None], order: list[Column], limit: int | None = None, least: int = 1, most: int = 200, usual: int = 50) -> DataFrame:
    """Rows by the filters that are given, in order, as many as asked for within bounds."""
    for column, value in filters.items():
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows.orderBy(*order).limit(min(max(limit if limit is not None else usual, least), most))


def search(rows: DataFrame, words: str, folded: list[str], exact: list[str]) -> DataFrame:
    """Rows that hold the words in a column, without regard to case in ``folded``; no words find all rows."""
    words = words.strip()
    hit = F.lit(not words)
    for c in folded:
        hit = hit | F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(words.lower()))
    for c in exact:
        hit = hit | F.contains(F.coalesce(c, F.lit("")), F.lit(words))
    return rows.filter(hit)


def host_bank(sentences: DataFrame, most_parts: int = 300, most_vectors: int = 1200, each: int = 3) -> DataFrame:
    """``dim``, ``value`` of the unit mean of the longest usable host sentences' vectors, with ``n_vectors`` and ``n_parts`` looked at.

    ``sentences``: file_id, seg_idx, seconds, role, vector (null: not usable).  Both bounds are of the bank, which is a sample by design.
    """
    longest = W.partitionBy("file_id").orderBy(F.desc("seconds"), "seg_idx")
    good = sentences.filter((F.col("role") == "host") & F.col("seconds").between(SHORTEST, LONGEST)).withColumn("r", F.row_number().over(longest)).filter(F.col("r") <= each).filter("vector is not null")
    counts = sentences.select("file_id").distinct().join(good.groupBy("file_id").count(), "file_id", "left").orderBy("file_id").limit(most_parts)
    before = F.coalesce(F.sum(F.coalesce("count", F.lit(0))).over(W.orderBy("file_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = counts.withColumn("before", before).filter(F.col("before") < most_vectors)
    place = F.row_number().over(W.partitionBy("file_id").orderBy("r")) + F.col("before")
    chosen = good.join(F.broadcast(parts.select("file_id", "before")), "file_id").withColumn("place", place).filter(F.col("place") <= most_vectors)
    mean = chosen.select(F.posexplode("vector").alias("dim", "x")).groupBy("dim").agg(F.avg("x").alias("m"), F.count("*").alias("n_vectors"))
    norm = mean.agg(F.sqrt(F.sum(F.col("m") * F.col("m")))).scalar()
    return mean.select("dim", (F.col("m") / norm).alias("value"), "n_vectors", parts.agg(F.count("*")).scalar().alias("n_parts"))
