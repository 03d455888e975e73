"""Joins of intervals by time buckets, so that they are equi joins.

An interval is sent to every bucket it touches; a pair that meets in several
buckets counts in the one where its overlap begins.  A bucket holds what lies
in so many seconds of one file, whatever the file's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET = 60


def _spread(df: DataFrame, start: Column, end: Column) -> DataFrame:
    at = lambda x: F.floor(x / BUCKET).cast("long")
    return df.withColumn("__bucket", F.explode(F.sequence(at(start), F.greatest(at(start), at(end)))))


def overlap_join(left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str], right_span: tuple[str, str]) -> DataFrame:
    """Pairs of one ``key`` whose closed intervals touch; span columns' names must differ."""
    (ls, le), (rs, re) = left_span, right_span
    a, b = _spread(left, F.col(ls), F.col(le)), _spread(right, F.col(rs), F.col(re))
    begins = F.floor(F.greatest(F.col(ls), F.col(rs)) / BUCKET).cast("long")
    return a.join(b, [key, "__bucket"]).filter((F.col(le) >= F.col(rs)) & (F.col(re) >= F.col(ls)) & (F.col("__bucket") == begins)).drop("__bucket")


def point_join(left: DataFrame, right: DataFrame, key: str, point: str, span: tuple[str, str]) -> DataFrame:
    """Pairs of one ``key`` with start <= point < end."""
    a = left.withColumn("__bucket", F.floor(F.col(point) / BUCKET).cast("long"))
    b = _spread(right, F.col(span[0]), F.col(span[1]))
    return a.join(b, [key, "__bucket"]).filter((F.col(point) >= F.col(span[0])) & (F.col(point) < F.col(span[1]))).drop("__bucket")


def first_by(df: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """One row of each group: the first in order."""
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter("__r = 1").drop("__r")


def overlap_seconds(ls: str, le: str, rs: str, re: str) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.col(le), F.col(re)) - F.greatest(F.col(ls), F.col(rs)))


def whole_sentences(segments: DataFrame, host: str) -> DataFrame:
    """Segments with text, trimmed, and ``speaker_id``: host, guest, or unknown for UNKNOWN and speakers that are null."""
    who = F.coalesce("speaker", F.lit("UNKNOWN"))
    role = F.when(who == host, "host").when(who == "UNKNOWN", "unknown").otherwise("guest")
    return segments.withColumn("text", F.trim("text")).filter(F.col("text") != "").withColumn("speaker_id", role)


def split_by_overlap(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, text: str = "text", who: str = "speaker") -> DataFrame:
    """Texts of ``left`` dealt over all rows of ``right`` that they overlap, in whole characters by share of overlap.

    Both sides have ``key``, an id, ``start_s`` and ``end_s``; ``right`` has ``who``.
    Characters left over go to the largest fractions, of equals to the later row.
    A text that overlaps nothing stays whole, its speaker UNKNOWN; one that
    overlaps one row stays whole, cut to it; pieces are trimmed and may be empty;
    a null text is an empty one.  Gives key, left id, ``part`` (from 0), who,
    ``piece``, ``start_s``, ``end_s``.
    """
    texts = left.select(key, left_id, F.col("start_s").alias("ls"), F.col("end_s").alias("le"), F.trim(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    spans = right.select(key, right_id, F.col("start_s").alias("rs"), F.col("end_s").alias("re"), F.col(who).alias("who"))
    pairs = overlap_join(texts, spans, key, ("ls", "le"), ("rs", "re")).withColumn("o", overlap_seconds("ls", "le", "rs", "re")).filter("o > 0")
    row, before = W.partitionBy(key, left_id), W.partitionBy(key, left_id).orderBy("rs", right_id).rowsBetween(W.unboundedPreceding, -1)
    shares = pairs.withColumns({"exact": F.col("o") / F.sum("o").over(row) * F.length("text"), "part": F.row_number().over(row.orderBy("rs", right_id)) - 1})
    shares = shares.withColumn("whole", F.floor("exact"))
    place = F.row_number().over(row.orderBy((F.col("exact") - F.col("whole")).desc(), F.desc("part")))
    counts = shares.withColumns({"spare": F.length("text") - F.sum("whole").over(row), "place": place}).withColumn("n", F.col("whole") + (F.col("place") <= F.col("spare")).cast("int"))
    # one row takes all of the text, whatever the rounding
    at = F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int")
    piece = F.when(F.count("*").over(row) == 1, F.col("text")).otherwise(F.trim(F.substring("text", at + 1, F.col("n").cast("int"))))
    dealt = counts.select(key, left_id, "part", "who", piece.alias("piece"), F.greatest("ls", "rs").alias("start_s"), F.least("le", "re").alias("end_s"))
    rest = texts.join(pairs.select(key, left_id).distinct(), [key, left_id], "left_anti")
    alone = rest.select(key, left_id, F.lit(0).alias("part"), F.lit("UNKNOWN").alias("who"), F.col("text").alias("piece"), F.col("ls").alias("start_s"), F.col("le").alias("end_s"))
    return dealt.unionByName(alone).withColumnRenamed("who", who)


def nearest_bound(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, *carry: str) -> DataFrame:
    """For each row of ``left`` the row of ``right`` whose start is nearest to its start or whose end is nearest to its end.

    Of equally near rows the one of the least id is taken.  Both sides' bounds
    are put in order together, by key and by start or end, so the last bound
    before and the first after a row's are the only candidates; no pairs are
    made.  Gives key, left id, right id, ``distance`` and ``carry``; rows of a
    key that ``right`` lacks have nulls.
    """
    axis = lambda s, e: F.explode(F.array(F.struct(F.lit("s").alias("axis"), F.col(s).alias("t")), F.struct(F.lit("e").alias("axis"), F.col(e).alias("t")))).alias("p")
    own = left.select(key, F.col(left_id).alias("lid"), axis("start_s", "end_s")).select(key, "lid", "p.axis", "p.t")
    one = F.struct(F.col(right_id).alias("rid"), *carry).alias("row")
    bounds = right.select(key, one, axis("start_s", "end_s")).groupBy(key, F.col("p.axis").alias("axis"), F.col("p.t").alias("t")).agg(F.min_by("row", "row.rid").alias("row"))
    both = own.withColumn("bound", F.lit(None)).unionByName(bounds.select(key, "axis", "t", F.struct("row", "t").alias("bound")), allowMissingColumns=True)
    place = W.partitionBy(key, "axis").rowsBetween(W.unboundedPreceding, 0)
    last = lambda *order: F.last("bound", ignorenulls=True).over(place.orderBy(*order))
    # a bound at the same time counts as before
    met = both.withColumns({"before": last("t", F.col("lid").isNotNull()), "after": last(F.desc("t"), F.col("lid").isNotNull())}).filter("lid is not null")
    near = met.select(key, "lid", "t", F.explode_outer(F.array("before", "after")).alias("b")).select(key, "lid", F.abs(F.col("b.t") - F.col("t")).alias("distance"), "b.row")
    best = near.groupBy(key, "lid").agg(F.min_by("row", F.when(F.col("row").isNotNull(), F.struct("distance", F.col("row.rid")))).alias("row"), F.min("distance").alias("distance"))
    return best.select(key, F.col("lid").alias(left_id), F.col("row.rid").alias(right_id), "distance", *[f"row.{c}" for c in carry])


def dominant_or_nearest(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, who: str = "speaker") -> DataFrame:
    """``who`` of the most overlap in all with each row of ``left``, of equals the first met; where nothing overlaps, of the nearest bound."""
    spans = right.select(key, right_id, F.col("start_s").alias("rs"), F.col("end_s").alias("re"), who)
    # rows of left may be exploded from few, which Spark takes for their size and would broadcast
    own = left.select(key, left_id, F.col("start_s").alias("ls"), F.col("end_s").alias("le")).hint("merge")
    pairs = overlap_join(own, spans, key, ("ls", "le"), ("rs", "re")).withColumn("o", overlap_seconds("ls", "le", "rs", "re")).filter("o > 0")
    totals = pairs.groupBy(key, left_id, who).agg(F.sum("o").alias("o"), F.min(right_id).alias("f"))
    most = totals.groupBy(key, left_id).agg(F.min_by(who, F.struct(-F.col("o"), "f")).alias("most"), F.max("o").alias("seconds"))
    joined = left.select(key, left_id, "start_s", "end_s").join(most, [key, left_id], "left")
    alone = nearest_bound(joined.filter("seconds is null"), right, key, left_id, right_id, who).select(key, left_id, F.col(who).alias("near"), "distance")
    return joined.join(alone, [key, left_id], "left").select(key, left_id, F.coalesce("most", "near").alias(who), "seconds", "distance")
