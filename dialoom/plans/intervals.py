"""Interval, point and nearest joins; slices and clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import intervals as ops
from dialoom.plans.base import query
from dialoom.sources.tables import HOST, SEGMENTS_SQL, UNKNOWN, segments, windows

SEG, WIN = ("start_s", "end_s"), ("w_start", "w_end")
ON = "s.file_id = w.file_id AND s.end_s >= w.w_start AND w.w_end >= s.start_s"
OVER = "greatest(0.0, least(s.end_s, w.w_end) - greatest(s.start_s, w.w_start))"


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return ops.overlap_join(windows(spark, d), segments(spark, d), "file_id", WIN, SEG).withColumn("o", ops.overlap_seconds("start_s", "end_s", "w_start", "w_end"))


@query(f"""{SEGMENTS_SQL}, p AS (SELECT w.*, s.seg_idx, s.speaker, {OVER} AS o, (w.w_start + w.w_end) / 2 BETWEEN s.start_s AND s.end_s AS mid FROM win w LEFT JOIN seg s ON {ON}),
a AS (SELECT *, row_number() OVER (PARTITION BY file_id, w_start ORDER BY o > 0 DESC, CASE WHEN o > 0 THEN o ELSE 0 END DESC, mid DESC, seg_idx) AS r FROM p)
SELECT file_id, w_start, CASE WHEN o > 0 OR mid THEN speaker ELSE 'UNKNOWN' END AS speaker, coalesce(o, 0.0) AS o FROM a WHERE r = 1""")
def overlap_argmax_speaker(spark: SparkSession, d: str) -> DataFrame:
    """The speaker of most overlap with a tile, the earliest of equals; else one whose interval holds the middle; else unknown."""
    p = _pairs(spark, d).withColumn("mid", ((F.col("w_start") + F.col("w_end")) / 2).between(F.col("start_s"), F.col("end_s")))
    best = ops.first_by(p, ["file_id", "w_start"], F.desc("o"), F.desc("mid"), F.asc("seg_idx"))
    known = F.when((F.col("o") > 0) | F.col("mid"), F.col("speaker")).otherwise(UNKNOWN)
    out = windows(spark, d).join(best.select("file_id", "w_start", known.alias("speaker"), "o"), ["file_id", "w_start"], "left")
    return out.select("file_id", "w_start", F.coalesce("speaker", F.lit(UNKNOWN)).alias("speaker"), F.coalesce("o", F.lit(0.0)).alias("o"))


@query(f"""{SEGMENTS_SQL}, p AS (SELECT w.file_id, w.w_start, s.speaker, sum({OVER}) AS total, min(s.seg_idx) AS f FROM win w JOIN seg s ON {ON} GROUP BY 1, 2, 3)
SELECT file_id, w_start, speaker, total FROM (SELECT *, row_number() OVER (PARTITION BY file_id, w_start ORDER BY total DESC, f) AS r FROM p) WHERE r = 1""")
def dominant_speaker(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).groupBy("file_id", "w_start", "speaker").agg(F.sum("o").alias("total"), F.min("seg_idx").alias("f"))
    return ops.first_by(p, ["file_id", "w_start"], F.desc("total"), F.asc("f")).drop("f")


@query(f"""{SEGMENTS_SQL} SELECT w.file_id, w.w_start, CAST(sum(CASE WHEN speaker = 'SPEAKER_00' THEN greatest(1, length(text) // 6) ELSE 0 END) AS BIGINT) AS host, CAST(sum(CASE WHEN speaker <> 'SPEAKER_00' THEN greatest(1, length(text) // 6) ELSE 0 END) AS BIGINT) AS guest
FROM win w JOIN seg s ON s.file_id = w.file_id AND (s.start_s + s.end_s) / 2 >= w.w_start - 0.05 AND (s.start_s + s.end_s) / 2 <= w.w_end + 0.05 GROUP BY 1, 2""")
def midpoint_vote(spark: SparkSession, d: str) -> DataFrame:
    """Votes of segments whose middle lies in a tile widened by 0.05 s, weighted by length."""
    mid = segments(spark, d).withColumn("mid", (F.col("start_s") + F.col("end_s")) / 2)
    wide = windows(spark, d).withColumns({"ws": F.col("w_start") - 0.05, "we": F.col("w_end") + 0.05})
    rows = ops.overlap_join(wide, mid.withColumn("mid_e", F.col("mid")), "file_id", ("ws", "we"), ("mid", "mid_e"))
    weight = F.greatest(F.lit(1), F.floor(F.length("text") / 6))
    is_host = F.col("speaker") == HOST
    return rows.groupBy("file_id", "w_start").agg(F.sum(F.when(is_host, weight).otherwise(0)).alias("host"), F.sum(F.when(~is_host, weight).otherwise(0)).alias("guest"))


@query(f"""{SEGMENTS_SQL} SELECT w.file_id, w.w_start, min(s.seg_idx) AS seg_idx FROM win w LEFT JOIN seg s ON s.file_id = w.file_id AND s.start_s <= w.w_start AND w.w_start < s.end_s GROUP BY 1, 2""")
def current_subtitle_at(spark: SparkSession, d: str) -> DataFrame:
    """The first segment that holds a point of time, start included and end not."""
    w = windows(spark, d).select("file_id", "w_start")
    hit = ops.point_join(w, segments(spark, d), "file_id", "w_start", SEG).groupBy("file_id", "w_start").agg(F.min("seg_idx").alias("seg_idx"))
    return w.join(hit, ["file_id", "w_start"], "left")


@query(f"""{SEGMENTS_SQL} SELECT CASE WHEN w.w_start % 60 = 0 THEN 'host' ELSE 'guest' END AS role, s.speaker, sum({OVER}) AS seconds FROM win w JOIN seg s ON {ON} GROUP BY 1, 2""")
def role_overlap_matrix(spark: SparkSession, d: str) -> DataFrame:
    role = F.when(F.col("w_start") % 60 == 0, "host").otherwise("guest")
    return _pairs(spark, d).groupBy(role.alias("role"), "speaker").agg(F.sum("o").alias("seconds"))


@query(f"""{SEGMENTS_SQL}, m AS (SELECT a.file_id, a.seg_idx AS l, b.seg_idx AS r, row_number() OVER (PARTITION BY a.file_id, a.seg_idx ORDER BY (a.seg_idx = b.seg_idx) DESC, b.seg_idx) AS k FROM seg a JOIN seg b ON a.file_id = b.file_id AND a.speaker = b.speaker AND abs(a.start_s - b.start_s) <= 0.35 AND abs(a.end_s - b.end_s) <= 0.35)
SELECT file_id, l AS seg_idx, r AS matched FROM m WHERE k = 1""")
def fuzzy_key_match(spark: SparkSession, d: str) -> DataFrame:
    """The row of equal speaker with start and end within 0.35 s: of the same index, else the first."""
    s = segments(spark, d)
    o = s.select("file_id", "speaker", F.col("seg_idx").alias("matched"), F.col("start_s").alias("os"), F.col("end_s").alias("oe"))
    near = lambda c: F.explode(F.array(F.floor(F.col(c)) - 1, F.floor(F.col(c)), F.floor(F.col(c)) + 1))
    rows = s.withColumn("b", near("start_s")).join(o.withColumn("b", F.floor("os")), ["file_id", "speaker", "b"]).filter((F.abs(F.col("start_s") - F.col("os")) <= 0.35) & (F.abs(F.col("end_s") - F.col("oe")) <= 0.35))
    return ops.first_by(rows, ["file_id", "seg_idx"], (F.col("seg_idx") == F.col("matched")).desc(), F.asc("matched")).select("file_id", "seg_idx", "matched")


@query(f"""{SEGMENTS_SQL}, x AS (SELECT w.file_id, w.w_start, s.seg_idx, s.start_s >= w.w_start AND s.end_s <= w.w_end AS inside, greatest(s.start_s, w.w_start) AS c_start, least(s.end_s, w.w_end) AS c_end FROM win w JOIN seg s ON {ON})
SELECT file_id, w_start, count(*) AS overlapping, count(*) FILTER (WHERE inside) AS contained, sum(c_end - c_start) AS clipped, sum(CASE WHEN inside THEN c_end - c_start ELSE 0 END) AS whole FROM x GROUP BY 1, 2""")
def clip_to_windows(spark: SparkSession, d: str) -> DataFrame:
    """Segments kept whole inside a tile, clipped where they reach over it."""
    inside = (F.col("start_s") >= F.col("w_start")) & (F.col("end_s") <= F.col("w_end"))
    return _pairs(spark, d).groupBy("file_id", "w_start").agg(F.count("*").alias("overlapping"), F.count_if(inside).alias("contained"), F.sum("o").alias("clipped"), F.sum(F.when(inside, F.col("o")).otherwise(0.0)).alias("whole"))


@query(f"""{SEGMENTS_SQL}, t AS (SELECT file_id, max(w_end) AS top FROM win GROUP BY 1)
SELECT s.file_id, s.seg_idx, min(w.w_start) AS section, s.start_s - min(w.w_start) AS rel_s FROM seg s JOIN t USING (file_id) JOIN win w ON s.file_id = w.file_id AND s.start_s >= w.w_start AND (s.start_s < w.w_end OR (w.w_end = t.top AND s.start_s = w.w_end)) GROUP BY s.file_id, s.seg_idx, s.start_s""")
def half_open_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections take starts half-open, the last one closed; times are rebased to the section."""
    from pyspark.sql import Window as W

    w = windows(spark, d).withColumn("hi", F.col("w_end") + F.when(F.col("w_end") == F.max("w_end").over(W.partitionBy("file_id")), 0.001).otherwise(0.0))
    rows = ops.point_join(segments(spark, d).select("file_id", "seg_idx", "start_s"), w, "file_id", "start_s", ("w_start", "hi"))
    return rows.groupBy("file_id", "seg_idx", "start_s").agg(F.min("w_start").alias("section")).select("file_id", "seg_idx", "section", (F.col("start_s") - F.col("section")).alias("rel_s"))


@query(f"""{SEGMENTS_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY seg_idx) - 1 AS i, count(*) OVER (PARTITION BY file_id) AS n FROM seg WHERE end_s - start_s >= 1.2 AND length(text) >= 6)
SELECT file_id, seg_idx FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY i) AS r FROM k WHERE i % greatest(1, n // 30) = 0) WHERE r <= 30""")
def strided_sample(spark: SparkSession, d: str) -> DataFrame:
    """Thirty sentences of each file, evenly spaced; the sample is the feature."""
    from pyspark.sql import Window as W

    w = W.partitionBy("file_id")
    k = segments(spark, d).filter("end_s - start_s >= 1.2 and length(text) >= 6").withColumns({"i": F.row_number().over(w.orderBy("seg_idx")) - 1, "n": F.count("*").over(w)})
    k = k.filter(F.col("i") % F.greatest(F.lit(1), F.floor(F.col("n") / 30)) == 0)
    return k.withColumn("r", F.row_number().over(w.orderBy("i"))).filter("r <= 30").select("file_id", "seg_idx")


@query(f"""{SEGMENTS_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY file_id, speaker ORDER BY seg_idx) AS r FROM seg WHERE end_s - start_s >= 1.2 AND length(text) >= 6) SELECT file_id, speaker, seg_idx FROM k WHERE r <= 6""")
def first_six_per_speaker(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    k = segments(spark, d).filter("end_s - start_s >= 1.2 and length(text) >= 6").withColumn("r", F.row_number().over(W.partitionBy("file_id", "speaker").orderBy("seg_idx")))
    return k.filter("r <= 6").select("file_id", "speaker", "seg_idx")


@query(f"""{SEGMENTS_SQL}, t AS (SELECT *, CASE WHEN event_id % 6 = 0 THEN '  ' ELSE ' ' || text || ' ' END AS said FROM seg)
SELECT file_id, seg_idx, CASE speaker WHEN 'SPEAKER_02' THEN 'host' WHEN 'UNKNOWN' THEN 'unknown' ELSE 'guest' END AS speaker_id, start_s, end_s, trim(said) AS text FROM t WHERE trim(said) <> ''""")
def segment_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Whole segments as sentences, those without text left out, by a role for each speaker."""
    said = F.when(F.col("event_id") % 6 == 0, "  ").otherwise(F.concat(F.lit(" "), "text", F.lit(" ")))
    return ops.whole_sentences(segments(spark, d).withColumn("text", said), "SPEAKER_02").select("file_id", "seg_idx", "speaker_id", "start_s", "end_s", "text")


@query(f"""{SEGMENTS_SQL}, tiles AS (SELECT file_id, CAST(w AS BIGINT) AS seg_idx, CAST(w AS DOUBLE) AS s, CAST(w + 5 AS DOUBLE) AS e FROM (SELECT file_id, unnest(range(CAST(min(start_s) AS BIGINT), CAST(max(end_s) AS BIGINT) + 1, 5)) AS w FROM seg GROUP BY file_id)),
p AS (SELECT t.file_id, t.seg_idx, g.speaker, sum(least(t.e, g.end_s) - greatest(t.s, g.start_s)) AS o, min(g.seg_idx) AS f FROM tiles t JOIN seg g ON g.file_id = t.file_id AND least(t.e, g.end_s) > greatest(t.s, g.start_s) GROUP BY 1, 2, 3),
b AS (SELECT file_id, seg_idx, arg_min(speaker, (-o, f)) AS speaker, max(o) AS seconds FROM p GROUP BY 1, 2),
n AS (SELECT t.file_id, t.seg_idx, arg_min(g.speaker, (least(abs(g.start_s - t.s), abs(g.end_s - t.e)), g.seg_idx)) AS speaker, min(least(abs(g.start_s - t.s), abs(g.end_s - t.e))) AS distance
  FROM tiles t JOIN seg g ON g.file_id = t.file_id WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.file_id = t.file_id AND b.seg_idx = t.seg_idx) GROUP BY 1, 2)
SELECT t.file_id, t.seg_idx AS w_start, coalesce(b.speaker, n.speaker) AS speaker, b.seconds, n.distance FROM tiles t LEFT JOIN b ON b.file_id = t.file_id AND b.seg_idx = t.seg_idx LEFT JOIN n ON n.file_id = t.file_id AND n.seg_idx = t.seg_idx""")
def dominant_or_nearest_speaker(spark: SparkSession, d: str) -> DataFrame:
    """Each five seconds of a file: the speaker of most overlap in all, or of the nearest bound where nobody speaks."""
    seg = segments(spark, d)
    tiles = seg.groupBy("file_id").agg(F.explode(F.sequence(F.min("start_s").cast("long"), F.max("end_s").cast("long"), F.lit(5).cast("long"))).alias("w_start"))
    tiles = tiles.withColumns({"start_s": F.col("w_start").cast("double"), "end_s": (F.col("w_start") + 5).cast("double")})
    return ops.dominant_or_nearest(tiles, seg, "file_id", "w_start", "seg_idx")
