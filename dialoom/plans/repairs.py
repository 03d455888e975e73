"""Sections rebuilt, filled and moved, and records of older shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.operators import intervals, islands
from dialoom.plans.base import query
from dialoom.sources.tables import HOST, SEGMENTS_SQL, UNKNOWN, segments, table

SECTION = 120
SEC_SQL = SEGMENTS_SQL + f""", sec AS (SELECT file_id, CAST(floor(start_s / {SECTION}) AS BIGINT) AS k, min(start_s) AS a, max(end_s) AS b, count(*) AS n FROM seg GROUP BY 1, 2)
"""


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).groupBy("file_id", F.floor(F.col("start_s") / SECTION).alias("k")).agg(F.min("start_s").alias("a"), F.max("end_s").alias("b"), F.count("*").alias("n"))


def between_neighbours(sections: DataFrame, lost: Column, lo: Column, hi: Column) -> DataFrame:
    """``file_id``, ``k`` and bounds of the sections that are ``lost``: from the end of what is before to the start of what comes after."""
    w = W.partitionBy("file_id").orderBy("k")
    kept = lambda c: F.when(~lost, F.col(c))
    return sections.withColumns({
        "lo": F.coalesce(F.max(kept("b")).over(w.rowsBetween(W.unboundedPreceding, -1)), lo.over(W.partitionBy("file_id"))),
        "hi": F.coalesce(F.min(kept("a")).over(w.rowsBetween(1, W.unboundedFollowing)), hi.over(W.partitionBy("file_id"))),
    }).filter(lost).select("file_id", "k", "lo", "hi")


@query(SEC_SQL + """, f AS (SELECT file_id, min(a) AS lo, max(b) AS hi FROM sec GROUP BY 1), bounds AS (SELECT s.file_id, s.k, coalesce(max(o.b) FILTER (WHERE o.k < s.k), f.lo) AS lo, coalesce(min(o.a) FILTER (WHERE o.k > s.k), f.hi) AS hi FROM sec s JOIN f USING (file_id) LEFT JOIN sec o ON o.file_id = s.file_id AND o.k % 3 <> 1 WHERE s.k % 3 = 1 GROUP BY s.file_id, s.k, f.lo, f.hi),
p AS (SELECT b.k, s.* FROM seg s JOIN bounds b ON s.file_id = b.file_id AND b.hi > b.lo AND s.end_s >= b.lo AND s.start_s <= b.hi WHERE trim(text) <> ''),
m AS (SELECT *, CASE WHEN (speaker = 'SPEAKER_00') = lag(speaker = 'SPEAKER_00') OVER (PARTITION BY file_id, k ORDER BY seg_idx) THEN 0 ELSE 1 END AS c FROM p)
SELECT file_id, k, min(start_s) AS start, max(end_s) AS "end", count(*) AS raw_segment_count, sum(c) AS sentence_count FROM m GROUP BY 1, 2""")
def rebuilt_sections(spark: SparkSession, d: str) -> DataFrame:
    """Lost sections made again from the source between their neighbours, neighbours of one role merged."""
    bounds = between_neighbours(_sections(spark, d), F.col("k") % 3 == 1, F.min("a"), F.max("b")).filter("hi > lo")
    p = intervals.overlap_join(bounds, segments(spark, d).filter(F.trim("text") != ""), "file_id", ("lo", "hi"), ("start_s", "end_s")).withColumn("host", F.col("speaker") == HOST)
    runs = islands.runs(p, ["file_id", "k"], ["seg_idx"], ["host"])
    return runs.groupBy("file_id", "k").agg(F.min("start_s").alias("start"), F.max("end_s").alias("end"), F.count("*").alias("raw_segment_count"), (F.max("island") - F.min("island") + 1).alias("sentence_count"))


@query(SEGMENTS_SQL + """, plan AS (SELECT DISTINCT file_id, i AS idx, i * 100.0 + file_id % 7 AS a, i * 100.0 + file_id % 7 + 60 AS b FROM seg, (SELECT unnest(range(0, 4)) AS i))
SELECT p.file_id, idx, min(start_s) AS start, max(end_s) AS "end", count(*) AS sentence_count, count(*) FILTER (WHERE speaker = 'SPEAKER_00') AS host FROM plan p JOIN seg s ON s.file_id = p.file_id AND s.end_s >= p.a AND s.start_s <= p.b GROUP BY 1, 2""")
def planned_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections made from a plan of indexes and bounds."""
    s = segments(spark, d)
    i = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("idx")
    plan = s.select("file_id").distinct().select("file_id", i).withColumns({"a": F.col("idx") * 100.0 + F.col("file_id") % 7, "b": F.col("idx") * 100.0 + F.col("file_id") % 7 + 60})
    return intervals.overlap_join(plan, s, "file_id", ("a", "b"), ("start_s", "end_s")).groupBy("file_id", "idx").agg(
        F.min("start_s").alias("start"), F.max("end_s").alias("end"), F.count("*").alias("sentence_count"), F.count_if(F.col("speaker") == HOST).alias("host"))


@query(SEGMENTS_SQL + """, t AS (SELECT file_id, speaker, sum(end_s - start_s) AS sec, sum(sum(end_s - start_s)) OVER (PARTITION BY file_id) AS whole, count(*) AS n FROM seg GROUP BY 1, 2)
SELECT file_id, speaker, CASE WHEN speaker = 'SPEAKER_00' THEN 'host' WHEN speaker = 'UNKNOWN' OR sec < 0.12 * whole OR sec < 1 THEN 'dropped' ELSE 'guest' END AS role FROM t""")
def inferred_roles(spark: SparkSession, d: str) -> DataFrame:
    """Roles of a section's speakers; those with under 12 % of the time or 1 s are left out."""
    t = segments(spark, d).groupBy("file_id", "speaker").agg(F.sum(F.col("end_s") - F.col("start_s")).alias("sec"))
    minor = (F.col("sec") < 0.12 * F.sum("sec").over(W.partitionBy("file_id"))) | (F.col("sec") < 1)
    return t.select("file_id", "speaker", F.when(F.col("speaker") == HOST, "host").when((F.col("speaker") == UNKNOWN) | minor, "dropped").otherwise("guest").alias("role"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN 'call' ELSE CASE doc_id % 3 WHEN 0 THEN 'opening' WHEN 1 THEN 'call' ELSE 'comment' END END AS kind, (n_chars + CASE doc_id % 4 WHEN 2 THEN 100 ELSE 0 END)::DOUBLE AS start, (n_chars + 5 + CASE doc_id % 4 WHEN 2 THEN 100 ELSE 0 END)::DOUBLE AS "end", lang AS text FROM documents""")
def legacy_sections(spark: SparkSession, d: str) -> DataFrame:
    """Records of older shapes under one: other names of fields, offsets to be added, kinds under other names."""
    i, n = F.col("doc_id"), F.col("n_chars")
    kind = F.when(i % 3 == 0, "opening").when(i % 3 == 1, "call").otherwise("comment")
    old = F.when(i % 4 == 0, F.to_json(F.struct(kind.alias("kind"), n.alias("start"), (n + 5).alias("end"), F.col("lang").alias("text")))).when(
        i % 4 == 1, F.to_json(F.struct(kind.alias("type"), n.alias("start_time"), (n + 5).alias("end_time"), F.col("lang").alias("content")))).when(
        i % 4 == 2, F.to_json(F.struct(kind.alias("section_type"), F.array(n, n + 5).alias("range"), F.lit(100).alias("offset"), F.col("lang").alias("text")))).otherwise(
        F.to_json(F.struct(F.struct(n.alias("start"), (n + 5).alias("end")).alias("time"), F.col("lang").alias("sentence"))))
    return table(spark, d, "documents").select("doc_id", old.alias("raw")).select("doc_id", *formal("raw"))


def formal(raw: str) -> list[Column]:
    """kind, start, end and text of a record whatever its fields are called; the kind is a call unless it says another."""
    got = lambda *paths: F.coalesce(*[F.get_json_object(raw, p) for p in paths])
    offset = F.coalesce(got("$.offset").try_cast("double"), F.lit(0.0))
    at = lambda *paths: got(*paths).try_cast("double") + offset
    return [
        F.coalesce(got("$.kind", "$.type", "$.section_type"), F.lit("call")).alias("kind"), at("$.start", "$.start_time", "$.range[0]", "$.time.start").alias("start"),
        at("$.end", "$.end_time", "$.range[1]", "$.time.end").alias("end"), got("$.text", "$.content", "$.sentence").alias("text"),
    ]


@query("""WITH m AS (SELECT l.doc_id, CASE WHEN l.doc_id % 3 = 0 THEN 'call' END AS kind, CASE WHEN l.doc_id % 5 = 0 THEN l.doc_id END AS idx, CASE WHEN l.doc_id % 2 = 0 THEN d.lang END AS c_kind, CASE WHEN l.doc_id % 7 <> 0 THEN d.n_chars END AS c_idx FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id)
SELECT doc_id, coalesce(kind, c_kind) AS kind, coalesce(idx, c_idx) AS idx, CASE WHEN coalesce(kind, c_kind) IS NULL THEN 'cannot determine kind' WHEN coalesce(idx, c_idx) IS NULL THEN 'missing index' END AS error FROM m""")
def filled_from_counterpart(spark: SparkSession, d: str) -> DataFrame:
    """Missing fields from the counterpart; what no one has is an error and not a guess."""
    i = F.col("doc_id")
    c = table(spark, d, "documents").select("doc_id", F.when(i % 2 == 0, F.col("lang")).alias("c_kind"), F.when(i % 7 != 0, F.col("n_chars")).alias("c_idx"))
    m = table(spark, d, "labels").select("doc_id", F.when(i % 3 == 0, "call").alias("own"), F.when(i % 5 == 0, i).alias("own_idx")).join(c, "doc_id", "left")
    kind, idx = F.coalesce("own", "c_kind"), F.coalesce("own_idx", "c_idx")
    return m.select("doc_id", kind.alias("kind"), idx.alias("idx"), F.when(kind.isNull(), "cannot determine kind").when(idx.isNull(), "missing index").alias("error"))


@query(SEC_SQL + """SELECT file_id, k, count(*) AS n FROM (SELECT s.file_id, CASE WHEN CAST(floor(s.start_s / 120) AS BIGINT) % 4 = 1 AND s.start_s < floor(s.start_s / 120) * 120 + 15 THEN CAST(floor(s.start_s / 120) AS BIGINT) - 1 ELSE CAST(floor(s.start_s / 120) AS BIGINT) END AS k FROM seg s) GROUP BY 1, 2""")
def moved_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """Sentences moved to the section before, up to a time: here the first 15 s of every fourth section."""
    k = F.floor(F.col("start_s") / SECTION)
    moves = F.when((k % 4 == 1) & (F.col("start_s") < k * SECTION + 15), k - 1).otherwise(k)
    return segments(spark, d).groupBy("file_id", moves.alias("k")).agg(F.count("*").alias("n"))


KIND_OF = {"intro": "opening", "phone": "call", "outro": "comment"}


@query("""WITH r AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'intro' WHEN 'click' THEN 'phone' WHEN 'purchase' THEN 'outro' ELSE 'call' END AS old, CASE event_id % 6 WHEN 0 THEN 'host' WHEN 1 THEN 'system' WHEN 2 THEN 'unknown' WHEN 3 THEN 'speaker_2' WHEN 4 THEN 'other' ELSE 'guest' END AS s FROM events)
SELECT event_id, CASE old WHEN 'intro' THEN 'opening' WHEN 'phone' THEN 'call' WHEN 'outro' THEN 'comment' ELSE old END AS kind, CASE WHEN s IN ('host', 'system') THEN 'host' ELSE 'guest' END AS speaker,
CASE WHEN event_id % 6 = 2 AND event_id % 4 = 0 THEN 'host' WHEN event_id % 6 = 2 THEN 'unknown' WHEN s IN ('host', 'guest') THEN s ELSE 'none' END AS deduped, CASE event_id % 3 WHEN 0 THEN 'host,guest' WHEN 1 THEN 'guest' ELSE '' END AS ids FROM r""")
def normalised_speakers(spark: SparkSession, d: str) -> DataFrame:
    """Kinds and speakers under their usual names; ids once in a fixed order; the unknown are the host where a host is named."""
    i = F.col("event_id")
    old = F.when(F.col("event_type") == "view", "intro").when(F.col("event_type") == "click", "phone").when(F.col("event_type") == "purchase", "outro").otherwise("call")
    s = F.when(i % 6 == 0, "host").when(i % 6 == 1, "system").when(i % 6 == 2, "unknown").when(i % 6 == 3, "speaker_2").when(i % 6 == 4, "other").otherwise("guest")
    kinds = F.create_map(*[F.lit(x) for pair in KIND_OF.items() for x in pair])
    given = F.when(i % 3 == 0, F.array(F.lit("guest"), F.lit("host"), F.lit("guest"))).when(i % 3 == 1, F.array(F.lit("guest"), F.lit("unknown"))).otherwise(F.array(F.lit("x")))
    named = F.when((s == "unknown") & (i % 4 == 0), "host").when(s.isin("unknown", "host", "guest"), s).otherwise("none")
    return table(spark, d, "events").select(
        "event_id", F.coalesce(F.try_element_at(kinds, old), old).alias("kind"), F.when(s.isin("host", "system"), "host").otherwise("guest").alias("speaker"), named.alias("deduped"),
        F.array_join(F.array_intersect(F.array(F.lit("host"), F.lit("guest")), given), ",").alias("ids"))


@query(SEC_SQL + """, x AS (SELECT file_id, k, a, b, a + k % 4 * 0.5 AS start, b - k % 3 * 1.5 AS "end" FROM sec)
SELECT file_id, k, CASE WHEN start - a < 1 THEN least(start, a) ELSE start END AS near_start, CASE WHEN b - "end" < 1 THEN greatest(b, "end") ELSE "end" END AS near_end,
CASE WHEN greatest(start - a, b - "end") > 0 AND greatest(start - a, b - "end") <= 3 THEN least(start, a) ELSE start END AS mid_start, CASE WHEN greatest(start - a, b - "end") > 0 AND greatest(start - a, b - "end") <= 3 THEN greatest(b, "end") ELSE "end" END AS mid_end FROM x""")
def boundary_expansion(spark: SparkSession, d: str) -> DataFrame:
    """Bounds moved to their sentences where a side's gap is under 1 s, or where the larger gap is at most 3 s."""
    x = _sections(spark, d).withColumns({"start": F.col("a") + F.col("k") % 4 * 0.5, "end": F.col("b") - F.col("k") % 3 * 1.5}).withColumns({"ga": F.col("start") - F.col("a"), "gb": F.col("b") - F.col("end")})
    most = F.greatest("ga", "gb")
    mid = (most > 0) & (most <= 3)
    lo, hi = F.least("start", "a"), F.greatest("b", "end")
    return x.select("file_id", "k", F.when(F.col("ga") < 1, lo).otherwise(F.col("start")).alias("near_start"), F.when(F.col("gb") < 1, hi).otherwise(F.col("end")).alias("near_end"), F.when(mid, lo).otherwise(F.col("start")).alias("mid_start"), F.when(mid, hi).otherwise(F.col("end")).alias("mid_end"))


REF_SQL = SEC_SQL + """, kind AS (SELECT *, CASE k % 5 WHEN 0 THEN 'opening' WHEN 4 THEN 'comment' ELSE 'call' END AS kind FROM sec),
t AS (SELECT file_id, k AS target, a, b FROM kind WHERE k % 5 = 2),
r AS (SELECT t.file_id, t.target, o.k, o.kind, o.a, o.b, greatest(0, t.a - o.b, o.a - t.b) AS distance, max(CASE WHEN o.kind <> 'call' THEN 1 ELSE 0 END) OVER (PARTITION BY t.file_id, t.target) AS reliable FROM t JOIN kind o ON o.file_id = t.file_id AND o.k <> t.target),
q AS (SELECT *, row_number() OVER (PARTITION BY file_id, target ORDER BY distance, k) AS n FROM r WHERE reliable = 0 OR kind <> 'call'),
v AS (SELECT q.file_id, q.target, s.speaker, sum((least(s.end_s, h.end_s) - greatest(s.start_s, h.start_s)) / (1 + distance / 300)) AS t FROM q JOIN seg h ON h.file_id = q.file_id AND CAST(floor(h.start_s / 120) AS BIGINT) = q.k AND h.speaker = 'SPEAKER_00'
JOIN seg s ON s.file_id = h.file_id AND least(s.end_s, h.end_s) > greatest(s.start_s, h.start_s) WHERE n <= 6 GROUP BY 1, 2, 3)
"""


@query(REF_SQL + "SELECT file_id, target, speaker, t >= greatest(0.8, 0.2 * max(t) OVER (PARTITION BY file_id, target)) AS kept FROM v")
def weighted_reference_vote(spark: SparkSession, d: str) -> DataFrame:
    """Host speakers of a section by its six nearest sections, openings and comments if there are any.

    A reference's host sentences give the source's speakers under them their overlap, less the further the reference is
    away; speakers with 0.8 s and a fifth of the most are kept.
    """
    k = F.col("k") % 5
    sec = _sections(spark, d).withColumn("kind", F.when(k == 0, "opening").when(k == 4, "comment").otherwise("call"))
    t = sec.filter(k == 2).select("file_id", F.col("k").alias("target"), F.col("a").alias("ta"), F.col("b").alias("tb"))
    of = W.partitionBy("file_id", "target")
    call = F.col("kind") == "call"
    r = t.join(sec, "file_id").filter("k <> target").withColumns({"distance": F.greatest(F.lit(0.0), F.col("ta") - F.col("b"), F.col("a") - F.col("tb")), "reliable": F.max(~call).over(of)})
    q = r.filter(~F.col("reliable") | ~call).withColumn("n", F.row_number().over(of.orderBy("distance", "k"))).filter("n <= 6").select("file_id", "target", "k", "distance")
    s = segments(spark, d)
    host = s.filter(F.col("speaker") == HOST).select("file_id", F.floor(F.col("start_s") / SECTION).alias("k"), F.col("seg_idx").alias("h"), F.col("start_s").alias("hs"), F.col("end_s").alias("he"))
    under = lambda h: intervals.overlap_join(h, s, "file_id", ("hs", "he"), ("start_s", "end_s")).withColumn("o", intervals.overlap_seconds("start_s", "end_s", "hs", "he")).filter("o > 0")
    share, bound = F.col("o") / (1 + F.col("distance") / 300), F.greatest(F.lit(0.8), 0.2 * F.max("t").over(of))
    by, votes = under(host).groupBy("file_id", "k", "speaker").agg(F.sum("o").alias("o")), ["file_id", "target", "speaker"]
    v = q.join(by, ["file_id", "k"]).groupBy(*votes).agg(F.sum(share).alias("t")).withColumn("bound", bound)
    v = v.withColumn("close", F.max(F.abs(F.col("t") - F.col("bound")) < 1e-9 * F.col("bound")).over(of))
    # where rounding decides, each overlap is divided and added by itself, as in the SQL, which leaves the order open; here it is that of the sentences
    unsure = q.join(v.filter("close").select("file_id", "target").distinct(), ["file_id", "target"], "left_semi")
    each = unsure.join(under(host.join(unsure, ["file_id", "k"], "left_semi")), ["file_id", "k"]).groupBy(*votes).agg(F.sort_array(F.collect_list(F.struct("h", "seg_idx", share.alias("t")))).alias("all"))
    added = each.select(*votes, F.aggregate("all", F.lit(0.0), lambda t, x: t + x["t"]).alias("t"))
    return v.filter("not close").select(*votes, "t").unionByName(added).select(*votes, (F.col("t") >= bound).alias("kept"))


@query(SEGMENTS_SQL + """SELECT a.file_id, a.seg_idx, count(*) AS others FROM seg a JOIN seg b ON a.file_id = b.file_id AND a.speaker <> b.speaker AND least(a.end_s + 0.15, b.end_s) - greatest(a.start_s - 0.15, b.start_s) >= 0.12 GROUP BY 1, 2""")
def overlap_suspected(spark: SparkSession, d: str) -> DataFrame:
    """Segments that, widened by 0.15 s, overlap one of another speaker by 0.12 s."""
    s = segments(spark, d).withColumns({"ws": F.col("start_s") - 0.15, "we": F.col("end_s") + 0.15})
    o = segments(spark, d).select("file_id", F.col("start_s").alias("os"), F.col("end_s").alias("oe"), F.col("speaker").alias("o_speaker"))
    rows = intervals.overlap_join(s, o, "file_id", ("ws", "we"), ("os", "oe")).filter((F.col("speaker") != F.col("o_speaker")) & (intervals.overlap_seconds("ws", "we", "os", "oe") >= 0.12))
    return rows.groupBy("file_id", "seg_idx").agg(F.count("*").alias("others"))


@query("""WITH j AS (SELECT event_id, epoch_us(ts) // 1000000 AS started, event_id % 4 AS attempts, max(epoch_us(ts) // 1000000) OVER () AS now FROM events WHERE event_type = 'signup')
SELECT event_id, CASE WHEN now - started <= 3600 + 300 THEN 'running' WHEN attempts >= 3 THEN 'failed' ELSE 'retry' END AS decision FROM j""")
def job_watchdog(spark: SparkSession, d: str) -> DataFrame:
    """Jobs over their time and grace are tried again, and have failed at the third attempt."""
    from dialoom.sources.tables import epoch_seconds

    j = table(spark, d, "events").filter("event_type = 'signup'").select("event_id", epoch_seconds(F.col("ts")).alias("started"), (F.col("event_id") % 4).alias("attempts"))
    now = j.agg(F.max("started")).scalar()
    late = now - F.col("started") > 3600 + 300
    return j.select("event_id", F.when(~late, "running").when(F.col("attempts") >= 3, "failed").otherwise("retry").alias("decision"))
