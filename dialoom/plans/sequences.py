"""Runs, windows and boundaries over ordered segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.operators import islands
from dialoom.plans.base import query
from dialoom.sources.tables import HOST, SEGMENTS_SQL, UNKNOWN, segments


def _gap():
    return F.col("start_s") - F.col("prev_end_s")


def _merge_sql(joins: str, glue: str, speaker: str = "speaker", source: str = "seg", end: str = "arg_max(end_s, seg_idx)") -> str:
    return f"""{SEGMENTS_SQL}, a AS (SELECT *, CASE WHEN {speaker} = lag({speaker}) OVER w AND ({joins}) THEN 0 ELSE 1 END AS brk FROM {source} WINDOW w AS (PARTITION BY file_id ORDER BY seg_idx)),
i AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY file_id ORDER BY seg_idx) - 1 AS BIGINT) AS island FROM a)
SELECT file_id, island, {speaker}, arg_min(start_s, seg_idx) AS start_s, {end} AS end_s, count(*) AS n, string_agg(text, '{glue}' ORDER BY seg_idx) AS text FROM i GROUP BY file_id, island, {speaker}"""


@query(_merge_sql("start_s - lag(end_s) OVER w < 5", " "))
def segment_merge_gap5(spark: SparkSession, d: str) -> DataFrame:
    return islands.merge_speaker_runs(segments(spark, d), _gap() < 5)


@query(_merge_sql("start_s - lag(end_s) OVER w < 5", "", source="(SELECT * FROM seg WHERE trim(text) <> '')"))
def segment_concat_gap5(spark: SparkSession, d: str) -> DataFrame:
    return islands.merge_speaker_runs(segments(spark, d).filter(F.trim("text") != ""), _gap() < 5, "")


@query(_merge_sql("true", " "))
def segment_merge_nogap(spark: SparkSession, d: str) -> DataFrame:
    return islands.merge_speaker_runs(segments(spark, d))


@query(_merge_sql("start_s - lag(end_s) OVER w <= 0.5", " "))
def segment_merge_gap05(spark: SparkSession, d: str) -> DataFrame:
    return islands.merge_speaker_runs(segments(spark, d), _gap() <= 0.5)


@query(_merge_sql("end_s - start_s < 0.5 OR start_s - lag(end_s) OVER w < 0.3", ""))
def segment_merge_short_near(spark: SparkSession, d: str) -> DataFrame:
    return islands.merge_speaker_runs(segments(spark, d), (F.col("end_s") - F.col("start_s") < 0.5) | (_gap() < 0.3), "")


ROLE_SQL = "(SELECT *, CASE speaker WHEN 'SPEAKER_00' THEN 'host' WHEN 'UNKNOWN' THEN 'unknown' ELSE 'guest' END AS role FROM seg)"


def _role(df: DataFrame) -> DataFrame:
    return df.withColumn("role", F.when(F.col("speaker") == HOST, "host").when(F.col("speaker") == UNKNOWN, "unknown").otherwise("guest"))


@query(_merge_sql("start_s - lag(end_s) OVER w < 2.0", "", "role", ROLE_SQL))
def role_merge_gap2(spark: SparkSession, d: str) -> DataFrame:
    return islands.merge_speaker_runs(_role(segments(spark, d)), _gap() < 2.0, "", speaker="role")


@query(f"""{SEGMENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY start_s, end_s, role, seg_idx) AS o FROM {ROLE_SQL}),
a AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY file_id ORDER BY o) THEN 0 ELSE 1 END AS c FROM r),
b AS (SELECT *, sum(c) OVER (PARTITION BY file_id ORDER BY o) AS same FROM a),
m AS (SELECT *, max(end_s) OVER (PARTITION BY file_id, same ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
i AS (SELECT *, CAST(sum(CASE WHEN reach IS NULL OR start_s - reach > 0.6 THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY o) - 1 AS BIGINT) AS island FROM m)
SELECT file_id, island, role, min(start_s) AS start_s, max(end_s) AS end_s, count(*) AS n, string_agg(text, '' ORDER BY o) AS text FROM i GROUP BY file_id, island, role""")
def role_merge_reach06(spark: SparkSession, d: str) -> DataFrame:
    by = W.partitionBy("file_id").orderBy("start_s", "end_s", "role", "seg_idx")
    df = _role(segments(spark, d)).withColumn("o", F.row_number().over(by))
    df = islands.runs(df, ["file_id"], ["o"], ["role"]).withColumnRenamed("island", "same")
    reach = F.max("end_s").over(W.partitionBy("file_id", "same").orderBy("o").rowsBetween(W.unboundedPreceding, -1))
    df = islands.with_islands(df.withColumn("far", F.col("start_s") - reach > 0.6), ["file_id"], ["o"], F.col("far"))
    return islands.merged(df, ["file_id"], "o", ["role"], "", "largest")


@query(_merge_sql("NOT regexp_matches(lag(text) OVER w, '[。？！.?!}]$') AND lag(end_s) OVER w - start_s < 5", " ", "role", f"(SELECT * FROM {ROLE_SQL} WHERE trim(text) <> '')"))
def sentence_final_merge(spark: SparkSession, d: str) -> DataFrame:
    open_ = ~F.col("prev_text").rlike("[。？！.?!}]$") & (F.col("prev_end_s") - F.col("start_s") < 5)
    return islands.merge_speaker_runs(_role(segments(spark, d)).filter(F.trim("text") != ""), open_, speaker="role")


@query(f"""{SEGMENTS_SQL}, r AS (SELECT * FROM {ROLE_SQL} WHERE role <> 'unknown'),
a AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY file_id ORDER BY seg_idx) THEN 0 ELSE 1 END AS c FROM r),
b AS (SELECT *, sum(c) OVER (PARTITION BY file_id ORDER BY seg_idx) - 1 AS turn_index FROM a),
t AS (SELECT file_id, CAST(turn_index AS BIGINT) AS turn_index, CASE role WHEN 'host' THEN 'lead' ELSE 'user' END AS role, arg_min(start_s, seg_idx) AS start_s, max(end_s) AS end_s, min(seg_idx) AS sentence_start_idx, max(seg_idx) AS sentence_end_idx FROM b GROUP BY file_id, turn_index, role),
m AS (SELECT *, max(greatest(start_s, end_s)) OVER (PARTITION BY file_id ORDER BY turn_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM t)
SELECT file_id, turn_index, role, greatest(start_s, coalesce(prev_end, start_s)) AS start_s, greatest(start_s, end_s, coalesce(prev_end, end_s)) AS end_s, sentence_start_idx, sentence_end_idx, coalesce(start_s < prev_end, false) AS overlapped FROM m""")
def sentence_turns(spark: SparkSession, d: str) -> DataFrame:
    """Turns of one role; a start before the end so far moves to it, and ends never fall."""
    bounds = islands.runs(_role(segments(spark, d)).filter("role <> 'unknown'"), ["file_id"], ["seg_idx"], ["role"]).groupBy("file_id", "island", "role").agg(
        F.min_by("start_s", "seg_idx").alias("start_s"), F.max("end_s").alias("end_s"), F.min("seg_idx").alias("sentence_start_idx"), F.max("seg_idx").alias("sentence_end_idx"))
    before = F.max(F.greatest("start_s", "end_s")).over(W.partitionBy("file_id").orderBy("island").rowsBetween(W.unboundedPreceding, -1))
    return bounds.withColumn("prev_end", before).select(
        "file_id", F.col("island").cast("long").alias("turn_index"), F.when(F.col("role") == "host", "lead").otherwise("user").alias("role"),
        F.greatest("start_s", "prev_end").alias("start_s"), F.greatest("start_s", "end_s", "prev_end").alias("end_s"),
        "sentence_start_idx", "sentence_end_idx", F.coalesce(F.col("start_s") < F.col("prev_end"), F.lit(False)).alias("overlapped"),
    )


@query(f"""{SEGMENTS_SQL}, g AS (SELECT * FROM seg WHERE speaker NOT IN ('SPEAKER_00', 'UNKNOWN')),
a AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_id ORDER BY seg_idx) THEN 0 ELSE 1 END AS c FROM g),
b AS (SELECT *, CAST(sum(c) OVER (PARTITION BY file_id ORDER BY seg_idx) - 1 AS BIGINT) AS conv FROM a)
SELECT file_id, conv, speaker AS guest, min(seg_idx) AS first_idx, max(seg_idx) AS last_idx, arg_min(start_s, seg_idx) AS start_s, arg_max(end_s, seg_idx) AS end_s FROM b GROUP BY file_id, conv, speaker""")
def guest_change_boundaries(spark: SparkSession, d: str) -> DataFrame:
    guests = segments(spark, d).filter(~F.col("speaker").isin(HOST, UNKNOWN))
    return islands.runs(guests, ["file_id"], ["seg_idx"], ["speaker"]).groupBy("file_id", F.col("island").cast("long").alias("conv"), F.col("speaker").alias("guest")).agg(
        F.min("seg_idx").alias("first_idx"), F.max("seg_idx").alias("last_idx"), F.min_by("start_s", "seg_idx").alias("start_s"), F.max_by("end_s", "seg_idx").alias("end_s"))


@query(f"""{SEGMENTS_SQL}, n AS (SELECT s.*, CASE WHEN speaker = 'SPEAKER_00' AND contains(text, '1') THEN start_s END AS greet, CASE WHEN speaker = 'SPEAKER_00' AND contains(text, '7') THEN end_s END AS bye FROM seg s)
SELECT file_id, seg_idx, speaker, max(CASE WHEN greet >= 0 THEN greet END) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS greeting_s,
min(bye) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING) AS goodbye_s FROM n QUALIFY speaker NOT IN ('SPEAKER_00', 'UNKNOWN')""")
def refined_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """The host's greeting and goodbye within 30 rows of each guest row."""
    w = W.partitionBy("file_id").orderBy("seg_idx")
    host = F.col("speaker") == HOST
    return segments(spark, d).withColumns({
        "greeting_s": F.max(F.when(host & F.col("text").contains("1"), F.col("start_s"))).over(w.rowsBetween(-30, -1)),
        "goodbye_s": F.min(F.when(host & F.col("text").contains("7"), F.col("end_s"))).over(w.rowsBetween(1, 30)),
    }).filter(~F.col("speaker").isin(HOST, UNKNOWN)).select("file_id", "seg_idx", "speaker", "greeting_s", "goodbye_s")


@query(f"""{SEGMENTS_SQL}, f AS (SELECT *, min(start_s) OVER (PARTITION BY file_id) AS t0 FROM seg)
SELECT file_id, CAST(floor((start_s - t0) / 120) AS BIGINT) AS win, count(*) AS n, count(DISTINCT CASE WHEN speaker <> 'UNKNOWN' THEN speaker END) AS speakers,
CASE WHEN count(DISTINCT CASE WHEN speaker <> 'UNKNOWN' THEN speaker END) >= 2 THEN 'call' ELSE 'host' END AS type FROM f GROUP BY file_id, win""")
def tumbling_blocks_typed(spark: SparkSession, d: str) -> DataFrame:
    known = F.countDistinct(F.when(F.col("speaker") != UNKNOWN, F.col("speaker")))
    t0 = F.min("start_s").over(W.partitionBy("file_id"))
    return segments(spark, d).withColumn("win", F.floor((F.col("start_s") - t0) / 120)).groupBy("file_id", "win").agg(
        F.count("*").alias("n"), known.alias("speakers")).withColumn("type", F.when(F.col("speakers") >= 2, "call").otherwise("host"))


def _dialogs(df: DataFrame, size: int, step: int, gap: float) -> DataFrame:
    """Regions of windows of ``size`` rows, every ``step``, with two speakers or more."""
    w = W.partitionBy("file_id").orderBy("seg_idx").rowsBetween(0, size - 1)
    known = F.size(F.collect_set(F.when(F.col("speaker") != UNKNOWN, F.col("speaker"))).over(w))
    df = df.select("file_id", "seg_idx", "start_s", F.last("end_s").over(w).alias("end_s"), known.alias("k")).filter((F.col("k") >= 2) & (F.col("seg_idx") % step == 0))
    df = islands.merge_by_reach(df, ["file_id"], ["start_s", "seg_idx"], gap)
    return df.groupBy("file_id", F.col("island").cast("long").alias("region")).agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.count("*").alias("n"))


def _dialogs_sql(size: int, step: int, gap: int) -> str:
    return f"""{SEGMENTS_SQL}, k AS (SELECT file_id, seg_idx, start_s, last(end_s) OVER w AS end_s, len(list_distinct(list(CASE WHEN speaker <> 'UNKNOWN' THEN speaker END) OVER w)) AS k FROM seg WINDOW w AS (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)),
a AS (SELECT *, max(end_s) OVER (PARTITION BY file_id ORDER BY start_s, seg_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM k WHERE k >= 2 AND seg_idx % {step} = 0),
i AS (SELECT *, CAST(sum(CASE WHEN reach IS NULL OR start_s - reach >= {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY start_s, seg_idx) - 1 AS BIGINT) AS region FROM a)
SELECT file_id, region, min(start_s) AS start_s, max(end_s) AS end_s, count(*) AS n FROM i GROUP BY file_id, region"""


@query(_dialogs_sql(30, 1, 120))
def sliding_dialog_regions(spark: SparkSession, d: str) -> DataFrame:
    return _dialogs(segments(spark, d), 30, 1, 120)


@query(_dialogs_sql(50, 10, 180))
def sliding_regions_50_by_10(spark: SparkSession, d: str) -> DataFrame:
    return _dialogs(segments(spark, d), 50, 10, 180)


@query(_dialogs_sql(40, 15, 150))
def sliding_regions_40_by_15(spark: SparkSession, d: str) -> DataFrame:
    return _dialogs(segments(spark, d), 40, 15, 150)


@query(f"""{SEGMENTS_SQL}, k AS (SELECT *, last(end_s) OVER w AS e, len(list_distinct(list(speaker) OVER w)) AS k FROM seg WINDOW w AS (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING))
SELECT file_id, min(start_s) AS start_s, arg_max(e, seg_idx) AS end_s, count(*) AS n FROM k WHERE k >= 2 AND seg_idx % 10 = 0 GROUP BY file_id""")
def sliding_region_20_open(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 20 rows by 10; an open region has no end yet, so all of a file's windows are one region."""
    w = W.partitionBy("file_id").orderBy("seg_idx").rowsBetween(0, 19)
    df = segments(spark, d).select("file_id", "seg_idx", "start_s", F.last("end_s").over(w).alias("e"), F.size(F.collect_set("speaker").over(w)).alias("k"))
    return df.filter("k >= 2 and seg_idx % 10 = 0").groupBy("file_id").agg(F.min("start_s").alias("start_s"), F.max_by("e", "seg_idx").alias("end_s"), F.count("*").alias("n"))


@query(f"""{SEGMENTS_SQL}, x AS (SELECT *, max(CASE WHEN speaker NOT IN ('SPEAKER_00', 'UNKNOWN') THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN 1 FOLLOWING AND 29 FOLLOWING) AS g FROM seg),
z AS (SELECT a.file_id, a.seg_idx, min(b.seg_idx) FILTER (WHERE b.speaker NOT IN ('SPEAKER_00', 'UNKNOWN')) AS next_guest, min(b.seg_idx) FILTER (WHERE b.end_s - a.start_s > 30) AS solo FROM seg a LEFT JOIN seg b ON a.file_id = b.file_id AND b.seg_idx BETWEEN a.seg_idx + 1 AND a.seg_idx + 49 GROUP BY 1, 2)
SELECT file_id, seg_idx, 'call_start' AS kind, start_s FROM x WHERE speaker = 'SPEAKER_00' AND contains(text, '1') AND g = 1
UNION ALL SELECT s.file_id, s.seg_idx, 'call_end', s.start_s FROM seg s JOIN z USING (file_id, seg_idx) WHERE s.speaker NOT IN ('SPEAKER_00', 'UNKNOWN') AND contains(s.text, '7') AND (next_guest IS NULL OR solo < next_guest)""")
def call_lookahead(spark: SparkSession, d: str) -> DataFrame:
    """Call starts (greeting, a guest in the next 29 rows) and ends (goodbye, then the host alone for 30 s or to the end of 49 rows)."""
    w = W.partitionBy("file_id").orderBy("seg_idx")
    guest = ~F.col("speaker").isin(HOST, UNKNOWN)
    ahead = F.collect_list(F.struct("seg_idx", guest.alias("g"), "end_s")).over(w.rowsBetween(1, 49))
    df = segments(spark, d).withColumns({"g": F.max(guest).over(w.rowsBetween(1, 29)), "ahead": ahead})
    next_guest = F.array_min(F.transform(F.filter("ahead", lambda r: r["g"]), lambda r: r["seg_idx"]))
    solo = F.array_min(F.transform(F.filter("ahead", lambda r: r["end_s"] - F.col("start_s") > 30), lambda r: r["seg_idx"]))
    starts = df.filter((F.col("speaker") == HOST) & F.col("text").contains("1") & F.col("g"))
    ends = df.withColumns({"ng": next_guest, "solo": solo}).filter(guest & F.col("text").contains("7") & (F.col("ng").isNull() | (F.col("solo") < F.col("ng"))))
    return starts.select("file_id", "seg_idx", F.lit("call_start").alias("kind"), "start_s").unionByName(ends.select("file_id", "seg_idx", F.lit("call_end").alias("kind"), "start_s"))


CALLS_SQL = f"""{SEGMENTS_SQL}, a AS (SELECT *, speaker <> 'SPEAKER_00' AS guest, CASE WHEN (speaker <> 'SPEAKER_00') = lag(speaker <> 'SPEAKER_00') OVER (PARTITION BY file_id ORDER BY seg_idx) THEN 0 ELSE 1 END AS c FROM seg),
b AS (SELECT *, sum(c) OVER (PARTITION BY file_id ORDER BY seg_idx) AS i FROM a),
calls AS (SELECT file_id, min(seg_idx) AS start_idx, max(seg_idx) AS end_idx, arg_min(start_s, seg_idx) AS start_s, arg_max(end_s, seg_idx) AS end_s FROM b WHERE guest GROUP BY file_id, i HAVING arg_max(end_s, seg_idx) - arg_min(start_s, seg_idx) >= 60)
"""


def _calls(spark: SparkSession, d: str, least: float = 60) -> DataFrame:
    df = segments(spark, d).withColumn("guest", F.col("speaker") != HOST)
    return islands.runs(df, ["file_id"], ["seg_idx"], ["guest"]).filter("guest").groupBy("file_id", "island").agg(
        F.min("seg_idx").alias("start_idx"), F.max("seg_idx").alias("end_idx"), F.min_by("start_s", "seg_idx").alias("start_s"), F.max_by("end_s", "seg_idx").alias("end_s"),
    ).filter(F.col("end_s") - F.col("start_s") >= least).drop("island")


@query(CALLS_SQL + "SELECT *, lead(start_s) OVER (PARTITION BY file_id ORDER BY start_idx) - end_s AS comment_s, row_number() OVER (PARTITION BY file_id ORDER BY start_idx) AS call_no FROM calls")
def nonhost_calls(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("file_id").orderBy("start_idx")
    return _calls(spark, d).withColumns({"comment_s": F.lead("start_s").over(w) - F.col("end_s"), "call_no": F.row_number().over(w).cast("long")})


@query(CALLS_SQL + "SELECT file_id, start_idx, coalesce(lead(start_idx) OVER (PARTITION BY file_id ORDER BY start_idx) - 1, (SELECT max(seg_idx) FROM seg s WHERE s.file_id = calls.file_id)) AS last_idx FROM calls")
def call_comment_groups(spark: SparkSession, d: str) -> DataFrame:
    """A call with the comment after it, up to the next call."""
    last = segments(spark, d).groupBy("file_id").agg(F.max("seg_idx").alias("end"))
    nxt = F.lead("start_idx").over(W.partitionBy("file_id").orderBy("start_idx")) - 1
    return _calls(spark, d).withColumn("nxt", nxt).join(last, "file_id").select("file_id", "start_idx", F.coalesce("nxt", "end").alias("last_idx"))


@query(f"""{SEGMENTS_SQL}, p1 AS (SELECT *, lag(speaker) OVER w AS b, lead(speaker) OVER w AS a FROM seg WINDOW w AS (PARTITION BY file_id ORDER BY seg_idx)),
s1 AS (SELECT file_id, seg_idx, speaker, CASE WHEN b = a AND b <> speaker THEN b ELSE speaker END AS l FROM p1),
p2 AS (SELECT *, lag(l) OVER w AS b, lead(l) OVER w AS a FROM s1 WINDOW w AS (PARTITION BY file_id ORDER BY seg_idx))
SELECT file_id, seg_idx, speaker, CASE WHEN b = a AND b <> l THEN b ELSE l END AS label FROM p2""")
def smooth_two_pass(spark: SparkSession, d: str) -> DataFrame:
    df = segments(spark, d).select("file_id", "seg_idx", "speaker", F.col("speaker").alias("label"))
    return islands.smooth_passes(df, ["file_id"], "seg_idx", "label", 2)


@query(f"""{SEGMENTS_SQL}, e AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY seg_idx DESC) AS from_end, lead(speaker, 1) OVER w AS n1, lead(speaker, 2) OVER w AS n2, lag(speaker, 1) OVER w AS b1, lag(speaker, 2) OVER w AS b2 FROM seg WINDOW w AS (PARTITION BY file_id ORDER BY seg_idx))
SELECT file_id, seg_idx, speaker, CASE WHEN seg_idx = 0 AND n1 = n2 AND n1 <> speaker AND end_s - start_s <= 6 THEN n1 WHEN from_end = 1 AND b1 = b2 AND b1 <> speaker AND end_s - start_s <= 6 THEN b1 ELSE speaker END AS label FROM e WHERE seg_idx = 0 OR from_end = 1""")
def edge_smoothing(spark: SparkSession, d: str) -> DataFrame:
    """First and last labels take those of the next or previous two where these agree, if they are short."""
    w = W.partitionBy("file_id").orderBy("seg_idx")
    df = segments(spark, d).withColumns({"last": F.lead("seg_idx").over(w).isNull(), "n1": F.lead("speaker", 1).over(w), "n2": F.lead("speaker", 2).over(w), "b1": F.lag("speaker", 1).over(w), "b2": F.lag("speaker", 2).over(w)})
    short = F.col("end_s") - F.col("start_s") <= 6
    label = F.when((F.col("seg_idx") == 0) & (F.col("n1") == F.col("n2")) & (F.col("n1") != F.col("speaker")) & short, F.col("n1")).when(F.col("last") & (F.col("b1") == F.col("b2")) & (F.col("b1") != F.col("speaker")) & short, F.col("b1")).otherwise(F.col("speaker"))
    return df.filter("seg_idx = 0 or last").select("file_id", "seg_idx", "speaker", label.alias("label"))


@query(f"""{SEGMENTS_SQL}, a AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_id ORDER BY seg_idx) THEN 0 ELSE 1 END AS c FROM seg), b AS (SELECT *, CAST(sum(c) OVER (PARTITION BY file_id ORDER BY seg_idx) - 1 AS BIGINT) AS island FROM a)
SELECT file_id, island, speaker, min(seg_idx) AS first_idx, max(seg_idx) AS last_idx, count(*) AS n, min(start_s) AS start_s, max(end_s) AS end_s FROM b GROUP BY file_id, island, speaker""")
def run_length_labels(spark: SparkSession, d: str) -> DataFrame:
    return islands.compress(segments(spark, d), ["file_id"], "seg_idx", "speaker")


@query(f"""{SEGMENTS_SQL}, a AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_id ORDER BY seg_idx) THEN 0 ELSE 1 END AS c FROM seg), b AS (SELECT *, CAST(sum(c) OVER (PARTITION BY file_id ORDER BY seg_idx) - 1 AS BIGINT) AS island FROM a),
r AS (SELECT file_id, island, min(start_s) AS s, max(end_s) AS e, arg_min((start_s + end_s) / 2, seg_idx) AS c0, arg_max((start_s + end_s) / 2, seg_idx) AS c1 FROM b GROUP BY file_id, island)
SELECT file_id, island, coalesce((lag(c1) OVER w + c0) / 2, s) AS left_s, coalesce((c1 + lead(c0) OVER w) / 2, e) AS right_s FROM r WINDOW w AS (PARTITION BY file_id ORDER BY island)""")
def run_midpoint_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Bounds of runs half way between the centres of the rows at either side."""
    centre = (F.col("start_s") + F.col("end_s")) / 2
    r = islands.runs(segments(spark, d), ["file_id"], ["seg_idx"], ["speaker"]).groupBy("file_id", F.col("island").cast("long").alias("island")).agg(
        F.min("start_s").alias("s"), F.max("end_s").alias("e"), F.min_by(centre, "seg_idx").alias("c0"), F.max_by(centre, "seg_idx").alias("c1"))
    w = W.partitionBy("file_id").orderBy("island")
    return r.select("file_id", "island", F.coalesce((F.lag("c1").over(w) + F.col("c0")) / 2, "s").alias("left_s"), F.coalesce((F.col("c1") + F.lead("c0").over(w)) / 2, "e").alias("right_s"))


@query(f"""{SEGMENTS_SQL}, t AS (SELECT file_id, seg_idx, start_s, end_s, unnest(range(CAST(ceil((end_s - start_s) / 0.5) AS BIGINT))) AS k FROM seg WHERE end_s - start_s >= 0.2)
SELECT file_id, seg_idx, k, start_s + 0.5 * k AS left_s, least(start_s + 0.5 * k + 0.5, end_s) AS right_s FROM t WHERE least(start_s + 0.5 * k + 0.5, end_s) - (start_s + 0.5 * k) >= 0.2""")
def half_second_windows(spark: SparkSession, d: str) -> DataFrame:
    left = F.col("start_s") + 0.5 * F.col("k")
    df = segments(spark, d).filter("end_s - start_s >= 0.2").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil((F.col("end_s") - F.col("start_s")) / 0.5) - 1)))
    return df.select("file_id", "seg_idx", "k", left.alias("left_s"), F.least(left + 0.5, "end_s").alias("right_s")).filter("right_s - left_s >= 0.2")


@query(f"""{SEGMENTS_SQL}, dur AS (SELECT file_id, max(end_s) AS d FROM seg GROUP BY file_id), o AS (SELECT file_id, coalesce(sum(d) OVER (PARTITION BY file_id // 3 ORDER BY file_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM dur)
SELECT s.file_id, seg_idx, start_s + off AS start_s, end_s + off AS end_s FROM seg s JOIN o USING (file_id)""")
def cumulative_offset(spark: SparkSession, d: str) -> DataFrame:
    """Parts of a recording (three files each) one after another: each starts where the durations before it end."""
    seg = segments(spark, d)
    before = W.partitionBy(F.floor(F.col("file_id") / 3)).orderBy("file_id").rowsBetween(W.unboundedPreceding, -1)
    off = seg.groupBy("file_id").agg(F.max("end_s").alias("d")).select("file_id", F.coalesce(F.sum("d").over(before), F.lit(0.0)).alias("off"))
    return seg.join(off, "file_id").select("file_id", "seg_idx", (F.col("start_s") + F.col("off")).alias("start_s"), (F.col("end_s") + F.col("off")).alias("end_s"))


@query(f"{SEGMENTS_SQL} SELECT file_id // 3 AS episode, file_id % 3 AS part, seg_idx, start_s + (file_id % 3 - 1) * 7200 AS start_s, end_s + (file_id % 3 - 1) * 7200 AS end_s, speaker FROM seg")
def part_offset_merge(spark: SparkSession, d: str) -> DataFrame:
    """Parts of two hours; part 0, a file without suffix, is shifted back as the rule has it."""
    off = (F.col("file_id") % 3 - 1) * 7200
    return segments(spark, d).select(F.floor(F.col("file_id") / 3).alias("episode"), (F.col("file_id") % 3).alias("part"), "seg_idx", (F.col("start_s") + off).alias("start_s"), (F.col("end_s") + off).alias("end_s"), "speaker")


@query(f"{SEGMENTS_SQL} SELECT file_id, seg_idx, greatest(start_s, 100.0) AS start_s, end_s FROM seg WHERE end_s > 100")
def chunk_overlap_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).filter("end_s > 100").select("file_id", "seg_idx", F.greatest("start_s", F.lit(100.0)).alias("start_s"), "end_s")


@query(f"""{SEGMENTS_SQL}, f AS (SELECT file_id, max(end_s) AS d FROM seg GROUP BY file_id)
SELECT file_id, k, k * 540.0 AS chunk_start, least(d, k * 540.0 + 600) AS chunk_end FROM (SELECT *, unnest(range(CAST(ceil(d / 540.0) AS BIGINT))) AS k FROM f WHERE d > 0)""")
def chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of 600 s that overlap by 60; an overlap as long as a chunk would count as a tenth of it."""
    chunk, overlap = 600.0, 60.0
    stride = chunk - (overlap if overlap < chunk else chunk * 0.1)
    f = segments(spark, d).groupBy("file_id").agg(F.max("end_s").alias("d")).filter("d > 0")
    f = f.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("d") / stride) - 1)))
    return f.select("file_id", "k", (F.col("k") * stride).alias("chunk_start"), F.least("d", F.col("k") * stride + chunk).alias("chunk_end"))


@query(f"""{SEGMENTS_SQL}, f AS (SELECT file_id, max(end_s) AS d FROM seg GROUP BY file_id)
SELECT file_id, k + 1 AS part, k * 7200.0 AS start_s, least(7200.0, d - k * 7200.0) AS length_s FROM (SELECT *, unnest(range(CAST(ceil(d / 7200.0) AS BIGINT))) AS k FROM f WHERE d > 0)""")
def split_plan(spark: SparkSession, d: str) -> DataFrame:
    f = segments(spark, d).groupBy("file_id").agg(F.max("end_s").alias("d")).filter("d > 0").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("d") / 7200.0) - 1)))
    return f.select("file_id", (F.col("k") + 1).alias("part"), (F.col("k") * 7200.0).alias("start_s"), F.least(F.lit(7200.0), F.col("d") - F.col("k") * 7200.0).alias("length_s"))


@query("SELECT user_id, event_type, event_id, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_repair_mark(spark: SparkSession, d: str) -> DataFrame:
    """The latest mark of each key; of equal times the later row wins.  A partial maximum, so no key is gathered."""
    from dialoom.sources.tables import table

    latest = F.max(F.struct("ts", "event_id", "props")).alias("m")
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(latest).select("user_id", "event_type", "m.event_id", "m.props")


@query(f"{SEGMENTS_SQL} SELECT file_id, string_agg(speaker, ',' ORDER BY seg_idx) AS roles, string_agg(text, '|' ORDER BY seg_idx) FILTER (WHERE seg_idx < 8) AS sentences FROM seg WHERE seg_idx < 12 GROUP BY file_id")
def section_preview(spark: SparkSession, d: str) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("seg_idx", "speaker", "text")))
    return segments(spark, d).filter("seg_idx < 12").groupBy("file_id").agg(rows.alias("r")).select(
        "file_id", F.array_join(F.transform("r", lambda r: r["speaker"]), ",").alias("roles"), F.array_join(F.transform(F.slice("r", 1, 8), lambda r: r["text"]), "|").alias("sentences"))


@query(f"""{SEGMENTS_SQL}, r AS (SELECT *, CASE speaker WHEN 'SPEAKER_00' THEN 'host' WHEN 'UNKNOWN' THEN NULL ELSE 'guest' END AS role FROM seg),
n AS (SELECT *, first(role IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS into_role FROM r),
a AS (SELECT *, CASE WHEN into_role = lag(into_role) OVER (PARTITION BY file_id ORDER BY seg_idx) THEN 0 ELSE 1 END AS c FROM n WHERE into_role IS NOT NULL),
b AS (SELECT *, CAST(sum(c) OVER (PARTITION BY file_id ORDER BY seg_idx) - 1 AS BIGINT) AS island FROM a)
SELECT file_id, island, into_role AS role, count(*) AS n, string_agg(text, '' ORDER BY seg_idx) AS text FROM b GROUP BY file_id, island, into_role""")
def role_islands_folded(spark: SparkSession, d: str) -> DataFrame:
    """Role runs; text without a role goes before the next sentence that has one."""
    role = F.when(F.col("speaker") == HOST, "host").when(F.col("speaker") != UNKNOWN, "guest")
    ahead = W.partitionBy("file_id").orderBy("seg_idx").rowsBetween(0, W.unboundedFollowing)
    df = segments(spark, d).withColumn("r", role).withColumn("role", F.first("r", ignorenulls=True).over(ahead)).filter("role is not null")
    return islands.merge_speaker_runs(df, None, "", speaker="role").drop("start_s", "end_s")
