"""Formal section files with faults of every kind, and sections that make no conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.operators import formal_qc as ops
from dialoom.operators import qc
from dialoom.plans.base import query
from dialoom.sources.tables import SEGMENTS_SQL, segments

FILES_SQL = SEGMENTS_SQL + """, x AS (SELECT file_id, seg_idx, CASE WHEN event_id % 17 = 0 THEN end_s + 1 ELSE start_s END AS s, end_s AS e, CASE WHEN event_id % 13 = 0 THEN ' ' ELSE text END AS text, event_id % 19 = 0 AS odd FROM seg),
f AS (SELECT file_id, count(*) AS n, min(start_s) AS a, max(end_s) AS b FROM seg GROUP BY 1),
m AS (SELECT file_id, n, CASE WHEN file_id % 4 = 1 THEN b + 5 WHEN file_id % 4 = 2 THEN a + 1 ELSE a END AS a, CASE WHEN file_id % 6 = 3 THEN b - 2 ELSE b END AS b FROM f),
issues AS (
SELECT file_id, 'error' AS severity, 'json_load_error' AS code, '$' AS path FROM m WHERE file_id % 11 = 0
UNION ALL SELECT file_id, 'error', 'sentence_count_mismatch', '$.meta.sentence_count' FROM m WHERE file_id % 5 = 0 AND file_id % 11 > 1
UNION ALL SELECT file_id, 'error', 'section_time_reversed', '$.meta' FROM m WHERE a > b AND file_id % 11 > 1
UNION ALL SELECT file_id, 'error', 'sentence_not_object', '$.sentences[' || seg_idx || ']' FROM x WHERE odd AND file_id % 11 > 1
UNION ALL SELECT file_id, 'error', 'sentence_time_reversed', '$.sentences[' || seg_idx || ']' FROM x WHERE s > e AND NOT odd AND file_id % 11 > 1
UNION ALL SELECT m.file_id, 'warning', 'sentence_outside_section', '$.sentences[' || seg_idx || ']' FROM x JOIN m ON m.file_id = x.file_id WHERE NOT odd AND (s < a - 1e-6 OR e > b + 1e-6) AND m.file_id % 11 > 1
UNION ALL SELECT file_id, 'warning', 'empty_sentence_text', '$.sentences[' || seg_idx || '].text' FROM x WHERE NOT odd AND text = ' ' AND file_id % 11 > 1)
"""


def _files(spark: SparkSession, d: str) -> DataFrame:
    i, f = F.col("event_id"), F.col("file_id")
    one = F.struct(F.when(i % 17 == 0, F.col("end_s") + 1).otherwise(F.col("start_s")).alias("start"), F.col("end_s").alias("end"), F.when(i % 13 == 0, " ").otherwise(F.col("text")).alias("text"))
    item = F.when(i % 19 == 0, "7").otherwise(F.to_json(one))
    g = segments(spark, d).groupBy("file_id").agg(F.count("*").alias("n"), F.min("start_s").alias("a"), F.max("end_s").alias("b"), F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", item.alias("x")))), lambda r: r.x).alias("rows"))
    meta = F.to_json(F.struct(
        F.when(f % 4 == 1, F.col("b") + 5).when(f % 4 == 2, F.col("a") + 1).otherwise(F.col("a")).alias("start"), F.when(f % 6 == 3, F.col("b") - 2).otherwise(F.col("b")).alias("end"),
        F.when(f % 5 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("sentence_count")))
    whole = F.concat(F.lit('{"meta":'), meta, F.lit(',"sentences":['), F.array_join("rows", ","), F.lit("]}"))
    return g.select("file_id", F.when(f % 11 == 0, "{").when(f % 11 == 1, "[]").otherwise(whole).alias("raw"))


@query(FILES_SQL + "SELECT * FROM issues")
def formal_file_issues(spark: SparkSession, d: str) -> DataFrame:
    """All issues of formal section files, by path."""
    return ops.checked(_files(spark, d), "raw").select("file_id", qc.outer("issues")).filter("i is not null").select("file_id", "i.*")


@query(FILES_SQL + """SELECT m.file_id, CASE WHEN m.file_id % 11 = 1 THEN 'skip' WHEN bool_or(severity = 'error') THEN 'fail' WHEN count(severity) > 0 THEN 'warn' ELSE 'pass' END AS status, count(severity) AS n FROM m LEFT JOIN issues i ON i.file_id = m.file_id GROUP BY m.file_id""")
def formal_file_status(spark: SparkSession, d: str) -> DataFrame:
    """Files that fail, warn, pass, or are of another shape."""
    return ops.checked(_files(spark, d), "raw").select("file_id", "status", F.size("issues").cast("long").alias("n"))


@query(SEGMENTS_SQL + """, x AS (SELECT file_id, CAST(floor(start_s / 300) AS BIGINT) AS k, seg_idx, CASE WHEN speaker = 'SPEAKER_00' THEN 'host' WHEN event_id % 29 = 0 THEN 'other' WHEN event_id % 7 = 0 THEN NULL ELSE 'guest' END AS who, CASE WHEN event_id % 8 = 0 THEN '' ELSE text END AS text FROM seg),
c AS (SELECT file_id, k, count(*) AS n, count(*) FILTER (WHERE who = 'host') AS h, count(*) FILTER (WHERE who = 'guest') AS g, count(*) FILTER (WHERE who = 'other') AS o FROM x GROUP BY 1, 2),
t AS (SELECT *, sum(CASE WHEN who = before THEN 0 ELSE 1 END) OVER (PARTITION BY file_id, k ORDER BY seg_idx) - 1 AS turn FROM (SELECT *, lag(who) OVER (PARTITION BY file_id, k ORDER BY seg_idx) AS before FROM x WHERE who IN ('host', 'guest'))),
u AS (SELECT file_id, k, turn, any_value(who) AS who, bool_and(text = '') AS empty FROM t GROUP BY 1, 2, 3),
v AS (SELECT file_id, k, count(*) AS turns, bool_or(who = 'host' AND turn > 0) AS target, bool_or(empty) AS empty, string_agg(CASE who WHEN 'host' THEN 'persona' ELSE 'user' END, ',' ORDER BY turn) FILTER (WHERE turn < 12) AS roles FROM u GROUP BY 1, 2),
s AS (SELECT file_id, k FROM c UNION ALL SELECT DISTINCT file_id, -1 FROM c),
r AS (SELECT s.file_id, s.k, coalesce(n, 0) AS n, coalesce(h, 0) AS h, coalesce(g, 0) AS g, coalesce(turns, 0) AS turns, coalesce(roles, '') AS roles, list_filter([CASE WHEN n IS NULL THEN 'empty_sentences' END, CASE WHEN coalesce(h, 0) = 0 THEN 'no_host_sentences' END, CASE WHEN coalesce(g, 0) = 0 THEN 'no_guest_sentences' END,
  CASE WHEN o > 0 THEN 'unexpected_speaker_id' END, CASE WHEN coalesce(turns, 0) < 4 THEN 'turn_count_lt_4' END, CASE WHEN NOT coalesce(target, false) THEN 'no_targetable_persona_turn' END, CASE WHEN empty THEN 'empty_turn_text' END], lambda z: z IS NOT NULL) AS codes
  FROM s LEFT JOIN c ON c.file_id = s.file_id AND c.k = s.k LEFT JOIN v ON v.file_id = s.file_id AND v.k = s.k)
SELECT file_id, k, array_to_string(codes, ',') AS reason_codes, n AS sentence_count, turns AS merged_turn_count, h AS host_sentence_count, g AS guest_sentence_count, roles AS merged_role_sequence, least(n, 8) AS previewed FROM r WHERE len(codes) > 0""")
def rejected_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections that make no conversation, with all reasons and what they look like."""
    i, by = F.col("event_id"), ["file_id", "k"]
    who = F.when(F.col("speaker") == "SPEAKER_00", "host").when(i % 29 == 0, "other").when(i % 7 != 0, "guest")
    seg = segments(spark, d).withColumn("k", F.floor(F.col("start_s") / 300))
    first = F.min("seg_idx").over(W.partitionBy(*by))
    rows = seg.select(*by, (F.col("seg_idx") - first).alias("pos"), who.alias("speaker_id"), F.col("start_s").alias("start"), F.col("end_s").alias("end"), F.when(i % 8 == 0, "").otherwise(F.col("text")).alias("text"))
    sections = seg.select(*by).distinct().unionByName(seg.select("file_id", F.lit(-1).cast("long").alias("k")).distinct())
    out = ops.rejected(sections, rows, by)
    listed = [F.array_join(c, ",").alias(c) for c in ("reason_codes", "merged_role_sequence")]
    return out.select(*by, *listed, "sentence_count", "merged_turn_count", "host_sentence_count", "guest_sentence_count", F.coalesce(F.array_size("preview_sentences"), F.lit(0)).cast("long").alias("previewed"))
