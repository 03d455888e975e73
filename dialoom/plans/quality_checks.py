"""Rule checks, repairs and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.operators import qc
from dialoom.plans.base import query
from dialoom.sources.tables import CHAT_SQL, SEGMENTS_SQL, UNKNOWN, chat, segments, table

TURN_SQL = CHAT_SQL + """, t AS (SELECT conv_id, turn, role, text, row_number() OVER w - 1 AS pos, lag(role) OVER w AS before, lag(turn) OVER w AS last_turn FROM chat WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
issues AS (SELECT conv_id, turn, 'error' AS severity, 'turn_index_not_sequential' AS code FROM t WHERE turn <> pos
UNION ALL SELECT conv_id, turn, 'error', 'adjacent_same_role_turns' FROM t WHERE before = role
UNION ALL SELECT conv_id, turn, 'warning', 'turn_gap' FROM t WHERE turn - last_turn > 1
UNION ALL SELECT conv_id, turn, 'error', 'empty_turn_text' FROM t WHERE trim(text) = '')
"""


def _turn_issues(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("conv_id").orderBy("turn")
    t = chat(spark, d).filter(F.col("role").isin("user", "assistant")).withColumns({"pos": F.row_number().over(w) - 1, "before": F.lag("role").over(w), "last_turn": F.lag("turn").over(w)})
    return qc.evaluated(t, [
        qc.Rule("turn_index_not_sequential", F.col("turn") != F.col("pos")),
        qc.Rule("adjacent_same_role_turns", F.col("before") == F.col("role")),
        qc.Rule("turn_gap", F.col("turn") - F.col("last_turn") > 1, "warning"),
        qc.Rule("empty_turn_text", F.trim("text") == ""),
    ])


@query(TURN_SQL + "SELECT * FROM issues")
def chat_qc_issues(spark: SparkSession, d: str) -> DataFrame:
    return qc.exploded(_turn_issues(spark, d), "conv_id", "turn").drop("path")


@query(TURN_SQL + "SELECT conv_id, CASE WHEN bool_or(severity = 'error') THEN 'fail' WHEN bool_or(severity = 'warning') THEN 'warn' ELSE 'pass' END AS status, count(severity) AS n FROM (SELECT DISTINCT conv_id FROM t) LEFT JOIN issues USING (conv_id) GROUP BY conv_id")
def chat_qc_status(spark: SparkSession, d: str) -> DataFrame:
    rows = _turn_issues(spark, d).groupBy("conv_id").agg(F.flatten(F.collect_list("issues")).alias("issues"))
    return rows.select("conv_id", qc.status_of(F.col("issues")).alias("status"), F.size("issues").cast("long").alias("n"))


@query(TURN_SQL + "SELECT code, severity, count(*) AS n, count(DISTINCT conv_id) AS conversations FROM issues GROUP BY 1, 2")
def chat_qc_summary(spark: SparkSession, d: str) -> DataFrame:
    return qc.exploded(_turn_issues(spark, d), "conv_id").groupBy("code", "severity").agg(F.count("*").alias("n"), F.countDistinct("conv_id").alias("conversations"))


FORMAL_SQL = f"""{SEGMENTS_SQL}, m AS (SELECT file_id, min(start_s) + file_id % 3 AS start, max(end_s) - file_id % 2 AS "end", count(*) - CASE WHEN file_id % 5 = 0 THEN 1 ELSE 0 END AS declared, count(*) AS n FROM seg GROUP BY file_id)
"""


def _formal(spark: SparkSession, d: str) -> DataFrame:
    """Sections with declared bounds and counts, some of which are wrong."""
    f = F.col("file_id")
    return segments(spark, d).groupBy("file_id").agg(F.min("start_s").alias("a"), F.max("end_s").alias("b"), F.count("*").alias("n")).select("file_id", (F.col("a") + f % 3).alias("start"), (F.col("b") - f % 2).alias("end"), (F.col("n") - F.when(f % 5 == 0, 1).otherwise(0)).alias("declared"), "n")


@query(FORMAL_SQL + """SELECT m.file_id, s.seg_idx, c.code FROM m JOIN seg s USING (file_id) JOIN (VALUES ('sentence_outside_section'), ('sentence_time_reversed'), ('empty_sentence_text')) c(code) ON
(code = 'sentence_outside_section' AND (s.start_s < m.start - 1e-6 OR s.end_s > m."end" + 1e-6)) OR (code = 'sentence_time_reversed' AND s.end_s < s.start_s) OR (code = 'empty_sentence_text' AND trim(text) = '')""")
def formal_sentence_issues(spark: SparkSession, d: str) -> DataFrame:
    rows = segments(spark, d).join(_formal(spark, d), "file_id")
    return qc.exploded(qc.evaluated(rows, [
        qc.Rule("sentence_outside_section", (F.col("start_s") < F.col("start") - 1e-6) | (F.col("end_s") > F.col("end") + 1e-6)),
        qc.Rule("sentence_time_reversed", F.col("end_s") < F.col("start_s")),
        qc.Rule("empty_sentence_text", F.trim("text") == ""),
    ]), "file_id", "seg_idx").select("file_id", "seg_idx", "code")


@query(FORMAL_SQL + """SELECT file_id, CASE WHEN declared <> n THEN 'normalise' WHEN start > 0 OR file_id % 2 = 1 THEN 'expand' ELSE 'keep' END AS route FROM m""")
def repair_routing(spark: SparkSession, d: str) -> DataFrame:
    """What a section's issues lead to: all safe to normalise or expand, or nothing to do."""
    rows = qc.evaluated(_formal(spark, d), [qc.Rule("sentence_count_mismatch", F.col("declared") != F.col("n")), qc.Rule("sentence_outside_section", (F.col("start") > 0) | (F.col("file_id") % 2 == 1))])
    codes = F.transform("issues", lambda i: i["code"])
    return rows.select("file_id", F.when(F.array_contains(codes, "sentence_count_mismatch"), "normalise").when(qc.all_safe(F.col("issues"), ["sentence_outside_section"]), "expand").otherwise("keep").alias("route"))


@query(f"""{SEGMENTS_SQL}, c AS (SELECT *, greatest(0.0, start_s - 3) AS s2 FROM seg WHERE trim(text) <> '' AND seg_idx % 7 <> 0)
SELECT file_id, min(s2) AS start, max(greatest(s2, end_s - 2)) AS "end", count(*) AS sentence_count, string_agg(DISTINCT CASE speaker WHEN 'SPEAKER_00' THEN 'host' WHEN 'UNKNOWN' THEN 'unknown' ELSE 'guest' END, ',' ORDER BY CASE speaker WHEN 'SPEAKER_00' THEN 'host' WHEN 'UNKNOWN' THEN 'unknown' ELSE 'guest' END) AS speakers FROM c GROUP BY file_id""")
def normalise_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections rebuilt from usable sentences: times clamped, bounds, counts and speakers anew.

    Sentences whose number is divisible by 7 stand for those that were marked unusable.
    """
    role = F.when(F.col("speaker") == "SPEAKER_00", "host").when(F.col("speaker") == UNKNOWN, "unknown").otherwise("guest")
    usable = segments(spark, d).filter((F.trim("text") != "") & (F.col("seg_idx") % 7 != 0)).withColumns({"s": F.greatest(F.lit(0.0), F.col("start_s") - 3), "role": role})
    return usable.groupBy("file_id").agg(F.min("s").alias("start"), F.max(F.greatest(F.col("s"), F.col("end_s") - 2)).alias("end"), F.count("*").alias("sentence_count"), F.array_join(F.sort_array(F.collect_set("role")), ",").alias("speakers"))


@query("""SELECT event_id, CASE WHEN event_type = 'error' AND EXISTS (SELECT 1 FROM events r WHERE r.user_id = e.user_id AND r.event_type = 'purchase' AND r.ts > e.ts) THEN 'repaired' WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS state FROM events e""")
def job_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """A failed job counts as repaired once a later rerun succeeded; the newest success of each owner decides."""
    e = table(spark, d, "events")
    ok = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("ok"))
    bad = F.col("event_type") == "error"
    return e.join(ok, "user_id", "left").select("event_id", F.when(bad & (F.col("ok") > F.col("ts")), "repaired").when(bad, "failed").otherwise("success").alias("state"))


@query("""SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'insert' WHEN l.quality = 0 THEN 'update' ELSE 'skip' END AS action FROM documents d LEFT JOIN labels l USING (doc_id)""")
def sync_catalogue(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", "quality", F.lit(True).alias("there"))
    return table(spark, d, "documents").join(labels, "doc_id", "left").select("doc_id", F.when(F.col("there").isNull(), "insert").when(F.col("quality") == 0, "update").otherwise("skip").alias("action"))


@query("""WITH u AS (SELECT doc_id AS id, quality AS v, 1 AS version FROM labels UNION ALL SELECT doc_id, toxic + 10, 2 FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, -1, 0 FROM documents)
SELECT id, v, version FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS r FROM u) WHERE r = 1""")
def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    """Rows of several versions as an upsert leaves them: the latest of each key, by a partial maximum."""
    labels, docs = table(spark, d, "labels"), table(spark, d, "documents")
    u = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("v"), F.lit(1).alias("version")).unionByName(
        labels.filter("quality = 0").select(F.col("doc_id").alias("id"), (F.col("toxic") + 10).alias("v"), F.lit(2).alias("version"))).unionByName(docs.select(F.col("doc_id").alias("id"), F.lit(-1).alias("v"), F.lit(0).alias("version")))
    return u.groupBy("id").agg(F.max(F.struct("version", "v")).alias("m")).select("id", "m.v", "m.version")


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_style_label_reference' WHEN b.item_id IS NULL THEN 'missing_turn_sample_reference' END AS code, CASE WHEN l.doc_id IS NULL THEN 'warning' ELSE 'error' END AS severity
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN benchmark b ON b.item_id = d.doc_id WHERE l.doc_id IS NULL OR b.item_id IS NULL""")
def dangling_reference(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id")
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"))
    miss = lambda rows, code, severity: rows.select("doc_id", F.lit(code).alias("code"), F.lit(severity).alias("severity"))
    no_label = docs.join(labels, "doc_id", "left_anti")
    no_item = docs.join(labels, "doc_id", "left_semi").join(items, "doc_id", "left_anti")
    return miss(no_label, "missing_style_label_reference", "warning").unionByName(miss(no_item, "missing_turn_sample_reference", "error"))


REJECT_SQL = f"""{SEGMENTS_SQL} SELECT file_id, CASE WHEN count(*) FILTER (WHERE speaker = 'SPEAKER_00') = 0 THEN 'no_host_sentences' WHEN count(*) FILTER (WHERE speaker NOT IN ('SPEAKER_00', 'UNKNOWN')) = 0 THEN 'no_guest_sentences' WHEN count(*) < 70 THEN 'turn_count_lt_70' WHEN bool_or(speaker = 'UNKNOWN' AND seg_idx = 0) THEN 'unexpected_speaker_id' END AS reason FROM seg GROUP BY file_id"""


@query(REJECT_SQL)
def reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The first reason to reject a conversation, or none."""
    host = F.col("speaker") == "SPEAKER_00"
    c = segments(spark, d).groupBy("file_id").agg(F.count_if(host).alias("h"), F.count_if(~host & (F.col("speaker") != UNKNOWN)).alias("g"), F.count("*").alias("n"), F.bool_or((F.col("speaker") == UNKNOWN) & (F.col("seg_idx") == 0)).alias("u"))
    return c.select("file_id", F.when(F.col("h") == 0, "no_host_sentences").when(F.col("g") == 0, "no_guest_sentences").when(F.col("n") < 70, "turn_count_lt_70").when(F.col("u"), "unexpected_speaker_id").alias("reason"))


@query("""SELECT text AS key, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY source = 'src0', source, doc_id) AS r FROM documents) WHERE r = 1""")
def canonical_counterpart(spark: SparkSession, d: str) -> DataFrame:
    """Of rows with one key the best ranked: not of the backup source, then by source and id."""
    best = F.min(F.struct((F.col("source") == "src0").alias("b"), "source", "doc_id")).alias("m")
    return table(spark, d, "documents").groupBy(F.col("text").alias("key")).agg(best).select("key", "m.doc_id")
