"""Boundary machines and smoothing, held against recursive SQL that takes one step a row."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import intervals, islands, links
from dialoom.operators import machines as ops
from dialoom.plans import machines_sql as q
from dialoom.plans.base import query
from dialoom.sources.tables import SEGMENTS_SQL, segments


@query(q.CONVERSATION_BOUNDARIES)
def conversation_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return ops.per_file(segments(spark, d), ops.conversation_boundaries)


@query(q.SHORT_PAIR_MERGE)
def short_pair_merge(spark: SparkSession, d: str) -> DataFrame:
    return ops.per_file(segments(spark, d), lambda pdf: ops.merge_short_pairs(list(ops.conversation_boundaries(pdf, least=0))))


@query(q.OPENING_CALL_COMMENT)
def opening_call_comment(spark: SparkSession, d: str) -> DataFrame:
    return ops.per_file(segments(spark, d), lambda pdf: ops.opening_call_comment(pdf, "1", "7"))


@query(q.GREETED_CALLS)
def greeted_calls(spark: SparkSession, d: str) -> DataFrame:
    return ops.per_file(segments(spark, d), lambda pdf: ops.greeted_calls(pdf, "99", "1", "7"))


@query(q.GUEST_RUN_CALLS)
def guest_run_calls(spark: SparkSession, d: str) -> DataFrame:
    return ops.per_file(segments(spark, d), ops.guest_run_calls)


@query(q.LOOKED_AHEAD)
def looked_ahead_guests(spark: SparkSession, d: str) -> DataFrame:
    return ops.per_file(segments(spark, d), ops.looked_ahead_guests)


@query(q.SWITCHES)
def substantial_guest_switches(spark: SparkSession, d: str) -> DataFrame:
    return ops.per_file(segments(spark, d), lambda pdf: ops.substantial_guest_switches(pdf, 8))


@query(q.CAPPED_MERGE)
def capped_role_merge(spark: SparkSession, d: str) -> DataFrame:
    return ops.per_file(segments(spark, d), ops.capped_merge)


def _relabel(pdf: pd.DataFrame, f) -> pd.DataFrame:
    pdf = pdf.sort_values("seg_idx", ignore_index=True)
    return pd.DataFrame({"file_id": pdf.file_id, "seg_idx": pdf.seg_idx, "label": f(pdf)})


LABELS = "file_id long, seg_idx long, label string"


@query(q.SMOOTH_IN_PLACE)
def smooth_in_place(spark: SparkSession, d: str) -> DataFrame:
    short = lambda p: ops.smoothed_in_place(p.speaker.tolist(), (p.end_s - p.start_s <= 1.0).to_numpy())
    return segments(spark, d).groupBy("file_id").applyInPandas(lambda p: _relabel(p, short), LABELS)


@query(q.SHORT_RUNS_MERGED)
def short_runs_merged(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).groupBy("file_id").applyInPandas(lambda p: _relabel(p, lambda q: ops.merged_short_runs(q.speaker.tolist())), LABELS)


TURNS_SQL = """c AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_id ORDER BY seg_idx) THEN 0 ELSE 1 END AS edge FROM seg),
u AS (SELECT *, CAST(sum(edge) OVER (PARTITION BY file_id ORDER BY seg_idx) - 1 AS BIGINT) AS island FROM c),
turns AS (SELECT file_id, island, speaker, arg_min(start_s, seg_idx) AS rs, arg_max(end_s, seg_idx) AS re FROM u GROUP BY ALL)"""


@query(f"""{SEGMENTS_SQL}, {TURNS_SQL},
p AS (SELECT s.file_id, s.seg_idx, s.start_s AS ls, s.end_s AS le, trim(s.text) AS text, t.island, t.rs, t.re, t.speaker, least(s.end_s, t.re) - greatest(s.start_s, t.rs) AS o FROM seg s JOIN turns t ON t.file_id = s.file_id AND least(s.end_s, t.re) > greatest(s.start_s, t.rs)),
x AS (SELECT *, o / sum(o) OVER (PARTITION BY file_id, seg_idx) * length(text) AS exact, row_number() OVER (PARTITION BY file_id, seg_idx ORDER BY rs, island) - 1 AS part, count(*) OVER (PARTITION BY file_id, seg_idx) AS k FROM p),
y AS (SELECT *, length(text) - sum(floor(exact)) OVER (PARTITION BY file_id, seg_idx) AS spare, row_number() OVER (PARTITION BY file_id, seg_idx ORDER BY exact - floor(exact) DESC, part DESC) AS place FROM x),
n AS (SELECT *, CAST(floor(exact) + CASE WHEN place <= spare THEN 1 ELSE 0 END AS BIGINT) AS n FROM y),
a AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY file_id, seg_idx ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS from_ FROM n)
SELECT file_id, seg_idx, CAST(part AS INT) AS part, speaker, CASE WHEN k = 1 THEN text ELSE trim(substring(text, from_ + 1, n)) END AS piece, greatest(ls, rs) AS start_s, least(le, re) AS end_s FROM a
UNION ALL SELECT file_id, seg_idx, 0, 'UNKNOWN', trim(text), start_s, end_s FROM seg s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.file_id = s.file_id AND p.seg_idx = s.seg_idx)""")
def split_text_by_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Each segment's text dealt over the speakers' turns that it overlaps."""
    seg = segments(spark, d)
    return intervals.split_by_overlap(seg, islands.merge_speaker_runs(seg), "file_id", "seg_idx", "island")


NAMES_SQL = """loc AS (SELECT file_id, start_s, end_s, 'SPEAKER_0' || CAST(event_id % 7 AS VARCHAR) AS speaker FROM seg WHERE start_s >= 1800),
known AS (SELECT * FROM seg WHERE start_s < 2100),
p AS (SELECT a.file_id, a.speaker AS l, b.speaker AS g, max(least(a.end_s, b.end_s) - greatest(a.start_s, b.start_s)) AS o FROM loc a JOIN known b ON a.file_id = b.file_id AND least(a.end_s, b.end_s) > greatest(a.start_s, b.start_s)
  WHERE least(a.end_s, 2100) > greatest(a.start_s, 1800) AND least(b.end_s, 2100) > greatest(b.start_s, 1800) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY o DESC, l DESC, g DESC) AS k FROM p),
m AS (SELECT file_id, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS ls, CAST([] AS VARCHAR[]) AS gs FROM (SELECT DISTINCT file_id FROM loc)
  UNION ALL SELECT file_id, k, CASE WHEN ok THEN list_append(ls, l) ELSE ls END, CASE WHEN ok THEN list_append(gs, g) ELSE gs END FROM (SELECT r.file_id, r.k, r.l, r.g, m.ls, m.gs, NOT list_contains(m.ls, r.l) AND NOT list_contains(m.gs, r.g) AS ok FROM m JOIN r ON r.file_id = m.file_id AND r.k = m.k + 1)),
f AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY k DESC) = 1),
n AS (SELECT d.file_id, d.speaker AS "local", list_position(f.ls, d.speaker) AS place, f.gs, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT file_id, speaker FROM loc) d JOIN f ON f.file_id = d.file_id LEFT JOIN (SELECT file_id, count(DISTINCT speaker) AS n FROM known GROUP BY 1) c ON c.file_id = d.file_id)"""


@query(f"""{q.RECURSIVE}, {NAMES_SQL}
SELECT file_id, "local", CASE WHEN place > 0 THEN gs[place] ELSE 'SPEAKER_' || lpad(CAST(n + row_number() OVER (PARTITION BY file_id, coalesce(place, 0) > 0 ORDER BY "local") - 1 AS VARCHAR), 2, '0') END AS global, coalesce(place, 0) > 0 AS matched FROM n""")
def greedy_speaker_match(spark: SparkSession, d: str) -> DataFrame:
    """Speakers of a second part of each file matched to those of the first by the five minutes that both cover."""
    seg = segments(spark, d)
    local = seg.filter("start_s >= 1800").withColumn("speaker", F.concat(F.lit("SPEAKER_0"), (F.col("event_id") % 7).cast("string")))
    return links.greedy_names(local, seg.filter("start_s < 2100"), "file_id", (1800.0, 2100.0))


@query(q.TYPED_GROUPS)
def typed_window_groups(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 120 s by type, neighbours joined unless a call follows the host."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("win", ignore_index=True)
        blocks = [(k, w * 120.0, w * 120.0 + 120, [int(w)]) for k, w in zip(pdf.type, pdf.win, strict=True)]
        rows = [(int(pdf.file_id.iloc[0]), i, b[0], b[1], b[2], len(b[3])) for i, b in enumerate(ops.fold_blocks(blocks, ops.same_or_short))]
        return pd.DataFrame(rows, columns=["file_id", "block", "kind", "start_s", "end_s", "windows"])

    from dialoom.plans.sequences import tumbling_blocks_typed

    return tumbling_blocks_typed(spark, d).groupBy("file_id").applyInPandas(run, "file_id long, block long, kind string, start_s double, end_s double, windows long")
