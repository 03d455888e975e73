"""Sections rebuilt as whole records, held against SQL sentence by sentence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import legacy
from dialoom.operators import sections as ops
from dialoom.plans.base import query
from dialoom.plans.machines_sql import RECURSIVE
from dialoom.sources.tables import segments

SECTION = 120
KIND = "CASE k % 5 WHEN 0 THEN 'opening' WHEN 4 THEN 'comment' ELSE 'call' END"
SEC_SQL = RECURSIVE + f""", sec AS (SELECT file_id, CAST(floor(start_s / {SECTION}) AS BIGINT) AS k, min(start_s) AS a, max(end_s) AS b FROM seg GROUP BY 1, 2)"""


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).groupBy("file_id", F.floor(F.col("start_s") / SECTION).alias("k")).agg(F.min("start_s").alias("a"), F.max("end_s").alias("b"))


# Rebuilding: every third section is lost; raw segments, neighbours, hosts and a plan are there for some files each.


def _rebuilt(spark: SparkSession, d: str) -> DataFrame:
    seg, sec, f = segments(spark, d), _sections(spark, d), F.col("file_id")
    lost = sec.filter("k % 3 = 1").select(
        "file_id", F.col("k").alias("idx"), F.expr(KIND).alias("kind"), F.concat(F.lit("p"), "k").alias("persona"), F.concat(F.lit("s"), "k").alias("title"),
        F.concat(F.lit("s"), "k", F.lit(".json")).alias("file_name"), F.concat(f, F.lit(".json")).alias("source_file"), F.expr("case when k % 2 = 0 then 'seen' end").alias("notes"),
    )
    raw = seg.filter("file_id % 3 = 0").select("file_id", F.floor(F.col("start_s") / SECTION).alias("idx"), F.col("seg_idx").alias("pos"), "start_s", "end_s", "speaker", "text")
    siblings = sec.filter("k % 3 <> 1 and file_id % 7 <> 2").select("file_id", F.col("k").alias("idx"), F.col("a").alias("start"), F.expr("b + if(file_id % 7 = 3, 600, 0)").alias("end"))
    plan = sec.filter("file_id % 2 = 0").select(
        "file_id", F.expr("case when k % 2 = 0 then concat('s', k) end").alias("title"), F.expr("case when k % 2 = 1 then concat('s', k, '.json') end").alias("file_name"),
        (F.col("k") * SECTION).cast("double").alias("start"), (F.col("k") * SECTION + SECTION - 1).cast("double").alias("end"))
    hosts = seg.filter("file_id % 4 <> 0").select("file_id", F.lit("SPEAKER_00").alias("speaker")).distinct()
    return ops.rebuilt(lost, raw, siblings, seg.filter("file_id % 5 <> 1"), plan, hosts)


REBUILT_SQL = SEC_SQL + f""", lost AS (SELECT file_id, k AS idx, {KIND} AS kind, CASE WHEN k % 2 = 0 THEN 'seen' ELSE '' END AS notes FROM sec WHERE k % 3 = 1),
src AS (SELECT * FROM seg WHERE file_id % 5 <> 1 AND trim(text) <> ''), ends AS (SELECT file_id, min(start_s) AS first, max(end_s) AS last FROM src GROUP BY 1),
near AS (SELECT l.file_id, l.idx, coalesce(max(s.b + CASE WHEN s.file_id % 7 = 3 THEN 600 ELSE 0 END) FILTER (WHERE s.k < l.idx), any_value(e.first)) AS lo, coalesce(min(s.a) FILTER (WHERE s.k > l.idx), any_value(e.last)) AS hi FROM lost l JOIN ends e USING (file_id) LEFT JOIN (SELECT * FROM sec WHERE k % 3 <> 1 AND file_id % 7 <> 2) s ON s.file_id = l.file_id GROUP BY 1, 2),
cand AS (SELECT 0 AS rank, l.file_id, l.idx, seg_idx, start_s, end_s, speaker, trim(text) AS text FROM lost l JOIN seg s ON s.file_id = l.file_id AND floor(s.start_s / {SECTION}) = l.idx WHERE l.file_id % 3 = 0 AND trim(text) <> ''
  UNION ALL SELECT 1, n.file_id, n.idx, seg_idx, start_s, end_s, speaker, trim(text) FROM near n JOIN src s ON s.file_id = n.file_id AND s.end_s >= lo AND s.start_s <= hi WHERE hi > lo
  UNION ALL SELECT 2, l.file_id, l.idx, seg_idx, start_s, end_s, speaker, trim(text) FROM lost l JOIN src s ON s.file_id = l.file_id AND s.end_s >= l.idx * {SECTION} AND s.start_s <= l.idx * {SECTION} + {SECTION - 1} WHERE l.file_id % 2 = 0),
pick AS (SELECT *, first_value(speaker) OVER (PARTITION BY file_id, idx ORDER BY seg_idx) AS first FROM (SELECT *, min(rank) OVER (PARTITION BY file_id, idx) AS best FROM cand) WHERE rank = best),
roles AS (SELECT p.*, l.kind, CASE WHEN l.kind <> 'call' OR p.speaker = CASE WHEN p.file_id % 4 <> 0 THEN 'SPEAKER_00' ELSE first END THEN 'host' ELSE 'guest' END AS speaker_id FROM pick p JOIN lost l USING (file_id, idx)),
o AS (SELECT *, row_number() OVER (PARTITION BY file_id, idx ORDER BY start_s, end_s, speaker_id, seg_idx) AS place FROM roles),
m AS (SELECT file_id, idx, place, start_s AS s, end_s AS e, speaker_id AS who, CAST(0 AS BIGINT) AS sentence FROM o WHERE place = 1
  UNION ALL SELECT o.file_id, o.idx, o.place, CASE WHEN joins THEN m_s ELSE start_s END, CASE WHEN joins THEN greatest(m_e, end_s) ELSE end_s END, speaker_id, CASE WHEN joins THEN m_n ELSE m_n + 1 END
  FROM (SELECT o.*, m.s AS m_s, m.e AS m_e, m.sentence AS m_n, o.speaker_id = m.who AND o.start_s - m.e <= 0.6 AS joins FROM m JOIN o ON o.file_id = m.file_id AND o.idx = m.idx AND o.place = m.place + 1) o),
sent AS (SELECT o.file_id, o.idx, m.sentence AS pos, any_value(o.rank) AS rank, any_value(o.speaker_id) AS speaker_id, min(o.start_s) AS start, max(o.end_s) AS "end", trim(string_agg(o.text, '' ORDER BY o.place)) AS text, count(*) AS n_raw FROM o JOIN m ON m.file_id = o.file_id AND m.idx = o.idx AND m.place = o.place GROUP BY 1, 2, 3)
"""
CLOCK = "printf('%02d:%02d:%02d.%02d', CAST({0} AS BIGINT) // 3600, CAST({0} AS BIGINT) // 60 % 60, CAST({0} AS BIGINT) % 60, 0)"


@query(REBUILT_SQL + """SELECT file_id, idx, CAST(pos AS INT) AS pos, speaker_id, CASE speaker_id WHEN 'host' THEN 'Host' ELSE 'Guest' END AS speaker_name, start, "end", text FROM sent""")
def rebuilt_section_sentences(spark: SparkSession, d: str) -> DataFrame:
    """The sentences of lost sections, from the first of three sources that has any."""
    return _rebuilt(spark, d).select("file_id", "idx", F.posexplode("sentences").alias("pos", "s")).select("file_id", "idx", "pos", "s.*")


@query(REBUILT_SQL + f"""SELECT l.file_id, l.idx, CASE r.rank WHEN 0 THEN 'raw' WHEN 1 THEN 'neighbours' WHEN 2 THEN 'plan' END AS route, CASE WHEN r.rank IS NULL THEN 'no source text' END AS error, CASE WHEN r.rank IS NOT NULL THEN l.file_id || '.json' END AS source_file,
CASE WHEN r.rank IS NOT NULL THEN l.kind END AS kind, CASE WHEN r.rank IS NOT NULL THEN 'p' || l.idx END AS persona, r.a AS start, r.b AS "end", {CLOCK.format("r.a")} AS start_ts, {CLOCK.format("r.b")} AS end_ts, r.n_raw AS raw_segment_count,
CASE WHEN r.rank IS NULL THEN NULL WHEN l.kind = 'call' THEN 'host=Host,guest=Guest' ELSE 'host=Host' END AS speakers, r.n AS sentence_count,
CASE WHEN r.rank IS NOT NULL THEN l.notes || CASE WHEN l.notes = '' THEN '' ELSE '; ' END || CASE r.rank WHEN 0 THEN '{ops.NOTES[ops.RAW]}' WHEN 1 THEN '{ops.NOTES[ops.NEIGHBOURS]}' ELSE '{ops.NOTES[ops.PLAN]}' END END AS notes
FROM lost l LEFT JOIN (SELECT file_id, idx, any_value(rank) AS rank, min(start) AS a, max("end") AS b, CAST(sum(n_raw) AS BIGINT) AS n_raw, count(*) AS n FROM sent GROUP BY 1, 2) r ON r.file_id = l.file_id AND r.idx = l.idx""")
def rebuilt_section_meta(spark: SparkSession, d: str) -> DataFrame:
    """What rebuilt sections say of themselves, and why others are refused."""
    named = F.array_join(F.transform("meta.speaker_ids", lambda i: F.concat(i, F.lit("="), F.element_at("meta.speaker_names", i))), ",")
    fields = ["source_file", "kind", "persona", "start", "end", "start_ts", "end_ts", "raw_segment_count", "sentence_count", "notes"]
    return _rebuilt(spark, d).select("file_id", "idx", "route", "error", named.alias("speakers"), *[f"meta.{c}" for c in fields])


# Speaker sets: what sentences say now, what neighbouring sections say of the host, and who speaks.


def _sets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    seg, k = segments(spark, d), F.floor(F.col("start_s") / SECTION)
    sec = _sections(spark, d).select("file_id", F.col("k").alias("idx"), F.expr(KIND).alias("kind"), F.col("a").alias("start"), F.col("b").alias("end"))
    role = F.when(F.col("event_id") % 4 == 0, "unknown").when(F.col("speaker") == "SPEAKER_00", "host").otherwise("guest")
    now = seg.filter("file_id % 2 = 0").select("file_id", k.alias("idx"), role.alias("speaker_id"), F.col("start_s").alias("start"), F.col("end_s").alias("end"))
    hosts = sec.filter("idx % 4 < 2").select("file_id", "idx", F.when(F.col("idx") % 4 == 0, "SPEAKER_00").otherwise("SPEAKER_09").alias("speaker"))
    return sec, ops.speaker_sets(sec, now, seg, hosts), seg


SETS_SQL = SEC_SQL + f""", act AS (SELECT c.file_id, c.k, s.speaker, sum(least(s.end_s, c.b) - greatest(s.start_s, c.a)) AS sec, min(s.seg_idx) AS pos FROM sec c JOIN seg s ON s.file_id = c.file_id AND least(s.end_s, c.b) > greatest(s.start_s, c.a) GROUP BY ALL),
al AS (SELECT file_id, k, list(speaker ORDER BY sec DESC, pos) AS there, list(sec ORDER BY sec DESC, pos) AS secs FROM act GROUP BY ALL),
cur AS (SELECT file_id, CAST(floor(start_s / {SECTION}) AS BIGINT) AS k, CASE WHEN event_id % 4 = 0 THEN 'unknown' WHEN speaker = 'SPEAKER_00' THEN 'host' ELSE 'guest' END AS role, start_s AS a, end_s AS b FROM seg WHERE file_id % 2 = 0),
ro AS (SELECT c.file_id, c.k, c.role, s.speaker, sum(least(s.end_s, c.b) - greatest(s.start_s, c.a)) AS sec, min(s.seg_idx) AS pos FROM cur c JOIN seg s ON s.file_id = c.file_id AND least(s.end_s, c.b) > greatest(s.start_s, c.a) GROUP BY ALL),
rl AS (SELECT file_id, k, list(struct_pack(w := speaker, t := sec) ORDER BY sec DESC, pos) FILTER (WHERE role = 'host') AS hs, list(struct_pack(w := speaker, t := sec) ORDER BY sec DESC, pos) FILTER (WHERE role = 'guest') AS gs FROM ro GROUP BY ALL),
j AS (SELECT c.file_id, c.k, coalesce(al.there, []) AS there, coalesce(al.secs, []) AS secs, coalesce(rl.hs, []) AS hs, coalesce(rl.gs, []) AS gs,
  list_filter(CASE c.k % 4 WHEN 0 THEN ['SPEAKER_00'] WHEN 1 THEN ['SPEAKER_09'] ELSE CAST([] AS VARCHAR[]) END, lambda x: list_contains(coalesce(al.there, []), x)) AS known
  FROM sec c LEFT JOIN al ON al.file_id = c.file_id AND al.k = c.k LEFT JOIN rl ON rl.file_id = c.file_id AND rl.k = c.k),
h AS (SELECT *, CASE WHEN len(known) > 0 THEN known ELSE list_transform(list_filter(hs, lambda x: x.t >= greatest(0.8, hs[1].t * 0.35) AND list_contains(there, x.w)), lambda x: x.w) END AS h1 FROM j),
g AS (SELECT *, list_transform(list_filter(gs, lambda x: NOT list_contains(h1, x.w) AND x.t >= 0.8 AND NOT (x.w = 'UNKNOWN' AND len(list_filter(there, lambda y: y <> 'UNKNOWN' AND NOT list_contains(h1, y))) > 0)), lambda x: x.w)[1:1] AS g0 FROM h),
g1 AS (SELECT *, CASE WHEN len(g0) > 0 THEN g0 ELSE list_filter(there, lambda x: NOT list_contains(h1, x))[1:1] END AS g1 FROM g),
h2 AS (SELECT *, list_filter(there, lambda x: NOT list_contains(g1, x)) AS others FROM g1),
h3 AS (SELECT *, CASE WHEN len(h1) > 0 THEN h1 WHEN len(others) = 0 THEN g1 ELSE list_filter(others, lambda x: secs[list_position(there, x)] >= greatest(0.8, 0.25 * secs[list_position(there, others[1])])) END AS h2, CASE WHEN len(h1) = 0 AND len(others) = 0 THEN CAST([] AS VARCHAR[]) ELSE g1 END AS g2 FROM h2),
h4 AS (SELECT *, CASE WHEN len(g2) > 0 AND len(h2) > 1 THEN list_filter(h2, lambda x: NOT list_contains(g2, x)) ELSE h2 END AS hosts FROM h3),
sets AS (SELECT file_id, k, there, secs, list_sort(hosts) AS hosts, CASE WHEN len(g2) > 0 THEN g2 ELSE list_filter(there, lambda x: NOT list_contains(hosts, x))[1:1] END AS guests FROM h4)
"""


@query(SETS_SQL + "SELECT file_id, k AS idx, array_to_string(hosts, ',') AS hosts, array_to_string(guests, ',') AS guests, len(there) AS speakers FROM sets")
def section_speaker_sets(spark: SparkSession, d: str) -> DataFrame:
    """Hosts and guests of each section by what is known of it, of its neighbours, and by who speaks."""
    return _sets(spark, d)[1].select("file_id", "idx", F.array_join("hosts", ",").alias("hosts"), F.array_join("guests", ",").alias("guests"), F.size("active").cast("long").alias("speakers"))


@query(SETS_SQL + f""", wide AS (SELECT s.*, {KIND} AS kind, CASE WHEN c.b - c.a < 0.2 THEN c.a - 1 ELSE c.a END AS lo, CASE WHEN c.b - c.a < 0.2 THEN c.b + 3 ELSE c.b END AS hi FROM sets s JOIN sec c USING (file_id, k)),
dur AS (SELECT w.file_id, w.k, s.speaker, sum(least(s.end_s, w.hi) - greatest(s.start_s, w.lo)) AS t FROM wide w JOIN seg s ON s.file_id = w.file_id AND least(s.end_s, w.hi) > greatest(s.start_s, w.lo) GROUP BY ALL),
u AS (SELECT w.file_id, w.k, w.kind, w.hosts, w.guests, s.seg_idx, s.start_s, s.end_s, trim(s.text) AS text, s.speaker, coalesce(d.t, 0) AS t, coalesce((SELECT max(x.t) FROM dur x WHERE x.file_id = w.file_id AND x.k = w.k AND list_contains(w.guests, x.speaker)), 0) AS main
  FROM wide w JOIN seg s ON s.file_id = w.file_id AND s.end_s >= w.lo AND s.start_s <= w.hi LEFT JOIN dur d ON d.file_id = w.file_id AND d.k = w.k AND d.speaker = s.speaker WHERE trim(s.text) <> ''),
v AS (SELECT *, CASE WHEN kind <> 'call' OR list_contains(hosts, speaker) THEN 'host' ELSE 'guest' END AS role FROM u
  WHERE CASE WHEN kind <> 'call' THEN list_contains(hosts, speaker) ELSE list_contains(hosts, speaker) OR list_contains(guests, speaker) OR len(guests) = 0 OR t >= greatest(1.0, main * 0.12) END),
o AS (SELECT *, row_number() OVER (PARTITION BY file_id, k ORDER BY seg_idx) AS place FROM v),
m AS (SELECT file_id, k, place, role AS who, end_s AS e, length(text) AS n, CAST(0 AS BIGINT) AS sentence FROM o WHERE place = 1
  UNION ALL SELECT file_id, k, place, role, CASE WHEN joins THEN greatest(e, end_s) ELSE end_s END, CASE WHEN joins THEN n + length(text) ELSE length(text) END, CASE WHEN joins THEN sentence ELSE sentence + 1 END
  FROM (SELECT o.*, m.e, m.n, m.sentence, o.role = m.who AND o.start_s - m.e <= 0.8 AND m.n + length(o.text) <= 140 AS joins FROM m JOIN o ON o.file_id = m.file_id AND o.k = m.k AND o.place = m.place + 1))
SELECT o.file_id, o.k AS idx, CAST(m.sentence AS INT) AS pos, any_value(o.role) AS speaker_id, arg_min(o.start_s, o.place) AS start, max(o.end_s) AS "end", string_agg(o.text, '' ORDER BY o.place) AS text FROM o JOIN m ON m.file_id = o.file_id AND m.k = o.k AND m.place = o.place GROUP BY o.file_id, o.k, m.sentence""")
def sections_from_source(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of every section from the source by its speaker sets, minor speakers left out."""
    sec, sets, seg = _sets(spark, d)
    return ops.from_source(sec, sets, seg).select("file_id", "idx", F.posexplode("sentences").alias("pos", "s")).select("file_id", "idx", "pos", "s.*")


# Older shapes: every file as one record, in five spellings; the SQL states what each amounts to.

OLD_KIND = "CASE file_id % 3 WHEN 0 THEN 'call' ELSE 'opening' END"


def _old_records(spark: SparkSession, d: str) -> DataFrame:
    seg = segments(spark, d)
    n, s, e = F.col("start_s"), F.col("speaker"), F.col("end_s")
    clock = lambda x: F.format_string("%02d:%02d:%02d", F.floor(x / 3600), F.floor(x / 60) % 60, F.floor(x) % 60)
    shapes = [
        F.struct(s.alias("speaker_id"), n.alias("start"), e.alias("end"), F.col("text")), F.struct(s.alias("speaker"), clock(n).alias("start_time"), clock(e).alias("end_time"), F.col("text")),
        F.struct((s == "SPEAKER_02").alias("is_host"), n.alias("start"), F.col("text")), F.struct(F.lit("x").alias("speaker"), s.alias("name"), n.alias("start"), e.alias("end"), F.col("text")),
        F.struct(F.when(s == "UNKNOWN", "Guest 7").when(s == "SPEAKER_03", "hosting").otherwise(s).alias("role"), n.alias("start"), e.alias("end"), F.col("text")),
    ]
    made = []
    for k, shape in enumerate(shapes):
        rows = seg.filter(f"file_id % 5 = {k}").groupBy("file_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", shape.alias("x")))), lambda r: r.x).alias("rows"))
        whole = [
            F.struct(F.col("rows").alias("sentences"), F.struct(F.lit(7).alias("start")).alias("meta")),
            F.struct(F.col("rows").alias("segments"), F.struct(F.lit("Host of it").alias("SPEAKER_00"), F.lit("GUEST").alias("SPEAKER_01"), F.lit("?").alias("SPEAKER_02")).alias("speaker_mapping"), F.struct(F.lit("00:00:03").alias("start"), F.lit("20:00:00").alias("end")).alias("time_range")),
            F.struct(F.struct(F.col("rows").alias("turns"), F.lit("0:50").alias("original_start"), F.lit(3).alias("segment_count")).alias("meta")),
            F.struct(F.col("rows").alias("utterances"), F.array(F.lit("SPEAKER_01")).alias("hosts"), F.array(F.lit("SPEAKER_02"), F.lit("UNKNOWN")).alias("guests")),
            F.struct(F.col("rows").alias("raw_turns"), F.lit(100).alias("original_start"), F.lit("SPEAKER_02").alias("main_speaker")),
        ][k]
        made.append(rows.select("file_id", F.expr(OLD_KIND).alias("kind"), F.to_json(whole).alias("raw")))
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return legacy.formal(out, "raw", "kind")


OLD_SQL = f"""{RECURSIVE}, k AS (SELECT *, {OLD_KIND} AS kind, CASE file_id % 5 WHEN 2 THEN 50 WHEN 4 THEN 100 ELSE 0 END AS off FROM seg),
t AS (SELECT *, start_s + CASE WHEN start_s < off THEN off ELSE 0 END AS a, CASE WHEN file_id % 5 = 2 THEN start_s ELSE end_s END + CASE WHEN start_s < off THEN off ELSE 0 END AS b,
  CASE file_id % 5 WHEN 0 THEN false WHEN 1 THEN CASE speaker WHEN 'SPEAKER_00' THEN true WHEN 'SPEAKER_01' THEN false END WHEN 2 THEN speaker = 'SPEAKER_02'
    WHEN 3 THEN CASE speaker WHEN 'SPEAKER_01' THEN true WHEN 'SPEAKER_02' THEN false WHEN 'UNKNOWN' THEN false END
    ELSE CASE speaker WHEN 'SPEAKER_02' THEN true WHEN 'UNKNOWN' THEN false WHEN 'SPEAKER_03' THEN true END END AS told FROM k),
s AS (SELECT *, CASE WHEN file_id % 5 = 0 THEN kind <> 'call' ELSE coalesce(told, kind <> 'call') END AS host FROM t),
o AS (SELECT *, CASE WHEN host THEN 'host' ELSE 'guest' END AS speaker_id, row_number() OVER (PARTITION BY file_id ORDER BY a, greatest(a, b), CASE WHEN host THEN 'host' ELSE 'guest' END, seg_idx) - 1 AS pos FROM s)
"""


@query(OLD_SQL + """SELECT file_id, CAST(pos AS INT) AS pos, speaker_id, CASE WHEN host THEN 'Host' ELSE 'Guest' END AS speaker_name, a AS start, greatest(a, b) AS "end", text FROM o""")
def formal_sentences_of_old(spark: SparkSession, d: str) -> DataFrame:
    """The sentences of records of older shapes."""
    # an inner explode would infer a filter that repeats the whole record's expression below each step
    return _old_records(spark, d).select("file_id", F.posexplode_outer("formal.sentences").alias("pos", "s")).filter("pos is not null").select("file_id", "pos", "s.*")


@query(OLD_SQL + """, g AS (SELECT file_id, any_value(kind) AS kind, count(*) AS n, arg_min(a, pos) AS first, arg_max(greatest(a, b), pos) AS last, max(greatest(a, b)) AS most FROM o GROUP BY 1),
h AS (SELECT *, CASE file_id % 5 WHEN 0 THEN least(7.0, first) WHEN 1 THEN least(3.0, first) WHEN 2 THEN least(50.0, first) WHEN 4 THEN least(100.0, first) ELSE first END AS a, CASE file_id % 5 WHEN 1 THEN greatest(72000.0, last) ELSE greatest(most, last) END AS b FROM g)
SELECT file_id, kind, a AS start, greatest(a, b) AS "end", CASE file_id % 5 WHEN 2 THEN 3 ELSE n END AS raw_segment_count, CASE kind WHEN 'call' THEN 'host,guest' ELSE 'host' END AS speaker_ids, n AS sentence_count,
'repair: from ' || CASE file_id % 5 WHEN 0 THEN 'sentences' WHEN 1 THEN 'segments' WHEN 2 THEN 'turns' WHEN 3 THEN 'utterances' ELSE 'raw_turns' END || ' of an older shape' AS notes FROM h""")
def formal_meta_of_old(spark: SparkSession, d: str) -> DataFrame:
    """What records of older shapes say of themselves once they are formal."""
    fields = ["kind", "start", "end", "raw_segment_count", "sentence_count", "notes"]
    return _old_records(spark, d).select("file_id", F.array_join("formal.speaker_ids", ",").alias("speaker_ids"), *[f"formal.{c}" for c in fields])
