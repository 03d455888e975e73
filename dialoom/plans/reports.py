"""Hosts by phrases, slices and lists, summaries and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.operators import reports as ops
from dialoom.plans.base import query
from dialoom.sources.tables import SEGMENTS_SQL, UNKNOWN, segments, table

#: The test tables hold no greetings; these stand for phrases in them.
PHRASES, WEIGHTS = ("7", "click", "page"), {"click": 10, "3": 5, "signup": 20, "view": 2}
_points = " + ".join(f"CASE WHEN contains(text, '{p}') THEN 1 ELSE 0 END" for p in PHRASES)
_score = " + ".join(f"CASE WHEN contains(text, '{p}') THEN {w} ELSE 0 END" for p, w in WEIGHTS.items())
ROLE = "CASE WHEN speaker = 'SPEAKER_00' THEN 'host' WHEN speaker = 'UNKNOWN' THEN 'unknown' ELSE 'guest' END"


def role():
    return F.when(F.col("speaker") == "SPEAKER_00", "host").when(F.col("speaker") == UNKNOWN, "unknown").otherwise("guest")


@query(f"""{SEGMENTS_SQL}, b AS (SELECT file_id, speaker, sum({_points}) AS points, sum(greatest(end_s - start_s, 0)) AS seconds, min(seg_idx) AS seen FROM seg GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY points DESC, seen) AS p, row_number() OVER (PARTITION BY file_id ORDER BY seconds DESC, seen) AS q, max(points) OVER (PARTITION BY file_id) AS top FROM b)
SELECT file_id, speaker AS host FROM r WHERE CASE WHEN top > 0 THEN p ELSE q END = 1""")
def host_by_presence(spark: SparkSession, d: str) -> DataFrame:
    return ops.host_by_presence(segments(spark, d), PHRASES)


@query(f"""{SEGMENTS_SQL}, s AS (SELECT *, CASE WHEN speaker <> 'UNKNOWN' THEN {_score} ELSE 0 END AS score FROM seg),
b AS (SELECT file_id, speaker, sum(score) AS points, min(CASE WHEN score > 0 THEN seg_idx END) AS seen FROM s GROUP BY 1, 2)
SELECT file_id, (SELECT speaker FROM b x WHERE x.file_id = f.file_id AND points > 0 ORDER BY points DESC, seen LIMIT 1) AS host FROM (SELECT DISTINCT file_id FROM seg) f""")
def host_by_markers(spark: SparkSession, d: str) -> DataFrame:
    return ops.host_by_markers(segments(spark, d), WEIGHTS)


@query("SELECT event_id, length(regexp_replace(props, '[^\\p{L}\\p{N}\\p{M}\\p{C}]', '', 'g')) >= 12 AS substantial, (event_id % 20) * 1.0 BETWEEN 0.8 AND 12 AND value / 1000 >= 0.005 AND trim(props) <> '' AS usable FROM events")
def speech_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Substantial by length without punctuation; usable by length, loudness and text."""
    seconds = (F.col("event_id") % 20).cast("double")
    return table(spark, d, "events").select("event_id", ops.substantial(F.col("props"), 12).alias("substantial"), ops.usable(seconds, F.col("value") / 1000, F.col("props")).alias("usable"))


@query(f"""{SEGMENTS_SQL}, b AS (SELECT DISTINCT file_id, file_id % 5 * 20.0 AS a, file_id % 5 * 20.0 + CASE file_id % 4 WHEN 0 THEN 0.1 WHEN 1 THEN -30 ELSE 45 END AS z FROM seg),
w AS (SELECT file_id, least(a, z) AS a, greatest(a, z) AS z, CASE WHEN greatest(a, z) - least(a, z) < 0.2 THEN least(a, z) - 1 ELSE least(a, z) END AS lo, CASE WHEN greatest(a, z) - least(a, z) < 0.2 THEN greatest(a, z) + 3 ELSE greatest(a, z) END AS hi FROM b)
SELECT file_id, count(*) FILTER (WHERE start_s BETWEEN a AND z) AS closed, count(*) FILTER (WHERE end_s >= lo AND start_s <= hi) AS overlapping, count(*) FILTER (WHERE seg_idx BETWEEN 2 AND 5) AS by_index FROM w JOIN seg USING (file_id) GROUP BY file_id""")
def range_slices(spark: SparkSession, d: str) -> DataFrame:
    """Slices by start, by overlap with bounds in either order, and by index."""
    s = segments(spark, d)
    f = F.col("file_id")
    a, z = (f % 5) * 20.0, (f % 5) * 20.0 + F.when(f % 4 == 0, 0.1).when(f % 4 == 1, -30.0).otherwise(45.0)
    lo, hi = ops.widened(a, z)
    return s.groupBy("file_id").agg(
        F.count_if(F.col("start_s").between(F.least(a, z), F.greatest(a, z))).alias("closed"),
        F.count_if((F.col("end_s") >= lo) & (F.col("start_s") <= hi)).alias("overlapping"), F.count_if(F.col("seg_idx").between(2, 5)).alias("by_index"))


@query("""WITH c AS (SELECT lang, doc_id, n_chars % 700 AS seconds, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) SELECT lang, doc_id FROM c WHERE NOT (r <= 2 AND seconds < 300)""")
def intro_outro_filter(spark: SparkSession, d: str) -> DataFrame:
    """Without the first two conversations of a stream where they are short."""
    r = F.row_number().over(W.partitionBy("lang").orderBy("doc_id"))
    return table(spark, d, "documents").select("lang", "doc_id", (F.col("n_chars") % 700).alias("seconds"), r.alias("r")).filter(~((F.col("r") <= 2) & (F.col("seconds") < 300))).select("lang", "doc_id")


@query("""SELECT doc_id FROM documents WHERE contains(lower(source), 'src1') OR contains(lower(lang), 'src1') OR contains(CAST(doc_id AS VARCHAR), 'SRC1')""")
def text_search(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source", "lang", F.col("doc_id").cast("string").alias("day"))
    return ops.search(rows, " SRC1 ", ["source", "lang"], ["day"]).select("doc_id")


@query("SELECT doc_id, quality FROM labels WHERE toxic = 0 ORDER BY doc_id DESC LIMIT 200")
def case_listing(spark: SparkSession, d: str) -> DataFrame:
    """A filter that is given, one that is not, and more rows asked for than a page may have."""
    return ops.listing(table(spark, d, "labels"), {"toxic": "0", "quality": None}, [F.desc("doc_id")], 900).select("doc_id", "quality")


@query(f"""{SEGMENTS_SQL}, x AS (SELECT s.*, sum(end_s - start_s) OVER (PARTITION BY file_id, speaker) AS t, min(seg_idx) OVER (PARTITION BY file_id, speaker) AS seen FROM seg s WHERE end_s > 20 AND start_s < 400 AND trim(text) <> ''),
h AS (SELECT file_id, arg_min(speaker, (-t, seen)) AS host FROM x WHERE speaker <> 'UNKNOWN' GROUP BY file_id)
SELECT x.file_id, x.seg_idx, CASE WHEN h.host IS NULL OR x.speaker = h.host THEN 'host' ELSE 'guest' END AS role FROM x LEFT JOIN h USING (file_id)""")
def section_roles(spark: SparkSession, d: str) -> DataFrame:
    """Rows that strictly overlap a section; its longest known speaker is host, and without any everyone is."""
    x = segments(spark, d).filter("end_s > 20 and start_s < 400 and trim(text) <> ''")
    t = x.filter(F.col("speaker") != UNKNOWN).groupBy("file_id", "speaker").agg(F.sum(F.col("end_s") - F.col("start_s")).alias("t"), F.min("seg_idx").alias("seen"))
    h = t.groupBy("file_id").agg(F.min_by("speaker", F.struct((-F.col("t")).alias("t"), "seen")).alias("host"))
    return x.join(h, "file_id", "left").select("file_id", "seg_idx", F.when(F.col("host").isNull() | (F.col("speaker") == F.col("host")), "host").otherwise("guest").alias("role"))


@query(f"""{SEGMENTS_SQL}, x AS (SELECT file_id, CASE WHEN event_id % 9 = 0 THEN CASE {ROLE} WHEN 'host' THEN 'guest' ELSE 'host' END ELSE {ROLE} END AS now, {ROLE} AS was, event_id FROM seg)
SELECT file_id, now AS speaker, count(*) AS n, count(*) FILTER (WHERE now <> was) AS changed, count(*) FILTER (WHERE event_id % 14 = 0) AS split FROM x GROUP BY 1, 2""")
def correction_summary(spark: SparkSession, d: str) -> DataFrame:
    """Segments, corrected ones and split ones by speaker after correction."""
    x = segments(spark, d).withColumn("was", role()).withColumn("now", F.when(F.col("event_id") % 9 == 0, F.when(F.col("was") == "host", "guest").otherwise("host")).otherwise(F.col("was")))
    return x.groupBy("file_id", F.col("now").alias("speaker")).agg(F.count("*").alias("n"), F.count_if(F.col("now") != F.col("was")).alias("changed"), F.count_if(F.col("event_id") % 14 == 0).alias("split"))


@query(f"""{SEGMENTS_SQL}, v AS (SELECT s.file_id, {ROLE} AS role, e.value, row_number() OVER (PARTITION BY s.file_id ORDER BY seg_idx) - 1 AS p, greatest(1, count(*) OVER (PARTITION BY s.file_id) // 30) AS step FROM seg s JOIN events e USING (event_id)),
k AS (SELECT * FROM v WHERE p % step = 0 AND p / step < 30)
SELECT file_id, count(*) FILTER (WHERE role = 'host') AS n_host, count(*) FILTER (WHERE role = 'guest') AS n_guest, round(avg(value) FILTER (WHERE role = 'host'), 6) AS host_volume, round(avg(value) FILTER (WHERE role = 'guest'), 6) AS guest_volume,
CASE WHEN file_id % 3 <> 0 AND count(*) FILTER (WHERE role = 'guest') = 0 THEN 'no_guest_samples' END AS suspect FROM k GROUP BY file_id""")
def volume_by_section(spark: SparkSession, d: str) -> DataFrame:
    """Mean volumes of host and guest over at most 30 sentences a section; a call without guests is suspect."""
    v = segments(spark, d).join(table(spark, d, "events").select("event_id", "value"), "event_id").withColumn("role", role())
    host, guest = F.col("role") == "host", F.col("role") == "guest"
    return ops.evenly(v, "file_id", "seg_idx").groupBy("file_id").agg(
        F.count_if(host).alias("n_host"), F.count_if(guest).alias("n_guest"), F.round(F.avg(F.when(host, F.col("value"))), 6).alias("host_volume"), F.round(F.avg(F.when(guest, F.col("value"))), 6).alias("guest_volume"),
    ).withColumn("suspect", F.when((F.col("file_id") % 3 != 0) & (F.col("n_guest") == 0), "no_guest_samples"))


@query("""WITH f AS (SELECT CASE doc_id % 5 WHEN 0 THEN 'opening_' WHEN 1 THEN 'comment_' ELSE 'call_' END || doc_id AS name, n_chars / 60.0 AS minutes FROM documents)
SELECT count(*) AS sections, count(*) FILTER (WHERE contains(name, 'opening')) AS openings, count(*) FILTER (WHERE contains(name, 'call')) AS calls, count(*) FILTER (WHERE contains(name, 'comment')) AS comments, round(sum(minutes), 3) AS minutes FROM f""")
def section_report(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    name = F.concat(F.when(i % 5 == 0, "opening_").when(i % 5 == 1, "comment_").otherwise("call_"), i.cast("string"))
    f = table(spark, d, "documents").select(name.alias("name"), (F.col("n_chars") / 60.0).alias("minutes"))
    kinds = [F.count_if(F.contains("name", F.lit(k))).alias(f"{k}s") for k in ("opening", "call", "comment")]
    return f.agg(F.count("*").alias("sections"), *kinds, F.round(F.sum("minutes"), 3).alias("minutes"))


@query(f"""{SEGMENTS_SQL}, s AS (SELECT file_id, seg_idx, end_s - start_s AS sec, {ROLE} AS role, CASE WHEN event_id % 10 <> 3 THEN event_id % 500 END AS v FROM seg),
g AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY sec DESC, seg_idx) AS r FROM s WHERE role = 'host' AND sec BETWEEN 0.8 AND 12),
k AS (SELECT g.file_id, r, e.embedding FROM g JOIN embeddings e ON e.vec_id = g.v WHERE r <= 3),
p AS (SELECT f.file_id, count(k.file_id) AS n FROM (SELECT DISTINCT file_id FROM s) f LEFT JOIN k USING (file_id) GROUP BY f.file_id ORDER BY f.file_id LIMIT 30),
b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY file_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p),
c AS (SELECT k.*, row_number() OVER (PARTITION BY file_id ORDER BY r) + before AS place FROM k JOIN b USING (file_id) WHERE before < 60),
m AS (SELECT i - 1 AS dim, avg(CAST(embedding[i] AS DOUBLE)) AS m, count(*) AS n_vectors FROM c, (SELECT unnest(range(1, 65)) AS i) WHERE place <= 60 GROUP BY i)
SELECT dim, round(m / sqrt((SELECT sum(m * m) FROM m)), 6) AS value, n_vectors, (SELECT count(*) FROM b WHERE before < 60) AS n_parts FROM m""")
def host_bank(spark: SparkSession, d: str) -> DataFrame:
    """The host's mean voice over 30 parts and 60 vectors at most."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("v"), F.col("embedding").cast("array<double>").alias("vector"))
    s = segments(spark, d).select("file_id", "seg_idx", (F.col("end_s") - F.col("start_s")).alias("seconds"), role().alias("role"), F.when(F.col("event_id") % 10 != 3, F.col("event_id") % 500).alias("v"))
    return ops.host_bank(s.join(e, "v", "left"), 30, 60).withColumn("value", F.round("value", 6))


@query("""SELECT lang, count(*) AS entries, CAST(sum(n_chars) AS BIGINT) AS bytes, CASE WHEN count(quality) > 0 THEN round(sum(quality) / count(quality), 6) END AS hit_rate FROM documents LEFT JOIN (SELECT * FROM labels WHERE doc_id % 4 = 0) USING (doc_id) GROUP BY lang""")
def cache_summary(spark: SparkSession, d: str) -> DataFrame:
    """Entries, bytes and hit rate of a cache by kind; no rate without lookups."""
    looked = table(spark, d, "labels").filter("doc_id % 4 = 0").select("doc_id", "quality")
    rate = F.round(F.try_divide(F.sum("quality"), F.count("quality")), 6)
    return table(spark, d, "documents").join(looked, "doc_id", "left").groupBy("lang").agg(F.count("*").alias("entries"), F.sum("n_chars").alias("bytes"), rate.alias("hit_rate"))


@query("""WITH r AS (SELECT source AS suite, count(DISTINCT lang) FILTER (WHERE length(source) % 2 = 0 OR lang = 'en') AS runs FROM documents GROUP BY source), o AS (SELECT *, row_number() OVER (ORDER BY runs < 2, suite) AS p FROM r) SELECT suite, runs, p = 1 AS is_default FROM o""")
def suite_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Runs of each suite; the first suite that can be compared is the default, else the first."""
    run = F.when((F.length("source") % 2 == 0) | (F.col("lang") == "en"), F.col("lang"))
    r = table(spark, d, "documents").groupBy(F.col("source").alias("suite")).agg(F.countDistinct(run).alias("runs"))
    best = r.agg(F.min(F.struct((F.col("runs") < 2).alias("few"), "suite"))["suite"]).scalar()
    return r.select("suite", "runs", (F.col("suite") == best).alias("is_default"))


@query(f"""{SEGMENTS_SQL}, x AS (SELECT file_id, count(*) AS n, count(*) FILTER (WHERE {ROLE} = 'host') AS h, count(*) FILTER (WHERE {ROLE} = 'guest') AS g, count(*) FILTER (WHERE before > start_s) AS o FROM (SELECT *, lag(end_s) OVER (PARTITION BY file_id ORDER BY seg_idx) AS before FROM seg) GROUP BY file_id)
SELECT file_id, CASE WHEN h > 0 THEN h END AS host, CASE WHEN h > 0 THEN g END AS guest, CASE WHEN h > 0 THEN o END AS overlaps, CASE WHEN h = 0 THEN 'no host of ' || n END AS error FROM x""")
def part_analysis(spark: SparkSession, d: str) -> DataFrame:
    """Counts of each part; a part that cannot be analysed is a row with its error."""
    s = segments(spark, d).withColumns({"role": role(), "before": F.lag("end_s").over(W.partitionBy("file_id").orderBy("seg_idx"))})
    x = s.groupBy("file_id").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "host").alias("h"), F.count_if(F.col("role") == "guest").alias("g"), F.count_if(F.col("before") > F.col("start_s")).alias("o"))
    there = F.col("h") > 0
    return x.select("file_id", F.when(there, F.col("h")).alias("host"), F.when(there, F.col("g")).alias("guest"), F.when(there, F.col("o")).alias("overlaps"), F.when(~there, F.concat(F.lit("no host of "), F.col("n"))).alias("error"))


@query(f"""{SEGMENTS_SQL} SELECT file_id, speaker, count(*) AS n, sum(end_s - start_s) AS seconds, arg_min(start_s, seg_idx) AS first_start, arg_max(end_s, seg_idx) AS last_end FROM seg GROUP BY 1, 2""")
def speaker_profile(spark: SparkSession, d: str) -> DataFrame:
    """Counts and times of each speaker; first and last are by row, not by time."""
    return segments(spark, d).groupBy("file_id", "speaker").agg(F.count("*").alias("n"), F.sum(F.col("end_s") - F.col("start_s")).alias("seconds"), F.min_by("start_s", "seg_idx").alias("first_start"), F.max_by("end_s", "seg_idx").alias("last_end"))


@query(f"""{SEGMENTS_SQL}, p AS (SELECT file_id, w_start AS part, count(*) AS n FROM seg JOIN win USING (file_id) WHERE start_s >= w_start AND start_s < w_end AND w_start % 90 <> 60 GROUP BY 1, 2)
SELECT file_id, part, n, CAST(sum(n) OVER (PARTITION BY file_id) AS BIGINT) AS split_rows, (SELECT count(*) FROM seg s WHERE s.file_id = p.file_id) AS source_rows FROM p""")
def split_summary(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each part, and of all parts against the source, which shows what no part covers."""
    s = segments(spark, d).withColumn("part", (F.floor(F.col("start_s") / 30) * 30).cast("long"))
    source = s.groupBy("file_id").agg(F.count("*").alias("source_rows"))
    p = s.filter("part % 90 <> 60").groupBy("file_id", "part").agg(F.count("*").alias("n"))
    return p.withColumn("split_rows", F.sum("n").over(W.partitionBy("file_id"))).join(source, "file_id")


@query(f"""{SEGMENTS_SQL}, i AS (SELECT file_id, seg_idx, code FROM seg, (VALUES ('empty'), ('reversed'), ('unknown')) c(code) WHERE (code = 'empty' AND end_s = start_s) OR (code = 'reversed' AND end_s < start_s + 2) OR (code = 'unknown' AND speaker = 'UNKNOWN')),
k AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY seg_idx, code) AS r, dense_rank() OVER (ORDER BY file_id) AS f FROM i)
SELECT file_id, string_agg(seg_idx || ':' || code, ' ' ORDER BY r) AS issues FROM k WHERE r <= 5 AND f <= 50 GROUP BY file_id""")
def failing_records(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 failing files with their first five issues."""
    zero = F.col("end_s") == F.col("start_s")
    codes = F.array_compact(F.array(F.when(zero, "empty"), F.when(F.col("end_s") < F.col("start_s") + 2, "reversed"), F.when(F.col("speaker") == UNKNOWN, "unknown")))
    i = segments(spark, d).select("file_id", "seg_idx", F.explode(codes).alias("code"))
    first = i.groupBy("file_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("seg_idx", "code"))), 1, 5).alias("s")).orderBy("file_id").limit(50)
    return first.select("file_id", F.array_join(F.transform("s", lambda x: F.concat(x["seg_idx"], F.lit(":"), x["code"])), " ").alias("issues"))


@query("""SELECT coalesce(lang, '*') AS lang, coalesce(source, '*') AS source, coalesce(reason, '*') AS reason, count(*) AS n FROM (SELECT lang, source, CASE WHEN n_chars < 300 THEN 'short' ELSE 'good' END AS reason FROM documents) GROUP BY GROUPING SETS ((lang), (source), (reason), (lang, reason))""")
def build_summary(spark: SparkSession, d: str) -> DataFrame:
    """Conversations by year, by topic, by reason, and by year and reason, in one pass."""
    x = table(spark, d, "documents").select("lang", "source", F.when(F.col("n_chars") < 300, "short").otherwise("good").alias("reason"))
    sets = x.groupingSets([["lang"], ["source"], ["reason"], ["lang", "reason"]], "lang", "source", "reason").agg(F.count("*").alias("n"))
    return sets.select(*[F.coalesce(c, F.lit("*")).alias(c) for c in ("lang", "source", "reason")], "n")


@query("""WITH g AS (SELECT 'type' AS grouping, event_type AS key, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2
UNION ALL SELECT 'quality', CAST(quality AS VARCHAR), count(*) FROM labels GROUP BY 2 UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), count(*) FROM labels GROUP BY 2 UNION ALL SELECT 'role', role, count(*) FROM conversations GROUP BY 2
UNION ALL SELECT 'label', CAST(label AS VARCHAR), count(*) FROM embeddings GROUP BY 2 UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'day', strftime(ts, '%Y-%m-%d'), count(*) FROM events WHERE ts::DATE > (SELECT max(ts)::DATE FROM events) - 7 GROUP BY 2
UNION ALL SELECT 'total', 'events', count(*) FROM events UNION ALL SELECT 'total', 'documents', count(*) FROM documents UNION ALL SELECT 'total', 'ready', count(*) FILTER (WHERE quality = 1 AND toxic = 0) FROM labels) SELECT * FROM g""")
def dashboard_groups(spark: SparkSession, d: str) -> DataFrame:
    """All counts by state of a dashboard, the last seven days, and totals: a row for each grouping and key."""
    def by(name: str, t: str, column: str) -> DataFrame:
        return table(spark, d, t).groupBy(F.col(column).cast("string").alias("key")).agg(F.count("*").alias("n")).select(F.lit(name).alias("grouping"), "key", "n")

    out = by("type", "events", "event_type")
    for name, t, c in (("lang", "documents", "lang"), ("source", "documents", "source"), ("quality", "labels", "quality"), ("toxic", "labels", "toxic"), ("role", "conversations", "role"), ("label", "embeddings", "label"), ("status", "orders", "o_orderstatus")):
        out = out.unionByName(by(name, t, c))
    e = table(spark, d, "events")
    last = e.agg(F.to_date(F.max("ts"))).scalar()
    days = e.filter(F.to_date("ts") > F.date_sub(last, 7)).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("key")).agg(F.count("*").alias("n"))
    total = lambda name, rows, n: rows.agg(n.alias("n")).select(F.lit("total").alias("grouping"), F.lit(name).alias("key"), "n")
    ready = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return out.unionByName(days.select(F.lit("day").alias("grouping"), "key", "n")).unionByName(total("events", e, F.count("*"))).unionByName(
        total("documents", table(spark, d, "documents"), F.count("*"))).unionByName(total("ready", table(spark, d, "labels"), F.count_if(ready)))


@query("""(SELECT 'runs' AS list, event_id AS id FROM events WHERE event_type = 'view' ORDER BY ts DESC, event_id DESC LIMIT 12) UNION ALL (SELECT 'cases', event_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 8)
UNION ALL (SELECT 'exports', event_id FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 8)""")
def recent_lists(spark: SparkSession, d: str) -> DataFrame:
    """The newest rows of several lists, each by a bounded top-k."""
    e = table(spark, d, "events")
    newest = lambda name, kind, n: e.filter(F.col("event_type") == kind).orderBy(F.desc("ts"), F.desc("event_id")).limit(n).select(F.lit(name).alias("list"), F.col("event_id").alias("id"))
    return newest("runs", "view", 12).unionByName(newest("cases", "error", 8)).unionByName(newest("exports", "purchase", 8))


@query(f"""{SEGMENTS_SQL} SELECT file_id, seg_idx, row_number() OVER (PARTITION BY file_id ORDER BY start_s, end_s, lower(speaker), seg_idx) AS place FROM seg""")
def sorted_parts(spark: SparkSession, d: str) -> DataFrame:
    """Order by start, end and title, titles by the collation of their language."""
    w = W.partitionBy("file_id").orderBy("start_s", "end_s", F.collate(F.col("speaker"), "zh"), "seg_idx")
    return segments(spark, d).select("file_id", "seg_idx", F.row_number().over(w).alias("place"))


@query(f"""{SEGMENTS_SQL}, s AS (SELECT file_id, list_sort(list_distinct(list(speaker))) AS all_, list_sort(list_distinct(list(speaker) FILTER (WHERE seg_idx % 3 = 0))) AS hosts, bool_or(end_s = start_s AND seg_idx % 2 = 0) AS empty FROM seg GROUP BY file_id)
SELECT file_id, list_filter(all_, lambda x: NOT list_contains(coalesce(hosts, []), x)) AS guests, empty OR len(all_) < 5 AS repair FROM s""")
def guest_difference(spark: SparkSession, d: str) -> DataFrame:
    """Guests are speakers who are no hosts; a repair is due when any issue is among its triggers."""
    s = segments(spark, d).groupBy("file_id").agg(F.collect_set("speaker").alias("every"), F.collect_set(F.when(F.col("seg_idx") % 3 == 0, F.col("speaker"))).alias("hosts"), F.bool_or((F.col("end_s") == F.col("start_s")) & (F.col("seg_idx") % 2 == 0)).alias("empty"))
    codes = F.array_compact(F.array(F.when(F.col("empty"), "empty_sentence"), F.when(F.size("every") < 5, "missing_speaker"), F.lit("note")))
    return s.select("file_id", F.sort_array(F.array_except("every", "hosts")).alias("guests"), F.arrays_overlap(codes, F.array(F.lit("empty_sentence"), F.lit("missing_speaker"))).alias("repair"))
