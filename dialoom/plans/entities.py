"""Tags and identities, recall, fallbacks between sources, and reshaping of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import tags
from dialoom.operators import intervals, links
from dialoom.plans.base import query
from dialoom.sources.tables import SEGMENTS_SQL, segments, table

SAID_SQL = """WITH said AS (SELECT event_id, user_id, '我今年' || (event_id % 90 + 10) || '岁，' || CASE event_id % 4 WHEN 0 THEN '博士' WHEN 1 THEN '硕士毕业' WHEN 2 THEN '本科' ELSE '女生' END || CASE event_id % 5 WHEN 0 THEN '，程序员' WHEN 1 THEN '，做销售和运营' WHEN 2 THEN '，高校' WHEN 3 THEN '' ELSE '，离婚' END
 || CASE event_id % 3 WHEN 0 THEN '，在上海，年薪' || (event_id % 50) || '万' WHEN 1 THEN '，在深圳' ELSE '' END AS t FROM events)
"""


def _said(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")

    def pick(n: int, *values: str) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (e % n + 1).cast("int"))

    pay = F.when(e % 3 == 0, F.concat(F.lit("，在上海，年薪"), e % 50, F.lit("万"))).when(e % 3 == 1, F.lit("，在深圳")).otherwise(F.lit(""))
    t = F.concat(F.lit("我今年"), e % 90 + 10, F.lit("岁，"), pick(4, "博士", "硕士毕业", "本科", "女生"), pick(5, "，程序员", "，做销售和运营", "，高校", "", "，离婚"), pay)
    return table(spark, d, "events").select("event_id", "user_id", t.alias("t"))


@query(SAID_SQL + """SELECT event_id, array_to_string(list_filter([(event_id % 90 + 10) || '岁', CASE WHEN contains(t, '博士') THEN '博士' WHEN contains(t, '硕士') THEN '硕士' WHEN contains(t, '本科') THEN '本科' END,
CASE WHEN contains(t, '程序员') THEN '程序员' WHEN contains(t, '高校') THEN '高校老师' WHEN contains(t, '运营') THEN '运营' END], lambda x: x IS NOT NULL), '_') AS tag FROM said""")
def guest_tags(spark: SparkSession, d: str) -> DataFrame:
    return _said(spark, d).select("event_id", tags.guest_tag(F.col("t")).alias("tag"))


@query(SAID_SQL + """SELECT event_id, CASE WHEN event_id % 90 + 10 BETWEEN 18 AND 70 THEN CAST(event_id % 90 + 10 AS INTEGER) END AS age, CASE event_id % 4 WHEN 0 THEN '博士' WHEN 1 THEN '硕士' WHEN 2 THEN '本科' ELSE CASE WHEN event_id % 5 = 4 THEN '离异' END END AS identity,
CASE event_id % 3 WHEN 0 THEN '上海' WHEN 1 THEN '深圳' END AS city, CASE event_id % 3 WHEN 0 THEN CAST(event_id % 50 AS INTEGER) END AS income FROM said""")
def guest_facts(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("t")
    return _said(spark, d).select("event_id", tags.age(t).alias("age"), tags.identity(t).alias("identity"), tags.city(t).alias("city"), tags.income(t).alias("income"))


@query(SAID_SQL + "SELECT event_id, CASE event_id % 5 WHEN 0 THEN ['程序员'] WHEN 1 THEN ['运营', '销售'] WHEN 2 THEN ['高校老师'] ELSE CAST([] AS VARCHAR[]) END AS labels FROM said")
def multi_labels(spark: SparkSession, d: str) -> DataFrame:
    return _said(spark, d).select("event_id", tags.labels(F.col("t")).alias("labels"))


@query(SAID_SQL + """, k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM said), j AS (SELECT user_id, string_agg(t, ' ' ORDER BY event_id) AS t FROM k WHERE r <= 20 GROUP BY user_id)
SELECT user_id, regexp_extract(t, '([0-9]{2})岁', 1) || '岁_' || CASE WHEN contains(t, '博士') THEN '博士' WHEN contains(t, '硕士') THEN '硕士' ELSE '本科' END AS head FROM j WHERE contains(t, '博士') OR contains(t, '硕士') OR contains(t, '本科')""")
def intro_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags from the first twenty segments of each file; that bound is the rule."""
    k = _said(spark, d).withColumn("r", F.row_number().over(W.partitionBy("user_id").orderBy("event_id"))).filter("r <= 20")
    rows = F.sort_array(F.collect_list(F.struct("event_id", "t")))
    j = k.groupBy("user_id").agg(F.array_join(F.transform(rows, lambda r: r["t"]), " ").alias("t"))
    parts = F.split(tags.guest_tag(F.col("t")), "_")
    return j.filter(tags.any_of(F.col("t"), ["博士", "硕士", "本科"])).select("user_id", F.concat(F.get(parts, F.lit(0)), F.lit("_"), F.get(parts, F.lit(1))).alias("head"))


@query("""WITH w AS (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last, list_distinct(list_concat(regexp_extract_all(lower(text), '[a-z0-9]{2,}'), regexp_extract_all(lower(text), '[一-鿿]'))) AS t FROM (SELECT conv_id, turn, substr(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')), 1, 400) AS text FROM conversations)),
q AS (SELECT conv_id, t AS asked FROM w WHERE turn = last), m AS (SELECT conv_id, turn, list_intersect(t, asked) AS shared, greatest(0.0, 1 - (last - turn) / 14) AS recency FROM w JOIN q USING (conv_id) WHERE turn < last),
s AS (SELECT conv_id, turn, 2 * len(shared) + 3 * len(list_filter(shared, lambda x: regexp_matches(x, '^[0-9]+$'))) + recency AS score FROM m)
SELECT conv_id, turn, score FROM s QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn DESC) <= 3""")
def recall_by_last_turn(spark: SparkSession, d: str) -> DataFrame:
    """Three memories of each session by relevance to its last turn: shared words, shared numbers, and recency, a turn counting as a day."""
    from dialoom.functions.scalars import memory_tokens, relevance

    w = table(spark, d, "conversations").select("conv_id", "turn", memory_tokens(F.coalesce("text", F.lit(""))).alias("t"))
    q = w.groupBy("conv_id").agg(F.max("turn").alias("last"), F.max_by("t", "turn").alias("asked"))
    m = w.join(q, "conv_id").filter("turn < last").select("conv_id", "turn", relevance(F.col("asked"), F.col("t"), F.col("last") - F.col("turn")).alias("score"))
    return intervals_top(m, ["conv_id"], [F.desc("score"), F.desc("turn")], 3)


@query("""WITH m AS (SELECT conv_id, turn, 14.0 - least(14, 20 - turn % 20) AS recency, len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{2,}'))) AS n, regexp_matches(text, '[0-9]') AS num FROM conversations)
SELECT conv_id, turn, 2 * n + CASE WHEN num THEN 3 ELSE 0 END + greatest(0.0, recency / 14) AS score FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY 2 * n + CASE WHEN num THEN 3 ELSE 0 END + greatest(0.0, recency / 14) DESC, turn DESC) AS r FROM m) WHERE r <= 3""")
def memory_recall(spark: SparkSession, d: str) -> DataFrame:
    """Three memories of each session by relevance: words, numbers and fourteen days of recency as of a given day."""
    from dialoom.functions.scalars import tokens

    age = 20 - F.col("turn") % 20
    score = 2 * F.size(tokens(F.col("text"))) + F.when(F.col("text").rlike("[0-9]"), 3).otherwise(0) + F.greatest(F.lit(0.0), (14.0 - F.least(F.lit(14), age)) / 14)
    m = table(spark, d, "conversations").select("conv_id", "turn", score.alias("score"))
    return intervals_top(m, ["conv_id"], [F.desc("score"), F.desc("turn")], 3)


def intervals_top(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("__r") <= k).drop("__r")


@query("""SELECT d.doc_id, coalesce(l.doc_id, b.item_id, n.n_nationkey, -1) AS source_id, CASE WHEN l.doc_id IS NOT NULL THEN 'exact' WHEN b.item_id IS NOT NULL THEN 'basename' WHEN n.n_nationkey IS NOT NULL THEN 'date' ELSE 'none' END AS via
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id LEFT JOIN benchmark b ON b.item_id = d.doc_id % 100 LEFT JOIN nation n ON n.n_nationkey = d.doc_id % 50""")
def fallback_chain(spark: SparkSession, d: str) -> DataFrame:
    """The first source that has a match: exact, by base name, by date, or none."""
    docs = table(spark, d, "documents").select("doc_id")
    labels = table(spark, d, "labels").select("doc_id", F.col("doc_id").alias("l")).distinct()
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("b"))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("n"))
    x = docs.join(labels, "doc_id", "left").join(items, F.col("b") == F.col("doc_id") % 100, "left").join(nations, F.col("n") == F.col("doc_id") % 50, "left")
    via = F.when(F.col("l").isNotNull(), "exact").when(F.col("b").isNotNull(), "basename").when(F.col("n").isNotNull(), "date").otherwise("none")
    return x.select("doc_id", F.coalesce("l", "b", "n", F.lit(-1)).alias("source_id"), via.alias("via"))


PARTS_SQL = """WITH parts AS (SELECT doc_id AS part_id, CAST(2022 + doc_id % 3 AS VARCHAR) AS year, 'x/d' || (doc_id % 700) || CASE WHEN doc_id % 2 = 0 THEN '_processed' ELSE '' END AS folder,
 CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'd' || (doc_id * 7 % 900) || '.json' END AS source_file, CASE WHEN doc_id % 11 > 0 THEN '2024-01-' || lpad(CAST(doc_id % 31 AS VARCHAR), 2, '0') END AS day FROM documents),
audio AS (SELECT DISTINCT 'raw/' || y || '/d' || n || '.mp3' AS path, y, 'd' || n AS stem, CASE WHEN n % 5 > 0 THEN '2024-01-' || lpad(CAST(n % 29 AS VARCHAR), 2, '0') END AS day
 FROM (SELECT CAST(2023 + user_id % 2 AS VARCHAR) AS y, user_id * 3 % 500 AS n FROM events)),
p AS (SELECT *, regexp_replace(source_file, '\\.json$', '') AS f, regexp_replace(split_part(folder, '/', 2), '_processed$', '') AS g FROM parts)
"""


@query(PARTS_SQL + """, r AS (SELECT part_id, (SELECT min(path) FROM audio a WHERE p.f <> '' AND a.y = p.year AND a.stem = p.f) AS l1, (SELECT min(path) FROM audio a WHERE p.f <> '' AND a.stem = p.f) AS l2,
 (SELECT min(path) FROM audio a WHERE a.y = p.year AND a.stem = p.g) AS l3, (SELECT min(path) FROM audio a WHERE a.stem = p.g) AS l4, (SELECT min(path) FROM audio a WHERE a.day = p.day AND a.y = p.year) AS l5, (SELECT min(path) FROM audio a WHERE a.day = p.day) AS l6 FROM p)
SELECT part_id, coalesce(l1, l2, l3, l4, l5, l6) AS path, CASE WHEN l1 IS NOT NULL THEN 'year and file' WHEN l2 IS NOT NULL THEN 'file' WHEN l3 IS NOT NULL THEN 'year and folder' WHEN l4 IS NOT NULL THEN 'folder' WHEN l5 IS NOT NULL THEN 'day and year' WHEN l6 IS NOT NULL THEN 'day' END AS via FROM r""")
def source_audio_chain(spark: SparkSession, d: str) -> DataFrame:
    """The recording of each part by the first of six links that has one."""
    i = F.col("doc_id")
    day = lambda n: F.concat(F.lit("2024-01-"), F.lpad(n.cast("string"), 2, "0"))
    parts = table(spark, d, "documents").select(
        i.alias("part_id"), (2022 + i % 3).cast("string").alias("year"), F.concat(F.lit("x/d"), i % 700, F.when(i % 2 == 0, "_processed").otherwise("")).alias("folder"),
        F.when(i % 3 == 1, "").when(i % 3 == 2, F.concat(F.lit("d"), i * 7 % 900, F.lit(".json"))).alias("source_file"), F.when(i % 11 > 0, day(i % 31)).alias("day"))
    n = F.col("n")
    audio = table(spark, d, "events").select((2023 + F.col("user_id") % 2).alias("y"), (F.col("user_id") * 3 % 500).alias("n")).distinct()
    audio = audio.select(F.concat(F.lit("raw/"), "y", F.lit("/d"), "n", F.lit(".mp3")).alias("path"), F.when(n % 5 > 0, day(n % 29)).alias("day"))
    return links.source_audio(parts, audio)


@query(f"""{SEGMENTS_SQL}, s AS (SELECT file_id, w_start, lag(w_end) OVER w AS prev_end, lead(w_start) OVER w AS next_start FROM win WINDOW w AS (PARTITION BY file_id ORDER BY w_start)) SELECT file_id, w_start, w_start - prev_end AS gap_before, next_start - w_start - 30 AS gap_after FROM s""")
def adjacent_sections(spark: SparkSession, d: str) -> DataFrame:
    from dialoom.sources.tables import windows

    w = W.partitionBy("file_id").orderBy("w_start")
    return windows(spark, d).select("file_id", "w_start", (F.col("w_start") - F.lag("w_end").over(w)).alias("gap_before"), (F.lead("w_start").over(w) - F.col("w_end")).alias("gap_after"))


@query(f"""{SEGMENTS_SQL}, p AS (SELECT s.file_id, s.seg_idx, w.w_start, s.start_s >= w.w_start AND s.end_s <= w.w_end AS inside, row_number() OVER (PARTITION BY s.file_id, s.seg_idx ORDER BY (s.start_s >= w.w_start AND s.end_s <= w.w_end) DESC, w.w_start) AS r, greatest(s.start_s, w.w_start) AS a, least(s.end_s, w.w_end) AS b FROM seg s JOIN win w ON s.file_id = w.file_id AND s.end_s >= w.w_start AND w.w_end >= s.start_s)
SELECT file_id, seg_idx, w_start, inside, a - w_start AS rel_start, b - w_start AS rel_end FROM p WHERE r = 1""")
def interval_to_part(spark: SparkSession, d: str) -> DataFrame:
    """The part that holds an interval, else the first that it overlaps, with the interval clipped to it."""
    from dialoom.sources.tables import windows

    p = intervals.overlap_join(segments(spark, d), windows(spark, d), "file_id", ("start_s", "end_s"), ("w_start", "w_end"))
    p = p.withColumn("inside", (F.col("start_s") >= F.col("w_start")) & (F.col("end_s") <= F.col("w_end")))
    best = intervals.first_by(p, ["file_id", "seg_idx"], F.desc("inside"), F.asc("w_start"))
    return best.select("file_id", "seg_idx", "w_start", "inside", (F.greatest("start_s", "w_start") - F.col("w_start")).alias("rel_start"), (F.least("end_s", "w_end") - F.col("w_start")).alias("rel_end"))


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN 'meta' || event_id END, nullif(CASE WHEN event_id % 3 = 1 THEN '' ELSE 'flat' || event_id END, ''), '观众') AS tag, CASE event_id % 4 WHEN 0 THEN 'host' WHEN 1 THEN 'host' ELSE 'guest' END AS role FROM events""")
def unified_records(spark: SparkSession, d: str) -> DataFrame:
    """Two shapes of one record: nested fields first, then flat ones that are not empty, then a default; and roles by any spelling."""
    e = F.col("event_id")
    meta = F.when(e % 3 == 0, F.concat(F.lit("meta"), e))
    flat = F.when(e % 3 == 1, F.lit("")).otherwise(F.concat(F.lit("flat"), e))
    spelled = F.element_at(F.array(*[F.lit(x) for x in ("host", "system", "other", "speaker_3")]), (e % 4 + 1).cast("int"))
    role = F.when(spelled.isin("host", "system"), "host").otherwise("guest")
    return table(spark, d, "events").select("event_id", F.coalesce(meta, F.nullif(flat, F.lit("")), F.lit("观众")).alias("tag"), role.alias("role"))


@query(f"""{SEGMENTS_SQL}, r AS (SELECT file_id, sum(CASE WHEN speaker = 'SPEAKER_00' THEN end_s - start_s END) AS h, sum(CASE WHEN speaker NOT IN ('SPEAKER_00', 'UNKNOWN') THEN end_s - start_s END) AS g FROM seg GROUP BY 1)
SELECT file_id, coalesce(h, 0) AS host_s, coalesce(g, 0) AS guest_s, CASE WHEN h + g > 0 THEN g / (h + g) END >= 0.12 AND g >= 1 AS guest_kept FROM r""")
def minor_speakers(spark: SparkSession, d: str) -> DataFrame:
    """Speakers under 12 % or a second are suppressed when a section is rebuilt."""
    s, t = F.col("speaker"), F.col("end_s") - F.col("start_s")
    r = segments(spark, d).groupBy("file_id").agg(F.sum(F.when(s == "SPEAKER_00", t)).alias("h"), F.sum(F.when(~s.isin("SPEAKER_00", "UNKNOWN"), t)).alias("g"))
    share = F.when(F.col("h") + F.col("g") > 0, F.col("g") / (F.col("h") + F.col("g")))
    return r.select("file_id", F.coalesce("h", F.lit(0.0)).alias("host_s"), F.coalesce("g", F.lit(0.0)).alias("guest_s"), ((share >= 0.12) & (F.col("g") >= 1)).alias("guest_kept"))


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'failed' WHEN event_id % 5 = 0 THEN 'success' WHEN event_id % 3 = 0 THEN 'running' ELSE 'unknown' END AS status, CASE WHEN event_id % 7 = 0 THEN 3 WHEN event_id % 5 = 0 THEN 0 END AS exit_code FROM events""")
def run_status_probe(spark: SparkSession, d: str) -> DataFrame:
    """A run's state from the last exit code in its log, else from whether its session lives."""
    e = F.col("event_id")
    log = F.when(e % 7 == 0, "EXIT_CODE=0\nx\nEXIT_CODE=3\n").when(e % 5 == 0, "EXIT_CODE=0").otherwise("working")
    code = F.try_element_at(F.regexp_extract_all(log, F.lit(r"EXIT_CODE=(\d+)"), F.lit(1)), F.lit(-1)).try_cast("int")
    return table(spark, d, "events").select("event_id", F.when(code == 0, "success").when(code.isNotNull(), "failed").when(e % 3 == 0, "running").otherwise("unknown").alias("status"), code.alias("exit_code"))


@query("""SELECT conv_id, 'Facts: ' || string_agg(substr(text, 1, 20), '; ' ORDER BY turn) FILTER (WHERE turn < 3) AS summary, count(*) AS turns FROM conversations GROUP BY conv_id""")
def memory_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.when(F.col("turn") < 3, F.struct("turn", F.substring("text", 1, 20).alias("t")))))
    c = table(spark, d, "conversations").groupBy("conv_id").agg(rows.alias("r"), F.count("*").alias("turns"))
    return c.select("conv_id", F.concat(F.lit("Facts: "), F.array_join(F.transform("r", lambda r: r["t"]), "; ")).alias("summary"), "turns")


@query("""SELECT doc_id, sha256('{"lang":"' || lang || '","source":"' || source || '"}') AS signature FROM documents""")
def runtime_signature(spark: SparkSession, d: str) -> DataFrame:
    """A digest of a record's JSON with sorted keys."""
    return table(spark, d, "documents").select("doc_id", F.sha2(F.to_json(F.struct("lang", "source")), 256).alias("signature"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id * 10 END AS range_start, CASE WHEN event_id % 3 = 0 THEN event_id * 10 + 99 WHEN event_id % 3 = 1 THEN event_id END AS range_end FROM events""")
def byte_ranges(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    header = F.when(e % 3 == 0, F.concat(F.lit("bytes="), e * 10, F.lit("-"), e * 10 + 99)).when(e % 3 == 1, F.concat(F.lit("bytes=-"), e)).otherwise("none")
    g = lambda k: F.regexp_extract(header, r"^bytes=(\d*)-(\d*)$", k).try_cast("long")
    return table(spark, d, "events").select("event_id", g(1).alias("range_start"), g(2).alias("range_end"))


@query("""SELECT doc_id, ((18080 + CAST(list_sum(list_transform(string_split(source, ''), lambda c: ascii(c))) AS BIGINT) % 1000)) AS port, CASE WHEN doc_id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END AS n FROM documents""")
def prompt_normalise(spark: SparkSession, d: str) -> DataFrame:
    """A service's port from its name; messages with a system message put before them where there is none."""
    from dialoom.functions.scalars import code_point_sum

    given = F.when(F.col("doc_id") % 2 == 0, F.array(F.struct(F.lit("user").alias("role"), F.col("lang").alias("content")))).otherwise(F.array(F.struct(F.lit("answer").alias("role"), F.col("lang").alias("content"))))
    mapped = F.transform(given, lambda m: F.struct(F.when(m["role"] == "answer", "assistant").otherwise(m["role"]).alias("role"), m["content"].alias("content")))
    system = F.array(F.struct(F.lit("system").alias("role"), F.lit("s").alias("content")))
    full = F.when(F.exists(mapped, lambda m: m["role"] == "user"), F.concat(system, mapped)).otherwise(mapped)
    return table(spark, d, "documents").select("doc_id", (18080 + code_point_sum(F.col("source")) % 1000).cast("long").alias("port"), F.element_at(full, -1)["role"].alias("role"), F.size(full).alias("n"))
