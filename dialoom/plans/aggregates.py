"""Hosts, durations, summaries, top-k and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import scalars, tags
from dialoom.operators.intervals import first_by
from dialoom.plans.base import query
from dialoom.sources.tables import HOST, SEGMENTS_SQL, UNKNOWN, segments, table

DUR = "greatest(0.0, end_s - start_s)"


def _duration():
    return F.greatest(F.lit(0.0), F.col("end_s") - F.col("start_s"))


@query(f"{SEGMENTS_SQL} SELECT file_id, speaker, sum({DUR}) AS seconds, count(*) AS n, min(start_s) AS first_start, arg_max(end_s, seg_idx) AS last_end FROM seg WHERE speaker <> 'UNKNOWN' GROUP BY 1, 2")
def speaker_durations(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).filter(F.col("speaker") != UNKNOWN).groupBy("file_id", "speaker").agg(F.sum(_duration()).alias("seconds"), F.count("*").alias("n"), F.min("start_s").alias("first_start"), F.max_by("end_s", "seg_idx").alias("last_end"))


def host_of(said: DataFrame, score: Column, files: DataFrame | None = None) -> DataFrame:
    """The speaker of each file with the highest score, of equals the first seen; ``files`` adds those without segments, by the default host."""
    s = said.groupBy("file_id", "speaker").agg(score.alias("score"), F.min("seg_idx").alias("f"))
    best = first_by(s, ["file_id"], F.desc("score"), F.asc("f")).select("file_id", F.col("speaker").alias("host"), "score")
    if files is None:
        return best
    return files.select("file_id").distinct().join(best, "file_id", "left").select("file_id", F.coalesce("host", F.lit(HOST)).alias("host"), "score")


def _pick(spark: SparkSession, d: str, score: Column) -> DataFrame:
    return host_of(segments(spark, d), score)


def _pick_sql(score: str) -> str:
    return f"""{SEGMENTS_SQL}, s AS (SELECT file_id, speaker, {score} AS score, min(seg_idx) AS f FROM seg GROUP BY 1, 2)
SELECT file_id, speaker AS host, score FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY score DESC, f) AS r FROM s) WHERE r = 1"""


@query(_pick_sql("count(*)"))
def host_by_count(spark: SparkSession, d: str) -> DataFrame:
    return _pick(spark, d, F.count("*"))


@query(_pick_sql("sum(CASE WHEN contains(text, '\"1') THEN 100 ELSE 0 END) + count(*) + sum(end_s - start_s) / 10"))
def host_by_score(spark: SparkSession, d: str) -> DataFrame:
    """A hundred for each marker, one for each segment, a tenth for each second."""
    return _pick(spark, d, F.sum(F.when(F.col("text").contains('"1'), 100).otherwise(0)) + F.count("*") + F.sum(F.col("end_s") - F.col("start_s")) / 10)


_GREETED = "CASE seg_idx % 4 WHEN 0 THEN '哈喽你好，' WHEN 1 THEN '来下一个下一位' WHEN 2 THEN '谢谢谢谢' ELSE '' END || CASE event_id % 3 WHEN 0 THEN '拜拜' WHEN 1 THEN '欢迎' ELSE text END"
_COUNTED = " + ".join(f"(length(g) - length(replace(g, '{p}', ''))) // {len(p)}" for p in tags.HOST_PHRASES)


@query(f"""{SEGMENTS_SQL}, g AS (SELECT *, {_GREETED} AS g FROM seg), s AS (SELECT file_id, speaker, CAST(sum({_COUNTED}) AS BIGINT) AS score, min(seg_idx) AS f FROM g GROUP BY 1, 2)
SELECT file_id, speaker AS host, score FROM s QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY score DESC, f) = 1""")
def host_by_greetings(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences of seven phrases, not overlapping; of equals, or with none, the first seen, speakers without a name included."""
    k = F.col("seg_idx") % 4
    head = F.when(k == 0, "哈喽你好，").when(k == 1, "来下一个下一位").when(k == 2, "谢谢谢谢").otherwise("")
    e = F.col("event_id") % 3
    said = segments(spark, d).withColumn("text", F.concat(head, F.when(e == 0, "拜拜").when(e == 1, "欢迎").otherwise(F.col("text"))))
    return host_of(said, F.sum(scalars.occurrences(F.col("text"), tags.HOST_PHRASES)))


@query(_pick_sql("CAST(sum(CASE WHEN seg_idx < 1000 AND contains(text, '7') THEN 10 ELSE 0 END) + count(*) FILTER (WHERE seg_idx < 1000) AS BIGINT)"))
def host_by_early_score(spark: SparkSession, d: str) -> DataFrame:
    """Ten for each marker and one for each segment among the first thousand; that bound is the rule."""
    early = F.col("seg_idx") < 1000
    return _pick(spark, d, F.sum(F.when(early & F.col("text").contains("7"), 10).otherwise(0)) + F.count_if(early))


@query(f"""{SEGMENTS_SQL}, s AS (SELECT file_id, speaker, sum(greatest(end_s - start_s, length(text) / 10.0)) AS t FROM seg GROUP BY 1, 2)
SELECT file_id, speaker, t >= 0.15 * max(t) OVER (PARTITION BY file_id) AS is_host FROM s""")
def host_labels(spark: SparkSession, d: str) -> DataFrame:
    """Speakers with 15 % of the most speech, a character counting a tenth of a second at least."""
    s = segments(spark, d).groupBy("file_id", "speaker").agg(F.sum(F.greatest(F.col("end_s") - F.col("start_s"), F.length("text") / 10)).alias("t"))
    return s.select("file_id", "speaker", (F.col("t") >= 0.15 * F.max("t").over(W.partitionBy("file_id"))).alias("is_host"))


@query(f"""{SEGMENTS_SQL}, s AS (SELECT file_id, speaker, sum({DUR}) AS t FROM seg GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY t DESC, speaker) AS k FROM s)
SELECT file_id, speaker, CASE k WHEN 1 THEN 'host' WHEN 2 THEN 'guest' ELSE 'other_' || k END AS name FROM r""")
def names_by_duration(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).groupBy("file_id", "speaker").agg(F.sum(_duration()).alias("t"))
    k = F.row_number().over(W.partitionBy("file_id").orderBy(F.desc("t"), "speaker"))
    return s.withColumn("k", k).select("file_id", "speaker", F.when(F.col("k") == 1, "host").when(F.col("k") == 2, "guest").otherwise(F.concat(F.lit("other_"), "k")).alias("name"))


@query(f"""{SEGMENTS_SQL} SELECT file_id, string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS speakers, count(*) AS n, sum(end_s - start_s) AS seconds, count(*) FILTER (WHERE trim(text) = '') AS blank FROM seg GROUP BY 1""")
def merged_files(spark: SparkSession, d: str) -> DataFrame:
    """One row per file: its speakers in order, segments, seconds and blanks."""
    return segments(spark, d).groupBy("file_id").agg(F.array_join(F.sort_array(F.collect_set("speaker")), ",").alias("speakers"), F.count("*").alias("n"), F.sum(F.col("end_s") - F.col("start_s")).alias("seconds"), F.count_if(F.trim("text") == "").alias("blank"))


@query(f"""{SEGMENTS_SQL}, s AS (SELECT file_id, speaker, count(*) AS n, avg(end_s - start_s) AS a, avg(length(text)) AS l FROM seg GROUP BY 1, 2)
SELECT file_id, speaker, n, floor(a * 1e6 + 0.5) / 1e6 AS avg_s, floor(l * 1e6 + 0.5) / 1e6 AS avg_len, CASE WHEN n * 1.0 / sum(n) OVER (PARTITION BY file_id) BETWEEN 0.05 AND 0.8 THEN 'PASS' ELSE 'WARNING' END AS ratio_check, CASE WHEN a BETWEEN 1 AND 30 THEN 'PASS' ELSE 'WARNING' END AS length_check FROM s""")
def consistency_stats(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).groupBy("file_id", "speaker").agg(F.count("*").alias("n"), F.avg(F.col("end_s") - F.col("start_s")).alias("a"), F.avg(F.length("text")).alias("l"))
    verdict = lambda ok: F.when(ok, "PASS").otherwise("WARNING")
    r6 = lambda c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6
    share = F.col("n") / F.sum("n").over(W.partitionBy("file_id"))
    return s.select("file_id", "speaker", "n", r6("a").alias("avg_s"), r6("l").alias("avg_len"), verdict(share.between(0.05, 0.8)).alias("ratio_check"), verdict(F.col("a").between(1, 30)).alias("length_check"))


@query("SELECT source, count(*) AS cases, count(*) FILTER (WHERE trim(text) = '') AS blank, count(*) FILTER (WHERE length(trim(text)) < 30) AS short, floor(coalesce(avg(n_chars), 0) * 1e6 + 0.5) / 1e6 AS avg_chars, CAST(sum(greatest(1, (length(text) + 11) // 4)) AS BIGINT) AS tokens FROM documents GROUP BY source")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """Documents as one model's outputs: cases, blanks, shorts, averages (0 when empty)."""
    t = F.trim("text")
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("cases"), F.count_if(t == "").alias("blank"), F.count_if(F.length(t) < 30).alias("short"),
        (F.floor(F.coalesce(F.avg("n_chars"), F.lit(0.0)) * 1e6 + 0.5) / 1e6).alias("avg_chars"), F.sum(F.greatest(F.lit(1), F.floor((F.length("text") + 11) / 4))).alias("tokens"))


@query("SELECT source, lang AS slice, count(*) AS n, count(*) FILTER (WHERE length(trim(text)) < 30) AS short, grouping_id(source, lang) AS level FROM documents GROUP BY ROLLUP (source, lang)")
def run_slice_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counts by run and slice, by run, and in all: the combined and the separate reports in one pass."""
    return table(spark, d, "documents").rollup("source", "lang").agg(F.count("*").alias("n"), F.count_if(F.length(F.trim("text")) < 30).alias("short"), F.grouping_id().alias("level")).withColumnRenamed("lang", "slice")


@query("""SELECT 'event_type' AS facet, event_type AS key, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), count(*) FROM labels GROUP BY 2
UNION ALL SELECT 'last7', 'events', count(*) FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY UNION ALL SELECT 'ready', 'labels', count(*) FROM labels WHERE quality = 1 AND toxic = 0""")
def dashboard_overview(spark: SparkSession, d: str) -> DataFrame:
    """Totals by status of each table, the last seven days before the newest event, and rows ready for export."""
    e, labels = table(spark, d, "events"), table(spark, d, "labels")
    facet = lambda df, name, c: df.groupBy(F.col(c).cast("string").alias("key")).agg(F.count("*").alias("n")).select(F.lit(name).alias("facet"), "key", "n")
    newest = e.agg(F.max("ts").alias("top"))
    last7 = e.filter(F.col("ts") >= newest.scalar() - F.expr("INTERVAL 7 DAY")).agg(F.count("*").alias("n")).select(F.lit("last7").alias("facet"), F.lit("events").alias("key"), "n")
    ready = labels.filter("quality = 1 and toxic = 0").agg(F.count("*").alias("n")).select(F.lit("ready").alias("facet"), F.lit("labels").alias("key"), "n")
    return facet(e, "event_type", "event_type").unionByName(facet(table(spark, d, "documents"), "lang", "lang")).unionByName(facet(labels, "toxic", "toxic")).unionByName(last7).unionByName(ready)


@query("SELECT count(*) AS total, count(*) FILTER (WHERE quality = 1) AS correct, count(*) FILTER (WHERE quality = 1) / nullif(count(*), 0) AS agreement, count(*) FILTER (WHERE toxic = 1) AS low FROM labels")
def agreement_metrics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").agg(F.count("*").alias("total"), F.count_if(F.col("quality") == 1).alias("correct"), F.try_divide(F.count_if(F.col("quality") == 1), F.count("*")).alias("agreement"), F.count_if(F.col("toxic") == 1).alias("low"))


@query("SELECT event_type, status, coalesce(n, 0) AS n FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN (VALUES ('low'), ('mid'), ('high'), ('none')) s(status) LEFT JOIN (SELECT event_type, CASE WHEN value < 30 THEN 'low' WHEN value < 100 THEN 'mid' ELSE 'high' END AS status, count(*) AS n FROM events GROUP BY 1, 2) USING (event_type, status)")
def state_rollup_zero_filled(spark: SparkSession, d: str) -> DataFrame:
    """A count for each state of each kind, zero where there is none; one pass, then four rows for each kind."""
    status = F.when(F.col("value") < 30, "low").when(F.col("value") < 100, "mid").otherwise("high")
    c = table(spark, d, "events").withColumn("s", status).groupBy("event_type").agg(*[F.count_if(F.col("s") == k).alias(k) for k in ("low", "mid", "high", "none")])
    return c.unpivot("event_type", ["low", "mid", "high", "none"], "status", "n")


@query("SELECT lang, count(*) AS n, count(DISTINCT source) AS sources FROM documents GROUP BY 1 ORDER BY n DESC")
def counts_by_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources"))


@query("SELECT text, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    """Keys that more than one record has, here whole texts."""
    return table(spark, d, "documents").groupBy("text").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1")


@query("SELECT event_id, user_id, value FROM events WHERE (ts, event_id) < (SELECT (ts, event_id) FROM events ORDER BY ts DESC, event_id DESC LIMIT 1 OFFSET 19) ORDER BY ts DESC, event_id DESC LIMIT 21")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    """The page after a cursor in falling (time, id): a page of twenty and one more row, which tells whether there is another."""
    e = table(spark, d, "events")
    newest = [F.desc("ts"), F.desc("event_id")]
    cursor = e.orderBy(*newest).limit(20).agg(F.min(F.struct("ts", "event_id")).alias("c"))
    return e.filter(F.struct("ts", "event_id") < cursor.scalar()).orderBy(*newest).limit(21).select("event_id", "user_id", "value")


@query("SELECT user_id, event_id, CAST(r AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 3")
def top3_per_key(spark: SparkSession, d: str) -> DataFrame:
    r = F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    return table(spark, d, "events").withColumn("rank", r.cast("long")).filter("rank <= 3").select("user_id", "event_id", "rank")


@query("""WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1)
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM latest) WHERE k <= 4""")
def latest_then_cap(spark: SparkSession, d: str) -> DataFrame:
    """The latest of each key, then the four newest keys of each owner."""
    m = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max(F.struct("ts", "event_id")).alias("m"))
    k = F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("m")))
    return m.withColumn("k", k).filter("k <= 4").select("user_id", "event_type", "m.event_id")


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, min(event_id)) AS BIGINT) AS rank FROM events GROUP BY event_type")
def most_common_order(spark: SparkSession, d: str) -> DataFrame:
    """By falling count, of equals the first seen; the window is over one row for each kind."""
    c = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("f"))
    return c.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("n"), "f")).cast("long")).drop("f")
