"""Batch twins of the streams, and files written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.plans.base import query
from dialoom.sources import writers
from dialoom.sources.tables import SEGMENTS_SQL, epoch_seconds, segments, table
from dialoom.streaming import events as ops


def _epoch(c: str):
    return epoch_seconds(F.col(c))


@query("SELECT epoch_us(ts) // 1000000 // 3600 AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    return ops.tumbling_counts(table(spark, d, "events")).select(F.floor(_epoch("w.start") / 3600).alias("hour"), "event_type", "n")


@query("SELECT (epoch_us(ts) // 1000000 // 1800 - k) AS half_hour, event_type, count(*) AS n FROM events, (VALUES (0), (1)) v(k) GROUP BY 1, 2")
def sliding_counts(spark: SparkSession, d: str) -> DataFrame:
    return ops.tumbling_counts(table(spark, d, "events"), "1 hour", "30 minutes").select(F.floor(_epoch("w.start") / 1800).alias("half_hour"), "event_type", "n")


@query("""WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS c FROM events), b AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM a)
SELECT user_id, epoch_us(min(ts)) // 1000000 AS start, count(*) AS n FROM b GROUP BY user_id, i""")
def session_gaps(spark: SparkSession, d: str) -> DataFrame:
    return ops.sessions(table(spark, d, "events"), "2 hours").select("user_id", _epoch("w.start").alias("start"), "n")


@query("SELECT DISTINCT event_id, user_id FROM events")
def dedupe_stream(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return ops.deduplicated(e.unionByName(e)).select("event_id", "user_id")


@query("SELECT user_id, event_type AS key, max(event_id) AS event_id, count(*) AS n FROM events GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY max(event_id) DESC) <= 4")
def memory_fold(spark: SparkSession, d: str) -> DataFrame:
    """The memory that the stream ends with when all events come in one batch."""
    from pyspark.sql import Window as W

    m = table(spark, d, "events").groupBy("user_id", F.col("event_type").alias("key")).agg(F.max("event_id").alias("event_id"), F.count("*").alias("n"))
    return m.withColumn("k", F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("event_id")))).filter(f"k <= {ops.CAP}").drop("k")


@query(f"""{SEGMENTS_SQL}, f AS (SELECT *, CAST(start_s AS BIGINT) AS a, CAST(end_s AS BIGINT) AS b FROM seg) SELECT file_id, string_agg((seg_idx + 1) || chr(10) || lpad(CAST(a // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(a // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(a % 60 AS VARCHAR), 2, '0') || ',000 --> ' || lpad(CAST(b // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(b // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(b % 60 AS VARCHAR), 2, '0') || ',000' || chr(10) || '[' || speaker || '] ' || text || chr(10), chr(10) ORDER BY seg_idx) AS content FROM f GROUP BY file_id""")
def srt_files(spark: SparkSession, d: str) -> DataFrame:
    return writers.subtitle_text(segments(spark, d))


@query(f"{SEGMENTS_SQL} SELECT file_id, seg_idx, text, start_s * 1000 AS startMs, end_s * 1000 AS endMs, start_s * 1000 AS timestampMs, 0.95::DOUBLE AS confidence FROM seg")
def caption_rows(spark: SparkSession, d: str) -> DataFrame:
    return writers.captions(segments(spark, d))


@query("SELECT doc_id, coalesce(u.lang, d.lang) AS lang, CASE WHEN u.doc_id IS NULL THEN 0 ELSE 1 END AS version FROM documents d LEFT JOIN (SELECT doc_id, 'xx' AS lang FROM labels GROUP BY doc_id) u USING (doc_id)")
def keyed_upsert(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "documents").select("doc_id", "lang", F.lit(0).alias("version"))
    new = table(spark, d, "labels").select("doc_id", F.lit("xx").alias("lang"), F.lit(1).alias("version"))
    return writers.upsert(old, new, ["doc_id"], "version")
