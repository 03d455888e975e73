"""Tables and derived views; the SQL texts give the same views in DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOST = "SPEAKER_00"
UNKNOWN = "UNKNOWN"

SEGMENTS_SQL = """WITH seg0 AS (SELECT user_id AS file_id, event_id, ts, event_type, value, props, epoch_us(ts) // 1000000 AS ep FROM events),
seg AS (SELECT file_id, event_id, row_number() OVER (PARTITION BY file_id ORDER BY ts, event_id) - 1 AS seg_idx,
  CAST((ep - min(ep) OVER (PARTITION BY file_id)) // 600 AS DOUBLE) AS start_s,
  CAST((ep - min(ep) OVER (PARTITION BY file_id)) // 600 + event_id % 20 AS DOUBLE) AS end_s,
  CASE event_type WHEN 'view' THEN 'SPEAKER_00' WHEN 'click' THEN 'SPEAKER_01' WHEN 'purchase' THEN 'SPEAKER_02' WHEN 'signup' THEN 'SPEAKER_03' ELSE 'UNKNOWN' END AS speaker,
  event_type || ' ' || props AS text FROM seg0),
win AS (SELECT DISTINCT file_id, (CAST(start_s AS BIGINT) // 30) * 30 AS w_start, (CAST(start_s AS BIGINT) // 30) * 30 + 30 AS w_end FROM seg)
"""

CHAT_SQL = """WITH chat AS (SELECT conv_id, turn, CASE WHEN (conv_id * 7 + turn) % 5 = 0 THEN 'tool' ELSE role END AS role, text FROM conversations)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript segments: file_id, seg_idx, event_id, start_s, end_s, speaker, text."""
    events = table(spark, sf_dir, "events").withColumn("ep", epoch_seconds(F.col("ts")))
    file = W.partitionBy("user_id")
    start = F.floor((F.col("ep") - F.min("ep").over(file)) / 600)
    speaker = F.create_map(*[F.lit(x) for x in ("view", HOST, "click", "SPEAKER_01", "purchase", "SPEAKER_02", "signup", "SPEAKER_03")])
    return events.select(
        F.col("user_id").alias("file_id"), "event_id",
        (F.row_number().over(file.orderBy("ts", "event_id")) - 1).cast("long").alias("seg_idx"),
        start.cast("double").alias("start_s"), (start + F.col("event_id") % 20).cast("double").alias("end_s"),
        F.coalesce(F.try_element_at(speaker, F.col("event_type")), F.lit(UNKNOWN)).alias("speaker"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("text"),
    )


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-second tiles of each file in which a segment starts."""
    tile = (F.floor(F.col("start_s") / 30) * 30).cast("long")
    return segments(spark, sf_dir).select("file_id", tile.alias("w_start"), (tile + 30).alias("w_end")).distinct()


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns of which some have a role that chat samples leave out, so that equal roles meet and indexes jump."""
    role = F.when((F.col("conv_id") * 7 + F.col("turn")) % 5 == 0, "tool").otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", role.alias("role"), "text")
