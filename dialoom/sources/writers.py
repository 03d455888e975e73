"""Writers of data sets, exports and subtitles; always to new folders."""

from __future__ import annotations

import json
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.scalars import clock_hundredths, srt_time


def json_lines(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.option("ignoreNullFields", "false")
    (writer.partitionBy(*by) if by else writer).json(path)


def split_outputs(df: DataFrame, path: str, parts: dict[str, Column], by: str | None = None) -> dict[str, int]:
    """One folder for each named filter, with one of each value of ``by`` (say, the year) in it; returns the rows of each filter, counted in one pass."""
    counts = df.agg(*[F.count_if(c).alias(k) for k, c in parts.items()]).first().asDict()
    for name, keep in parts.items():
        json_lines(df.filter(keep), f"{path}/{name}", [by] if by else None)
    return counts


def entity_records(df: DataFrame, path: str, date: str = "date", start: str = "start", end: str = "end", tag: str = "tag") -> None:
    """Records by date, each with ``entity``, the name ``date_start_end_tag`` that a file of its own would have."""
    named = df.withColumn("entity", F.concat_ws("_", date, start, end, tag))
    json_lines(named, path, [date])


#: Names that trainers look for in a description of chat samples.
CHAT_TAGS = {"role_tag": "role", "content_tag": "content", "user_tag": "user", "assistant_tag": "assistant", "system_tag": "system"}


def training_set(samples: DataFrame, path: str, split_col: str = "split", name: str = "samples") -> dict[str, int]:
    """Samples by split, a manifest of their counts, and a description of each split's files for trainers."""
    samples.write.partitionBy(split_col).json(f"{path}/data")
    counts = {r[0]: r[1] for r in samples.groupBy(split_col).count().collect()}
    spark = samples.sparkSession
    one_text(spark, json.dumps({"splits": counts, "columns": samples.columns}), f"{path}/manifest")
    info = {f"{name}_{k}": {"file_name": f"data/{split_col}={k}", "formatting": "sharegpt", "columns": {"messages": "messages"}, "tags": CHAT_TAGS} for k in sorted(counts)}
    one_text(spark, json.dumps(info), f"{path}/dataset_info")
    return counts


def one_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def export_bundle(records: DataFrame, path: str, source_col: str = "source_type", title: str = "export", export_id: str = "", at: datetime | None = None) -> dict:
    """Records with a manifest (distinct source types, count) and a readme, in the folder of the Shanghai day of ``at`` if that is given."""
    if at is not None:
        path = f"{path}/{at.astimezone(ZoneInfo('Asia/Shanghai')):%Y-%m-%d}/{export_id}"
    records.write.json(f"{path}/records")
    row = records.agg(F.sort_array(F.collect_set(F.nullif(F.col(source_col), F.lit("")))).alias("s"), F.count("*").alias("n")).first()
    manifest = {"source_types": row.s, "record_count": row.n}
    one_text(records.sparkSession, json.dumps(manifest), f"{path}/manifest")
    told = {"export_id": export_id, "created_at": at.isoformat() if at else "", "record_count": row.n, "jsonl": f"{path}/records", "manifest": f"{path}/manifest"}
    one_text(records.sparkSession, "\n".join([f"# {title}", "", *[f"- {k}: {v}" for k, v in told.items()]]), f"{path}/readme")
    return manifest


def quoted_csv(df: DataFrame, path: str, newest: str | None = None, bom: bool = False) -> None:
    """All fields quoted, quotes doubled, nulls empty, with a header; newest rows first and a byte-order mark in front where asked for.

    In order or with a mark it is one file, which is meant for a person's spreadsheet, not for large tables.
    """
    order = [F.desc(newest)] if newest else []
    if not bom:
        df = df.repartition(1).sortWithinPartitions(*order) if newest else df
        df.write.csv(path, header=True, quoteAll=True, quote='"', escape='"')
        return
    field = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    head = "\ufeff" + ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
    lines = df.select(F.lit(1).alias("__part"), F.concat_ws(",", *[field(F.col(c)) for c in df.columns]).alias("value"), (F.col(newest) if newest else F.lit(None)).alias("__at"))
    first = df.sparkSession.range(1).select(F.lit(0).alias("__part"), F.lit(head).alias("value"), F.lit(None).alias("__at"))
    first.union(lines).repartition(1).sortWithinPartitions("__part", F.desc("__at")).select("value").write.text(path)


def percent(share: Column) -> Column:
    return F.when(share.isNull(), "N/A").otherwise(F.format_string("%.1f%%", share * 100))


def change(before: Column, after: Column) -> Column:
    """The difference of two shares in percentage points, with its sign."""
    delta = (after - before) * 100
    text = F.concat(F.when(delta >= 0, "+").otherwise(""), F.format_string("%.2f pp", delta))
    return F.when(before.isNull() | after.isNull(), "N/A").otherwise(text)


def subtitle_text(segments: DataFrame, part: str = "file_id", kind: str = "srt") -> DataFrame:
    """One text per file: ``srt`` blocks, ``text`` lines, or ``json`` with segments and speakers, in order."""
    if kind == "json":
        line = F.struct(F.round("start_s", 2).alias("start"), F.round("end_s", 2).alias("end"), "speaker", F.trim("text").alias("text"))
    elif kind == "srt":
        line = F.concat_ws("\n", (F.col("seg_idx") + 1).cast("string"), F.concat(srt_time(F.col("start_s")), F.lit(" --> "), srt_time(F.col("end_s"))), F.concat(F.lit("["), "speaker", F.lit("] "), "text"), F.lit(""))
    else:
        line = F.concat(F.lit("["), clock_hundredths(F.col("start_s")), F.lit("] "), "speaker", F.lit(": "), "text")
    rows = F.transform(F.sort_array(F.collect_list(F.struct("seg_idx", line.alias("b")))), lambda r: r["b"])
    if kind == "json":
        content = F.to_json(F.struct(rows.alias("segments"), F.sort_array(F.collect_set("speaker")).alias("speakers")))
    else:
        content = F.array_join(rows, "\n")
    return segments.groupBy(part).agg(content.alias("content"))


def captions(segments: DataFrame) -> DataFrame:
    ms = lambda c: (F.col(c) * 1000).alias
    return segments.select("file_id", "seg_idx", "text", ms("start_s")("startMs"), ms("end_s")("endMs"), ms("start_s")("timestampMs"), F.lit(0.95).alias("confidence"))


def upsert(current: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The rows after an upsert: for each key that with the highest version, new rows before old ones."""
    both = current.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    rest = [c for c in current.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(version), F.col("__new"))).alias("r")
    return both.groupBy(*keys).agg(best).select(*keys, "r.*")
