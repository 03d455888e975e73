"""Readers of transcript, annotation and evaluation files."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SEGMENT = "struct<start:double,end:double,speaker:string,text:string>"
TRANSCRIPT = f"segments array<{SEGMENT}>, speakers array<string>"


def glob_pattern(glob: str) -> str:
    """A glob as a regular expression for the last parts of a path; ``*`` and ``?`` stay within a part."""
    wild = {"*": "[^/]*", "?": "[^/]"}
    return "(^|/)" + "".join(wild.get(c, re.escape(c)) for c in glob) + "$"


def files(spark: SparkSession, path: str, include: str | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Paths under a folder, by name, with their sizes; ``exclude`` are globs that match the end of the path, part by part."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if include:
        reader = reader.option("pathGlobFilter", include)
    df = reader.load(path).select("path", "length")
    for glob in exclude or []:
        df = df.filter(~F.col("path").rlike(glob_pattern(glob)))
    return df.orderBy("path")


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Segments of transcript documents, one row each, with file and position; missing speakers are UNKNOWN, texts trimmed."""
    docs = spark.read.schema(TRANSCRIPT).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))
    rows = docs.select("file", F.posexplode("segments").alias("seg_idx", "s"))
    return rows.select(
        "file", "seg_idx", F.round(F.greatest(F.lit(0.0), "s.start"), 2).alias("start_s"), F.round(F.col("s.end"), 2).alias("end_s"),
        F.coalesce("s.speaker", F.lit("UNKNOWN")).alias("speaker"), F.trim(F.coalesce("s.text", F.lit(""))).alias("text"),
    )


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed lines with file and raw text; blank lines are skipped, lines that do not parse have ``record`` null."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"), F.monotonically_increasing_id().alias("__order")).filter(F.trim("raw") != "")
    bad = F.try_parse_json("raw").isNull()
    return lines.select("file", "__order", "raw", F.when(~bad, F.from_json("raw", schema)).alias("record"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not blank with their number from 1 in the file; a file is read whole."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return text.select("file", F.posexplode(F.split("value", "\n")).alias("p", "raw")).select("file", (F.col("p") + 1).alias("line"), F.regexp_replace("raw", "\r$", "").alias("raw")).filter(F.trim("raw") != "")


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records with file and number from 1: lines of ``.jsonl`` files that are not blank, items of a list or the one object in other files.

    Files that are neither give no rows.  Lines that do not parse have ``record`` null.
    """
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("whole"))
    lines = text.filter(F.col("file").endswith(".jsonl")).select("file", F.posexplode(F.split("whole", r"\r?\n")).alias("p", "raw")).filter(F.trim("raw") != "")
    rest = text.filter(~F.col("file").endswith(".jsonl"))
    listed = rest.filter(F.col("whole").rlike(r"^\s*\[")).select("file", F.posexplode(F.from_json("whole", "array<string>")).alias("p", "raw"))
    single = rest.filter(F.col("whole").rlike(r"^\s*\{")).select("file", F.lit(0).alias("p"), F.col("whole").alias("raw"))
    rows = lines.unionByName(listed).unionByName(single)
    return rows.select("file", (F.col("p") + 1).alias("line"), F.when(F.try_parse_json("raw").isNotNull(), F.from_json("raw", schema)).alias("record"))


def lenient_records(spark: SparkSession, path: str, schema: str, id_col: str = "id") -> DataFrame:
    """Records that parse and have an id; all others are dropped."""
    return json_lines(spark, path, schema).filter(F.col(f"record.{id_col}").isNotNull() & (F.col(f"record.{id_col}") != "")).select("record.*")


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that are not blank: of a file, of a folder's ``cases/*.jsonl`` if there are such, else of its own ``*.jsonl``; 0 if there are none."""
    text = spark.read.option("pathGlobFilter", "*.jsonl")
    for tried in (f"{path}/cases", path):
        try:
            # a file named as such is read whatever its ending
            lines = (spark.read if tried == path and "." in path.rsplit("/", 1)[-1] else text).text(tried)
            found, n = lines.agg(F.count("*"), F.count_if(F.trim("value") != "")).first()
        except AnalysisException:
            continue
        if found:
            return n
    return 0


CASE = "id string, benchmark_id string, slice string, user_text string, prompt string, messages array<struct<role:string,content:string,text:string>>"


def suite_cases(spark: SparkSession, path: str) -> DataFrame:
    """Cases of a suite: one file, or a folder with ``cases/*.jsonl`` (that lacking is an error, as it is for the suite's users).

    Ids fall back to benchmark_id and then to a number that runs on across the files; slices fall back to the file's stem for folders
    only.  A suite is some thousand cases; the running number is one window over them.
    """
    single = path.endswith((".jsonl", ".json"))
    rows = numbered_lines(spark, path if single else f"{path}/cases/*.jsonl").withColumn("r", F.from_json("raw", CASE))
    stem = F.lit(None).cast("string") if single else F.regexp_extract("file", r"([^/]+)\.[^.]+$", 1)
    n = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("file", "line"))
    return rows.withColumn("n", n).select(
        F.coalesce("r.id", F.nullif("r.benchmark_id", F.lit("")), F.format_string("case-%04d", "n")).alias("id"), F.coalesce(F.nullif("r.slice", F.lit("")), stem).alias("slice"),
        F.coalesce("r.user_text", "r.prompt").alias("user_text"), "r.messages",
    )


def suite_meta(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The object in a suite folder's ``suite.json``; no row where it has none."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(f"{path}/suite.json")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def raw_sections(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``[n] HH:MM:SS.ss - HH:MM:SS.ss SPEAKER | text``; others are skipped."""
    from dialoom.functions.scalars import parse_clock

    pattern = r"^\[(\d+)\]\s+([\d:.]+)\s+-\s+([\d:.]+)\s+(\S+)\s*\|\s*(.*)$"
    g = lambda k: F.regexp_extract("raw", pattern, k)
    return numbered_lines(spark, path).filter(F.col("raw").rlike(pattern)).select("file", g(1).cast("long").alias("idx"), parse_clock(g(2)).alias("start_s"), parse_clock(g(3)).alias("end_s"), g(4).alias("speaker"), g(5).alias("text"))


def legacy_transcript(spark: SparkSession, path: str) -> DataFrame:
    """Text with ``[speakerN] t - t`` before a line of speech and ``[t - t]`` before one of the same speaker."""
    w = W.partitionBy("file").orderBy("line").rowsBetween(W.unboundedPreceding, W.currentRow)
    span = r"([\d:.]+)\s*-\s*([\d:.]+)"
    rows = numbered_lines(spark, path).filter(~F.col("raw").startswith("#"))
    mark = F.col("raw").rlike(rf"^\[(speaker\d+\]\s*)?{span}")
    last = lambda c: F.last(F.when(c != "", c), ignorenulls=True).over(w)
    rows = rows.withColumns({"mark": mark, "speaker": last(F.regexp_extract("raw", r"^\[(speaker\d+)\]", 1)), "start": last(F.when(mark, F.regexp_extract("raw", span, 1))), "end": last(F.when(mark, F.regexp_extract("raw", span, 2)))})
    from dialoom.functions.scalars import parse_clock

    return rows.filter("not mark").select("file", "line", "speaker", parse_clock(F.col("start")).alias("start_s"), parse_clock(F.col("end")).alias("end_s"), F.trim("raw").alias("text"))


def legacy_duration(spark: SparkSession, path: str) -> DataFrame:
    """Seconds that the header of a legacy text tells in its first ten lines; 0 without one."""
    text = spark.read.text(path, wholetext=True)
    head = F.filter(F.slice(F.split("value", "\n"), 1, 10), lambda line: line.startswith("# 时长:"))
    told = F.regexp_extract(F.coalesce(F.get(head, F.lit(0)), F.lit("")), r"(\d+)\s*秒", 1).try_cast("long")
    return text.select(F.col("_metadata.file_path").alias("file"), F.coalesce(told, F.lit(0)).alias("seconds"))


def part_list(spark: SparkSession, path: str) -> DataFrame:
    """Paths of a list of strings, a list of objects with ``path``, or an object with such a list as ``items``, in order."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"^\s+", "").alias("v"))
    items = F.from_json(F.when(F.col("v").startswith("["), F.col("v")).otherwise(F.get_json_object("v", "$.items")), "array<string>")
    rows = raw.select(F.posexplode(items).alias("pos", "item"))
    named = F.when(F.col("item").startswith("{"), F.get_json_object("item", "$.path")).otherwise(F.col("item"))
    return rows.select("pos", named.alias("path")).filter(F.col("path") != "")


def playback_positions(spark: SparkSession, path: str) -> DataFrame:
    """A map of id to seconds as ``positions``, for ``links.with_positions``."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,double>").alias("positions"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A playlist that is an array or an object with ``items``."""
    item = "struct<id:string,filename:string,filepath:string,date:string,startTime:string,endTime:string,personTag:string,lastPosition:double>"
    raw = spark.read.text(path, wholetext=True)
    is_list = F.ltrim("value").startswith("[")
    items = F.when(is_list, F.from_json("value", f"array<{item}>")).otherwise(F.from_json("value", f"items array<{item}>")["items"])
    return raw.select(F.inline(items))


def first_object(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``first_json``: the first JSON object of a text that may have more after it."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            try:
                return json.dumps(json.JSONDecoder().raw_decode((text or "").lstrip())[0], ensure_ascii=False)
            except ValueError:
                return None

        return texts.map(one)

    return df.withColumn("first_json", run(F.col(text_col)))


def sse_payloads(blocks: Iterator[str], rest: str = "") -> tuple[list[str], str]:
    """``data:`` payloads of whole blocks of an event stream, and the text after the last one."""
    text = (rest + "".join(blocks)).replace("\r\n", "\n")
    *whole, rest = text.split("\n\n")
    out = []
    for block in whole:
        data = [line[5:].lstrip() for line in block.split("\n") if line.startswith("data:")]
        if data:
            out.append("\n".join(data))
    return out, rest
