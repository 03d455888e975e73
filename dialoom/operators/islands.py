"""Runs of neighbouring rows: breaks, island numbers, and merged islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UP_TO = (W.unboundedPreceding, W.currentRow)


def with_islands(df: DataFrame, part: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Numbers islands from 0; ``starts`` is true (or null) on a row that begins one, and may use lag columns of ``df``."""
    w = W.partitionBy(*part).orderBy(*order)
    return df.withColumn(name, F.sum(F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0)).over(w.rowsBetween(*UP_TO)) - 1)


def runs(df: DataFrame, part: list[str], order: list[str], same: list[str], joins: Column | None = None) -> DataFrame:
    """Islands of equal ``same`` columns whose ``joins`` condition, on the columns and their ``prev_`` twins, holds."""
    w = W.partitionBy(*part).orderBy(*order)
    wanted = [*same, "start_s", "end_s", "text"]
    df = df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in wanted if c in df.columns})
    equal = F.lit(True)
    for c in same:
        equal = equal & F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    if joins is not None:
        equal = equal & joins
    first = F.row_number().over(w) == 1
    return with_islands(df.withColumn("__breaks", first | ~F.coalesce(equal, F.lit(False))), part, order, F.col("__breaks")).drop("__breaks")


def merged(df: DataFrame, part: list[str], order: str, keep: list[str], glue: str = " ", end: str = "last") -> DataFrame:
    """One row per island: start, end (of the last row, or the largest), count, and text in order."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("start_s").alias("s"), F.col("end_s").alias("e"), F.col("text").alias("t"))))
    out = df.groupBy(*part, "island", *keep).agg(rows.alias("rows"), F.max("end_s").alias("largest"))
    return out.select(
        *part, F.col("island").cast("long").alias("island"), *keep, F.get("rows", F.lit(0))["s"].alias("start_s"),
        (F.element_at("rows", -1)["e"] if end == "last" else F.col("largest")).alias("end_s"),
        F.size("rows").cast("long").alias("n"), F.array_join(F.transform("rows", lambda r: r["t"]), glue).alias("text"),
    )


def merge_speaker_runs(segments: DataFrame, gap: Column | None = None, glue: str = " ", end: str = "last", speaker: str = "speaker") -> DataFrame:
    """Merges neighbouring segments of one speaker; ``gap`` is a condition on ``start_s`` and ``prev_end_s``."""
    return merged(runs(segments, ["file_id"], ["seg_idx"], [speaker], gap), ["file_id"], "seg_idx", [speaker], glue, end)


def merge_by_reach(df: DataFrame, part: list[str], order: list[str], gap: float, strict: bool = True) -> DataFrame:
    """Islands of intervals, a new one where a start is ``gap`` or more past every end before it."""
    w = W.partitionBy(*part).orderBy(*order)
    reach = F.max("end_s").over(w.rowsBetween(W.unboundedPreceding, -1))
    far = F.col("start_s") - reach
    return with_islands(df.withColumn("__far", far >= gap if strict else far > gap), part, order, F.col("__far")).drop("__far")


def compress(df: DataFrame, part: list[str], order: str, label: str) -> DataFrame:
    """Run-length form: label, first and last position, and length of each run."""
    return runs(df, part, [order], [label]).groupBy(*part, "island", label).agg(
        F.min(order).alias("first_idx"), F.max(order).alias("last_idx"), F.count("*").alias("n"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"),
    ).withColumn("island", F.col("island").cast("long"))


def smooth_passes(df: DataFrame, part: list[str], order: str, label: str, passes: int = 2) -> DataFrame:
    """Labels between two equal others become theirs; each pass works on the labels before it."""
    w = W.partitionBy(*part).orderBy(order)
    for _ in range(passes):
        df = df.withColumns({"__b": F.lag(label).over(w), "__a": F.lead(label).over(w)})
        df = df.withColumn(label, F.when((F.col("__b") == F.col("__a")) & (F.col("__b") != F.col(label)), F.col("__b")).otherwise(F.col(label))).drop("__a", "__b")
    return df
