"""Rules that give issues, and statuses from issues.

A rule is a condition on a row with a severity, a code and a message.  All
rules of a table are evaluated in one pass into an array of issues.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    code: str
    when: Column
    severity: str = "error"
    path: str = "$"


def evaluated(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``issues``: (severity, code, path) of each rule that holds, in the rules' order."""
    made = [F.when(r.when, F.struct(F.lit(r.severity).alias("severity"), F.lit(r.code).alias("code"), F.lit(r.path).alias("path"))) for r in rules]
    return df.withColumn("issues", F.array_compact(F.array(*made)))


def by_record():
    return W.partitionBy("record_id").orderBy("pos")


def turn_issues(turns: DataFrame, lead: str = "lead") -> DataFrame:
    """Adds ``issues`` of the turn sequence and of turns outside their section.

    ``turns`` has record_id, pos (from 0), turn_index, role, speaker_id, start, end, section_start and section_end;
    ``lead``: the role whose turns the host speaks.
    """
    w = by_record()
    ended = F.last("end", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = turns.withColumns({"__before": F.lag("role").over(w), "__ended": ended})
    says = lambda role, speaker: (F.col("role") == role) & ~F.col("speaker_id").eqNullSafe(speaker)
    return evaluated(rows, [
        Rule("turn_index_not_sequential", ~F.col("turn_index").eqNullSafe(F.col("pos"))),
        Rule("role_speaker_mismatch", says(lead, "host") | says("user", "guest")),
        Rule("turn_time_reversed", F.col("start") > F.col("end")),
        Rule("adjacent_same_role_turns", F.col("__before") == F.col("role")),
        Rule("turn_time_overlap", F.col("start") < F.col("__ended") - 1e-6, "warning"),
        Rule("turn_outside_section", F.col("start") < F.col("section_start") - 1e-6, "warning"),
        Rule("turn_outside_section", F.col("end") > F.col("section_end") + 1e-6, "warning"),
    ]).drop("__before", "__ended")


def status_of(issues: Column, applicable: Column | None = None) -> Column:
    """fail with an error, warn with a warning, else pass; skip where no rule applies."""
    has = lambda s: F.exists(issues, lambda i: i["severity"] == s)
    out = F.when(has("error"), "fail").when(has("warning"), "warn").otherwise("pass")
    return out if applicable is None else F.when(applicable, out).otherwise("skip")


def outer(issues: Column | str) -> Column:
    """A row for each issue, as ``i``, and one of null where there is none, to be filtered.

    An inner explode makes the optimizer filter by the size of the list first, which
    works out the whole list twice, and once more below each step it passes.
    """
    return F.explode_outer(issues).alias("i")


def exploded(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.explode("issues").alias("i")).select(*keys, "i.severity", "i.code", "i.path")


def all_safe(issues: Column, safe: list[str]) -> Column:
    """Whether there are issues and all may be repaired without a look at the source."""
    return (F.size(issues) > 0) & F.forall(issues, lambda i: i["code"].isin(safe))

