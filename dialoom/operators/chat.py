"""Turns, training samples, splits and context windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import scalars
from dialoom.operators import islands

SEED, DEV_SHARE = "20260327", 0.05


def merge_turns(turns: DataFrame, answering: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Turns of user and assistant (whatever is called so, ``answering``): blanks dropped, neighbours of one role joined by a blank line, cut to begin with user and end with assistant."""
    roles = F.when(F.col("role").isin(*answering), "assistant").when(F.col("role") == "user", "user")
    rows = turns.select("conv_id", "turn", roles.alias("role"), F.trim("text").alias("text")).filter("role is not null and text <> ''")
    rows = islands.runs(rows, ["conv_id"], ["turn"], ["role"])
    parts = F.sort_array(F.collect_list(F.struct("turn", "text")))
    merged = rows.groupBy("conv_id", F.col("island").cast("long").alias("pos"), "role").agg(F.array_join(F.transform(parts, lambda r: r["text"]), "\n\n").alias("content"))
    of = W.partitionBy("conv_id")
    first, last = F.min(F.when(F.col("role") == "user", F.col("pos"))).over(of), F.max(F.when(F.col("role") == "assistant", F.col("pos"))).over(of)
    merged = merged.withColumns({"first": first, "last": last}).filter("pos >= first and pos <= last")
    return merged.select("conv_id", (F.col("pos") - F.col("first")).alias("pos"), "role", "content")


def recall(queries: DataFrame, memories: DataFrame, as_of: Column, k: int = 4) -> DataFrame:
    """The ``k`` memories of a query's session of most relevance as of a given time, newer ones first among equals.

    ``queries`` has session, query_id and text, ``memories`` session, memory_id, text and updated_at.
    """
    q = queries.select("session", "query_id", scalars.memory_tokens(F.col("text")).alias("q"))
    m = memories.select("session", "memory_id", "updated_at", scalars.memory_tokens(F.col("text")).alias("m"))
    age = (F.unix_micros(as_of) - F.unix_micros("updated_at")) / 86_400e6
    scored = q.join(m, "session").withColumn("score", scalars.relevance(F.col("q"), F.col("m"), age))
    w = W.partitionBy("session", "query_id").orderBy(F.desc("score"), F.desc("updated_at"), "memory_id")
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k).select("session", "query_id", "memory_id", "score", "rank")


def turn_samples(merged: DataFrame) -> DataFrame:
    """For each assistant turn after a user turn: the messages up to it."""
    w = W.partitionBy("conv_id").orderBy("pos")
    upto = F.collect_list(F.struct("role", "content")).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = merged.withColumns({"messages": upto, "before": F.lag("role").over(w)}).filter("role = 'assistant' and before = 'user'")
    no = F.row_number().over(w)
    return rows.select("conv_id", F.concat(F.lit("conv_"), F.col("conv_id"), F.lit("__"), F.format_string("%04d", no)).alias("sample_id"), F.col("pos").alias("target_pos"), "messages")


def split_of(key: Column, seed: str = SEED, dev: float = DEV_SHARE) -> Column:
    return F.when(scalars.split_bucket(seed, key) < dev, "dev").otherwise("train")


def stable_turns(turns: DataFrame) -> DataFrame:
    """Whether each turn is stable: of users in a row the last is, and none at the end."""
    rows = turns.filter(F.col("role").isin("user", "assistant") & (F.col("text") != ""))
    after = F.lead("role").over(W.partitionBy("conv_id").orderBy("turn"))
    return rows.withColumn("stable", ~((F.col("role") == "user") & F.coalesce(after == "user", F.lit(True))))


def trimmed_context(turns: DataFrame, most_turns: int, budget: int) -> DataFrame:
    """The newest turns, at most ``most_turns``, whose estimated tokens fit ``budget``; 0 turns keeps all, as the rule has it."""
    newest = W.partitionBy("conv_id").orderBy(F.col("turn").desc())
    rows = turns.withColumn("age", F.row_number().over(newest))
    if most_turns:
        rows = rows.filter(F.col("age") <= most_turns)
    used = F.sum(F.length("role") + F.length("text") + 8).over(newest.rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("used", F.greatest(F.lit(1), F.ceil(used / 4))).withColumn("kept", F.col("used") <= budget)
