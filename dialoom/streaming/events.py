"""Event-time operators on streams and, with the same results, on tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dialoom.sources.readers import sse_payloads

LATE = "10 minutes"


def with_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time, on streams with a watermark, for which times without zone are taken as session time."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, LATE) if df.isStreaming else df


def tumbling_counts(df: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return with_time(df).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(df: DataFrame, gap: str = "2 minutes") -> DataFrame:
    """Sessions of one user that ``gap`` without events ends: the event-time twin of the silence rule."""
    return with_time(df).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))


def deduplicated(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Each key once, late repeats within the watermark included."""
    df = with_time(df)
    return df.dropDuplicatesWithinWatermark([key]) if df.isStreaming else df.dropDuplicates([key])


MEMORY = "user_id long, key string, event_id long, n long"
CAP = 4


def fold_memory(state: dict[str, tuple[int, int]], rows: pd.DataFrame, cap: int = CAP) -> dict[str, tuple[int, int]]:
    """Memory by key: the newest event and a count; beyond ``cap`` keys, which is the rule, the oldest go."""
    for key, event in zip(rows["event_type"], rows["event_id"], strict=True):
        newest, n = state.get(key, (-1, 0))
        state[key] = (max(newest, int(event)), n + 1)
    return dict(sorted(state.items(), key=lambda kv: kv[1][0], reverse=True)[:cap])


def _timeout(idle: int | None) -> str:
    """State of a key goes after ``idle`` milliseconds without rows of it; such a stream runs batches without rows, too, so it is never caught up."""
    return GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout


def memory_stream(df: DataFrame, idle: int | None = None) -> DataFrame:
    """The memory of each user after each batch, kept as state; with ``idle`` until the user has been away for so many milliseconds."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = {k: (e, n) for k, e, n in zip(*state.get, strict=True)} if state.exists else {}
        for rows in batches:
            held = fold_memory(held, rows.sort_values("event_id"))
        state.update(([*held], [e for e, _ in held.values()], [n for _, n in held.values()]))
        if idle:
            state.setTimeoutDuration(idle)
        yield pd.DataFrame({"user_id": key[0], "key": list(held), "event_id": [e for e, _ in held.values()], "n": [n for _, n in held.values()]})

    return df.groupBy("user_id").applyInPandasWithState(step, MEMORY, "k array<string>, e array<bigint>, n array<bigint>", "update", _timeout(idle))


def ingest_new(batch: DataFrame, target: str, key: str) -> int:
    """Appends rows whose key the target folder lacks; returns how many.  For ``foreachBatch``.

    A batch that is run again, after a whole write or one that died, adds only what is still missing: Spark's commit of a
    folder makes the rows of a write appear together.
    """
    spark = batch.sparkSession
    fresh = batch.dropDuplicates([key])
    try:
        fresh = fresh.join(spark.read.parquet(target).select(key), key, "left_anti")
    except AnalysisException:
        pass  # the first batch
    seen = Observation()
    fresh.observe(seen, F.count("*").alias("n")).write.mode("append").parquet(target)
    return seen.get["n"]


DELTAS = "request_id long, text string, tokens long, done boolean"


def fold_deltas(held: tuple[str, int, bool], payloads: list[str]) -> tuple[str, int, bool]:
    """Text so far with the deltas of an inference stream; ``[DONE]`` ends it, and what comes after counts no more."""
    text, tokens, done = held
    for payload in payloads:
        if done:
            break
        if payload.strip() == "[DONE]":
            done = True
            continue
        try:
            got = json.loads(payload)
        except ValueError:
            continue
        text += str(got.get("delta") or "")
        tokens = int((got.get("usage") or {}).get("completion_tokens") or tokens)
    return text, tokens, done


def delta_stream(df: DataFrame, idle: int | None = None) -> DataFrame:
    """The text of each request after each batch of its (request_id, seq, payload) rows.

    Of a request that is done the state keeps no text, only that it is done, so that late rows give nothing; with
    ``idle`` that goes too after so many milliseconds without rows.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = tuple(state.get) if state.exists else ("", 0, False)
        if held[2]:
            return
        # the batches of a key come in no order of their own
        rows = pd.concat(list(batches)).sort_values("seq")
        held = fold_deltas(held, rows["payload"].tolist())
        state.update(("", held[1], True) if held[2] else held)
        if idle:
            state.setTimeoutDuration(idle)
        yield pd.DataFrame({"request_id": [key[0]], "text": [held[0]], "tokens": [held[1]], "done": [held[2]]})

    return df.groupBy("request_id").applyInPandasWithState(step, DELTAS, "text string, tokens bigint, done boolean", "update", _timeout(idle))


def payload_stream(df: DataFrame, idle: int | None = None) -> DataFrame:
    """``data:`` payloads of event streams from their (request_id, seq, chunk) rows; what a batch leaves of a block waits as state.

    ``seq`` of a payload is the chunk that ends its block and ``pos`` its place among those.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rest = state.get[0] if state.exists else ""
        out = []
        for seq, chunk in pd.concat(list(batches)).sort_values("seq")[["seq", "chunk"]].itertuples(index=False, name=None):
            got, rest = sse_payloads(iter([chunk or ""]), rest)
            out += [(key[0], seq, i, payload) for i, payload in enumerate(got)]
        state.update((rest,))
        if idle:
            state.setTimeoutDuration(idle)
        yield pd.DataFrame(out, columns=["request_id", "seq", "pos", "payload"])

    return df.groupBy("request_id").applyInPandasWithState(step, "request_id long, seq long, pos long, payload string", "rest string", "append", _timeout(idle))


def match_profiles(profiles: list[list[float]], weights: list[float], found: list[tuple[str, list[float], float]], least: float = 0.65) -> dict[str, int]:
    """Speakers of a chunk to the running profiles, nearest first and one-to-one; new ones are added, met ones move by duration."""
    unit = lambda v: (np.asarray(v, float) / (np.linalg.norm(v) or 1.0)).tolist()
    known = len(profiles)
    scores = [(float(np.dot(unit(v), unit(profiles[k]))), i, k) for i, (_, v, _) in enumerate(found) for k in range(known)]
    out: dict[str, int] = {}
    for score, i, k in sorted(scores, key=lambda s: (-s[0], s[1], s[2])):
        if score >= least and found[i][0] not in out and k not in out.values():
            out[found[i][0]] = k
    for name, vector, seconds in found:
        if name not in out:
            out[name] = len(profiles)
            profiles.append(unit(vector))
            weights.append(seconds)
        else:
            k = out[name]
            total = weights[k] + seconds
            profiles[k] = unit((np.asarray(profiles[k]) * weights[k] + np.asarray(unit(vector)) * seconds) / (total or 1.0))
            weights[k] = total
    return out


def profile_stream(df: DataFrame, least: float = 0.65, idle: int | None = None) -> DataFrame:
    """Speakers of a file's chunks as running profiles, from (file_id, chunk, speaker, vector, seconds) rows; the profiles are state.

    Chunks of one batch are taken in order, speakers of a chunk by name.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        profiles, weights = ([list(v) for v in state.get[0]], list(state.get[1])) if state.exists else ([], [])
        out = []
        for chunk, rows in pd.concat(list(batches)).sort_values(["chunk", "speaker"]).groupby("chunk"):
            met = match_profiles(profiles, weights, list(zip(rows["speaker"], rows["vector"].map(list), rows["seconds"], strict=True)), least)
            out += [(key[0], chunk, name, k) for name, k in sorted(met.items())]
        state.update(([[float(x) for x in v] for v in profiles], [float(w) for w in weights]))
        if idle:
            state.setTimeoutDuration(idle)
        yield pd.DataFrame(out, columns=["file_id", "chunk", "speaker", "profile"])

    return df.groupBy("file_id").applyInPandasWithState(step, "file_id long, chunk long, speaker string, profile long", "p array<array<double>>, w array<double>", "append", _timeout(idle))
