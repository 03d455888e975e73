"""Section records of older shapes, under many spellings, made formal: parsed once to VARIANT and read in the row.

Sentences are the first list found under the names that shapes use; who speaks
is told by what a record says of its host and guests, else by the looks of the
name; times may be numbers or clock texts, and may count from the section.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.scalars import clock_hundredths, parse_clock
from dialoom.operators.sections import NAMES, hundredths, noted
from dialoom.operators.validation import kind_of

#: Names under which shapes keep their sentences, at the top and in ``meta``; fixed values of the formats.
LISTS = ("sentences", "raw_segments", "segments", "turns", "utterances", "raw_turns")
META_LISTS = ("segments", "raw_segments", "turns")
STARTS, ENDS = ("start", "start_time", "original_start"), ("end", "end_time", "original_end")
COUNTS = ("raw_segment_count", "segment_count", "num_segments", "total_segments", "total_sentences", "sentence_count")
PLACES = ("$", "$.meta", "$.metadata", "$.section_info")
HOST_WORDS, GUEST_WORDS = ("host", "主播"), ("guest", "嘉宾", "用户")
HOST_ALIASES, GUEST_ALIASES = ("主播", "HOST", "host", "main_speaker"), ("嘉宾", "guest", "GUEST", "用户")


def _at(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _string(v: Column, path: str) -> Column:
    """A text that is there and not empty."""
    x = _at(v, path)
    return F.nullif(F.when(kind_of(x) == "STRING", _at(v, path, "string")), F.lit(""))


def _first(v: Column, *paths: str) -> Column:
    """The value of the first path that is there, as a text; '' for a null or none."""
    return F.coalesce(_at(F.coalesce(*[_at(v, p) for p in paths]) if len(paths) > 1 else _at(v, paths[0]), "$", "string"), F.lit(""))


def seconds(text: Column) -> Column:
    """Seconds of H:MM:SS(.f), M:SS(.f) or a number; 0 for anything else."""
    bare = F.trim(text)
    return F.when(bare.rlike(r"^\d+(:\d{2}){1,2}(\.\d+)?$"), parse_clock(bare)).otherwise(F.coalesce(bare.try_cast("double"), F.lit(0.0)))


def _has(v: Column, *paths: str) -> Column:
    return F.coalesce(*[_at(v, p) for p in paths]).isNotNull() if len(paths) > 1 else _at(v, paths[0]).isNotNull()


def _list(v: Column) -> tuple[Column, Column]:
    """The list of sentences, objects only, and the name it goes by."""
    found, name = F.array().cast("array<variant>"), F.lit("none")
    for key, path in reversed([*((k, f"$.{k}") for k in LISTS), *((k, f"$.meta.{k}") for k in META_LISTS)]):
        is_list = F.coalesce(kind_of(_at(v, path)) == "ARRAY", F.lit(False))
        found, name = F.when(is_list, _at(v, path, "array<variant>")).otherwise(found), F.when(is_list, key).otherwise(name)
    return F.filter(found, lambda x: kind_of(x) == "OBJECT"), name


def _aliases(v: Column, own: tuple[str, ...], role: str, plural: str, words: tuple[str, ...], name: str | None) -> Column:
    """All names a record has for one side."""
    fields = ("main_speaker", "host", "host_speaker") if role == "host" else ("guest", "guest_speaker")
    said = [F.array(*[F.lit(x) for x in own])]
    said.append(F.array_compact(F.array(*[_string(v, f"{place}.{f}") for place in PLACES[:3] for f in fields])))
    said.append(F.coalesce(_at(v, f"$.{plural}", "array<string>"), F.array().cast("array<string>")))
    if role == "host":
        said.append(F.array_compact(F.array(_string(v, "$.speakers.host"))))
    else:
        said.append(F.coalesce(_at(v, "$.speakers.guests", "array<string>"), F.array().cast("array<string>")))
    for table in ("$.speaker_mapping", "$.speaker_roles"):
        says = lambda x: reduce(Column.__or__, [F.contains(F.lower(x), F.lit(w)) for w in words] + ([F.contains(x, F.lit(name))] if name else []))
        named = F.map_filter(_at(v, table, "map<string,variant>"), lambda _, x: F.coalesce(says(_at(x, "$", "string")), F.lit(False)))
        said.append(F.coalesce(F.map_keys(named), F.array().cast("array<string>")))
    return F.filter(F.concat(*said), lambda x: x.isNotNull() & (x != ""))


def _sentences(items: Column, call: Column, hosts: Column, guests: Column, offset: Column, host_name: str) -> Column:
    """start, end, speaker_id, pos and text of each item; what is read of an item is read once."""
    def read(x: Column, i: Column) -> Column:
        start, end = _first(x, "$.start", "$.start_time"), F.when(_has(x, "$.end", "$.end_time"), _first(x, "$.end", "$.end_time"))
        is_host = _at(x, "$.is_host")
        return F.struct(
            i.alias("pos"), _first(x, "$.speaker_id", "$.speaker", "$.role", "$.name").alias("who"), _first(x, "$.speaker_name", "$.name").alias("name"), _first(x, "$.speaker_role", "$.role").alias("role"),
            seconds(start).alias("start"), F.when(end.isNotNull(), seconds(end)).alias("end"), _has(x, "$.original_start").alias("again"), _first(x, "$.text").alias("text"),
            F.when(kind_of(is_host) == "BOOLEAN", _at(is_host, "$", "boolean")).alias("is_host"),
        )

    def placed(r: Column) -> Column:
        end, low = F.coalesce(r.end, r.start), F.lower(r.who)
        moves = (offset != 0) & ((r.start < offset) | ((r.start < 5) & (end < offset + 5) & r.again))
        shift = F.when(moves, offset).otherwise(F.lit(0.0))
        known = lambda names: F.array_contains(names, r.who) | F.array_contains(names, r["name"]) | F.array_contains(names, r.role)
        host = (
            F.when(r.is_host.isNotNull(), r.is_host).when(known(hosts) | F.contains(r["name"], F.lit(host_name)) | F.contains(r.role, F.lit("主播")), True)
            .when(known(guests) | F.contains(r["name"], F.lit("嘉宾")) | F.contains(r["name"], F.lit("用户")), False)
            .when(F.startswith(low, F.lit("g")), False).when(F.startswith(low, F.lit("h")), True).otherwise(~call)
        )
        return F.struct(
            hundredths(r.start + shift).alias("start"), hundredths(F.greatest(end, r.start) + shift).alias("end"), F.when(host, "host").otherwise("guest").alias("speaker_id"), r.pos.alias("pos"), r.text.alias("text"))

    return F.array_sort(F.transform(F.transform(items, read), placed))


def formal(records: DataFrame, raw: str, kind: str, host_name: str = NAMES["host"], guest_name: str = NAMES["guest"]) -> DataFrame:
    """``records`` with ``formal``: kind, start, end, start_ts, end_ts, raw_segment_count, speaker_ids, sentence_count, notes and sentences.

    ``raw``: JSON text; ``kind``: the section's kind.  Text that is no object gives
    null.  Sentences are ordered by start, end and speaker; the section's bounds
    are those that are told, widened to its sentences; in all but calls who is
    not known is the host, in calls a guest.
    """
    v = F.col("__v")
    parsed = records.withColumn("__v", F.try_parse_json(raw)).withColumn("__v", F.when(kind_of(F.col("__v")) == "OBJECT", F.col("__v")))
    items, name = _list(v)
    offset = F.when(_has(v, "$.original_start"), seconds(_first(v, "$.original_start"))).otherwise(seconds(_first(v, "$.meta.original_start")))
    told = parsed.withColumns({
        "__items": items, "__name": name, "__offset": offset, "__hosts": _aliases(v, (host_name, *HOST_ALIASES), "host", "hosts", HOST_WORDS, host_name),
        "__guests": _aliases(v, (guest_name, *GUEST_ALIASES), "guest", "guests", GUEST_WORDS, None),
    })
    call = F.coalesce(F.col(kind) == "call", F.lit(False))
    said = told.withColumn("__said", _sentences(F.col("__items"), call, F.col("__hosts"), F.col("__guests"), F.col("__offset"), host_name))

    def bound(keys: tuple[str, ...], inner: str, of_sentences: Column) -> Column:
        paths = [f"{place}.{k}" for place in PLACES for k in keys]
        out = F.when(_has(v, *paths), seconds(_first(v, *paths)))
        return F.coalesce(out, F.when(_at(v, "$.time_range").isNotNull(), seconds(_first(v, f"$.time_range.{inner}"))), of_sentences)

    some = F.size("__said") > 0
    first, last = F.get("__said", F.lit(0)), F.get("__said", F.size("__said") - 1)
    start = F.coalesce(bound(STARTS, "start", F.when(some, F.array_min(F.transform("__said", lambda s: s.start)))), F.lit(0.0))
    end = F.coalesce(bound(ENDS, "end", F.when(some, F.array_max(F.transform("__said", lambda s: s.end)))), start)
    start, end = F.when(some, F.least(start, first.start)).otherwise(start), F.when(some, F.greatest(end, last.end)).otherwise(end)
    bounded = said.withColumns({"__start": F.greatest(start, F.lit(0.0)), "__end": F.greatest(end, start, F.lit(0.0))})
    counted = F.lit(None).cast("long")
    for path in reversed([f"{place}.{k}" for place in PLACES for k in COUNTS]):
        counted = F.when(kind_of(_at(v, path)) == "BIGINT", _at(v, path, "long")).otherwise(counted)
    ids = F.when(call, F.array(F.lit("host"), F.lit("guest"))).otherwise(F.array(F.lit("host")))
    sentences = F.transform("__said", lambda s: F.struct(s.speaker_id.alias("speaker_id"), F.when(s.speaker_id == "host", host_name).otherwise(guest_name).alias("speaker_name"), s.start.alias("start"), s.end.alias("end"), s.text.alias("text")))
    # one column for each field first, so that reading a field of the record works out that field alone
    fields = {
        "kind": F.col(kind), "start": hundredths(F.col("__start")), "end": hundredths(F.col("__end")), "start_ts": clock_hundredths(F.col("__start")), "end_ts": clock_hundredths(F.col("__end")),
        "raw_segment_count": F.coalesce(counted, F.size("__items").cast("long")), "speaker_ids": ids, "sentence_count": F.size("__said").cast("long"),
        "notes": noted(F.lit(None).cast("string"), F.concat(F.lit("repair: from "), "__name", F.lit(" of an older shape"))), "sentences": sentences,
    }
    flat = bounded.select(*records.columns, v.isNotNull().alias("__there"), *[x.alias(f"__f_{name}") for name, x in fields.items()])
    return flat.select(*records.columns, F.when(F.col("__there"), F.struct(*[F.col(f"__f_{name}").alias(name) for name in fields])).alias("formal"))
