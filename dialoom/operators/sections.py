"""Sections of a transcript made again as whole records: what they are about, and their sentences.

A lost section is rebuilt from the first of three sources that has text for it:
its own raw segments, the source transcript between its neighbours, the source
between the bounds of a plan.  What none of them has is refused with a reason
and not guessed.  All joins are equi joins on the file and a time bucket or the
section; windows and arrays stay within a section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions.scalars import clock_hundredths
from dialoom.operators.intervals import overlap_join

KEY = ["file_id", "idx"]
RAW, NEIGHBOURS, PLAN = "raw", "neighbours", "plan"
ROUTES = (RAW, NEIGHBOURS, PLAN)
#: What is added to the notes of a rebuilt section, once.
NOTES = {
    RAW: "rebuild: from raw segments of the section; text kept",
    NEIGHBOURS: "rebuild: from the source between neighbouring sections; text kept",
    PLAN: "rebuild: from the source by the section plan; text kept",
}
NAMES = {"host": "Host", "guest": "Guest"}


def hundredths(x: Column) -> Column:
    """To two places, halves up."""
    return F.floor(x * 100 + 0.5) / 100


def noted(notes: Column, note: Column) -> Column:
    """``notes`` with ``note`` at the end, unless it is there."""
    old = F.coalesce(notes, F.lit(""))
    return F.when(F.contains(old, note), old).otherwise(F.trim(F.concat(old, F.when(old == "", "").otherwise("; "), note)))


def neighbour_bounds(lost: DataFrame, siblings: DataFrame, source: DataFrame) -> DataFrame:
    """``lo`` and ``hi`` of each lost section: the largest end before it and the least start after it, else the source's own."""
    own = lost.select(*KEY, F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"), F.lit(True).alias("own"))
    both = own.unionByName(siblings.select(*KEY, F.col("start").alias("a"), F.col("end").alias("b"), F.lit(False).alias("own")))
    # sections of one index do not bound each other
    before, after = (W.partitionBy("file_id").orderBy(o).rangeBetween(W.unboundedPreceding, -1) for o in (F.col("idx"), F.desc("idx")))
    found = both.withColumns({"lo": F.max("b").over(before), "hi": F.min("a").over(after)}).filter("own")
    ends = source.groupBy("file_id").agg(F.min("start_s").alias("first"), F.max("end_s").alias("last"))
    return found.join(ends, "file_id").select(*KEY, F.coalesce("lo", "first").alias("lo"), F.coalesce("hi", "last").alias("hi"))


def _spoken(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text", F.trim(F.coalesce("text", F.lit("")))).filter("text <> ''")


def _within(bounds: DataFrame, source: DataFrame) -> DataFrame:
    """The source's segments that touch the bounds of each section."""
    rows = source.select("file_id", F.col("seg_idx").alias("pos"), "start_s", "end_s", "speaker", "text")
    return overlap_join(bounds, rows, "file_id", ("lo", "hi"), ("start_s", "end_s"))


def picked(lost: DataFrame, raw: DataFrame, siblings: DataFrame, source: DataFrame, plan: DataFrame) -> DataFrame:
    """Segments with text of each lost section, of the first route that has any: KEY, ``route``, pos, start_s, end_s, speaker, text."""
    source = _spoken(source)
    columns = [*KEY, "pos", "start_s", "end_s", "speaker", "text"]
    by_raw = _spoken(raw).join(lost.select(*KEY), KEY, "left_semi").select(F.lit(0).alias("rank"), *columns)
    near = neighbour_bounds(lost, siblings, source).filter("hi > lo")
    by_near = _within(near, source).select(F.lit(1).alias("rank"), *columns)
    # a plan names sections by title or by file name
    wanted = lost.select(*KEY, F.explode(F.array_distinct(F.array("title", "file_name"))).alias("name")).filter("name is not null")
    names = plan.select("file_id", F.explode(F.array_distinct(F.array("title", "file_name"))).alias("name"), F.col("start").alias("lo"), F.col("end").alias("hi")).filter("name is not null")
    planned = wanted.join(names, ["file_id", "name"]).groupBy(*KEY).agg(F.min(F.struct("lo", "hi")).alias("p")).select(*KEY, "p.lo", "p.hi").filter("hi >= lo")
    by_plan = _within(planned, source).select(F.lit(2).alias("rank"), *columns)
    every = by_raw.unionByName(by_near).unionByName(by_plan)
    best = every.groupBy(*KEY).agg(F.min("rank").alias("rank"))
    routes = F.array(*[F.lit(r) for r in ROUTES])
    return every.join(best, [*KEY, "rank"]).withColumn("route", F.get(routes, F.col("rank"))).drop("rank")


def with_roles(rows: DataFrame, kinds: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rows`` with ``kind`` and ``speaker_id``: the host in all but calls, where the known host speakers are, or else who speaks first."""
    first = rows.groupBy(*KEY).agg(F.min_by("speaker", "pos").alias("first"))
    known = hosts.filter("speaker is not null").groupBy("file_id").agg(F.collect_set("speaker").alias("hosts"))
    said = rows.join(kinds.select(*KEY, "kind"), KEY).join(first, KEY).join(known, "file_id", "left")
    is_host = F.array_contains(F.coalesce("hosts", F.array("first")), F.coalesce("speaker", F.lit("")))
    return said.withColumn("speaker_id", F.when((F.col("kind") != "call") | is_host, "host").otherwise("guest")).drop("first", "hosts")


def merged(rows: DataFrame, gap: float = 0.6) -> DataFrame:
    """Sentences of each section: neighbours of one role no further apart than ``gap`` are one, times to hundredths from 0."""
    begin = hundredths(F.greatest(F.lit(0.0), F.col("start_s")))
    timed = rows.withColumn("begin", begin).withColumn("until", hundredths(F.greatest(F.col("begin"), F.col("end_s"))))
    w = W.partitionBy(*KEY).orderBy("begin", "until", "speaker_id", "pos")
    up_to = w.rowsBetween(W.unboundedPreceding, 0)
    turned = timed.withColumn("turn", F.sum(F.when(F.lag("speaker_id").over(w) == F.col("speaker_id"), 0).otherwise(1)).over(up_to)).withColumn("place", F.row_number().over(w))
    # once a pause is longer than ``gap``, all ends before it lie before the pause
    own = W.partitionBy(*KEY, "turn").orderBy("place")
    reach = F.max("until").over(own.rowsBetween(W.unboundedPreceding, -1))
    parted = turned.withColumn("starts", reach.isNull() | (F.col("begin") - reach > gap + 1e-9))
    numbered = parted.withColumn("sentence", F.sum(F.col("starts").cast("int")).over(W.partitionBy(*KEY).orderBy("place").rowsBetween(W.unboundedPreceding, 0)) - 1)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x.text), "")
    return numbered.groupBy(*KEY, "route", "kind", "sentence").agg(
        F.first("speaker_id").alias("speaker_id"), F.min("begin").alias("start"), F.max("until").alias("end"), F.trim(text).alias("text"), F.count("*").alias("n_raw"),
    )


def rebuilt(lost: DataFrame, raw: DataFrame, siblings: DataFrame, source: DataFrame, plan: DataFrame, hosts: DataFrame) -> DataFrame:
    """One record for each lost section: KEY, ``route``, ``error``, ``meta`` and ``sentences``, both nested.

    lost: file_id, idx, kind, persona, title, file_name, source_file, notes;
    raw: file_id, idx, pos, start_s, end_s, speaker, text; siblings: file_id, idx, start, end;
    source: file_id, seg_idx, start_s, end_s, speaker, text; plan: file_id, title, file_name, start, end;
    hosts: file_id, speaker.  A section without text in any source has the error
    ``no source text``, null meta and sentences.
    """
    said = merged(with_roles(picked(lost, raw, siblings, source, plan), lost, hosts))
    names = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    one = F.struct("sentence", "speaker_id", F.element_at(names, F.col("speaker_id")).alias("speaker_name"), "start", "end", "text")
    whole = said.groupBy(*KEY, "route").agg(F.array_sort(F.collect_list(one)).alias("s"), F.min("start").alias("a"), F.max("end").alias("b"), F.sum("n_raw").alias("n_raw"))
    joined = lost.join(whole, KEY, "left")
    ids = F.when(F.col("kind") == "call", F.array(F.lit("host"), F.lit("guest"))).otherwise(F.array(F.lit("host")))
    note = F.element_at(F.create_map(*[F.lit(x) for pair in NOTES.items() for x in pair]), F.col("route"))
    meta = F.struct(
        "source_file", F.col("idx").alias("index"), "kind", "persona", "title", F.col("a").alias("start"), F.col("b").alias("end"), clock_hundredths(F.col("a")).alias("start_ts"),
        clock_hundredths(F.col("b")).alias("end_ts"), F.col("n_raw").alias("raw_segment_count"), ids.alias("speaker_ids"), F.map_filter(names, lambda k, _: F.array_contains(ids, k)).alias("speaker_names"),
        F.size("s").cast("long").alias("sentence_count"), noted(F.col("notes"), note).alias("notes"),
    )
    there = F.col("route").isNotNull()
    sentences = F.transform("s", lambda x: x.dropFields("sentence"))
    return joined.select(*KEY, "route", F.when(~there, "no source text").alias("error"), F.when(there, meta).alias("meta"), F.when(there, sentences).alias("sentences"))


# Roles from what is known of a section and of its neighbours


def _by_speaker(rows: DataFrame, span: tuple[str, str], source: DataFrame, *by: str) -> DataFrame:
    """Seconds of each speaker of the source under the spans of ``rows``, with the first segment met."""
    units = source.select("file_id", F.col("seg_idx").alias("pos"), F.col("start_s").alias("us"), F.col("end_s").alias("ue"), "speaker")
    met = overlap_join(rows, units, "file_id", span, ("us", "ue")).withColumn("o", F.least("ue", F.col(span[1])) - F.greatest("us", F.col(span[0]))).filter("o > 0")
    return met.groupBy(*KEY, *by, "speaker").agg(F.sum("o").alias("sec"), F.min("pos").alias("pos"))


def _ranked(condition: Column) -> Column:
    """Speakers with their seconds, the longest first, of equals the first met."""
    listed = F.array_sort(F.collect_list(F.when(condition, F.struct((-F.col("sec")).alias("less"), "pos", "speaker", "sec"))))
    return F.transform(listed, lambda x: F.struct(x.speaker.alias("speaker"), x.sec.alias("sec")))


def speaker_sets(sections: DataFrame, sentences: DataFrame, source: DataFrame, hosts: DataFrame) -> DataFrame:
    """Host and guest speakers of each call: KEY, ``hosts``, ``guests``, ``active`` (speaker, seconds, longest first).

    sections: KEY, start, end; sentences (as they are now): KEY, speaker_id, start, end;
    hosts: KEY, speaker (what neighbouring sections say).  Known hosts that speak
    count; else those under the host's sentences (0.8 s and 0.35 of the most).
    The guest is the longest under the guest's sentences that is no host, else the
    longest other speaker.  Without hosts, all that speak 0.8 s and a quarter of
    the longest but the guest are; one speaker alone is the host.
    """
    active = _by_speaker(sections.select(*KEY, F.col("start").alias("lo"), F.col("end").alias("hi")), ("lo", "hi"), source).groupBy(*KEY).agg(_ranked(F.lit(True)).alias("active"))
    under = _by_speaker(sentences.select(*KEY, "speaker_id", F.col("start").alias("lo"), F.col("end").alias("hi")), ("lo", "hi"), source, "speaker_id")
    roles = under.groupBy(*KEY).agg(_ranked(F.col("speaker_id") == "host").alias("as_host"), _ranked(F.col("speaker_id") == "guest").alias("as_guest"))
    known = hosts.groupBy(*KEY).agg(F.array_sort(F.collect_set("speaker")).alias("known"))
    none, pairs = F.array().cast("array<string>"), F.array().cast("array<struct<speaker:string,sec:double>>")
    x = sections.select(*KEY).join(active, KEY, "left").join(roles, KEY, "left").join(known, KEY, "left").select(
        *KEY, *[F.coalesce(c, pairs).alias(c) for c in ("active", "as_host", "as_guest")], F.coalesce("known", none).alias("known")
    ).withColumn("there", F.transform("active", lambda a: a.speaker))
    names = lambda listed: F.transform(listed, lambda a: a.speaker)
    enough = lambda listed, least, share: F.filter(listed, lambda a: a.sec >= F.greatest(F.lit(least), F.get(listed, F.lit(0)).sec * share))
    first = lambda listed: F.slice(listed, 1, 1)
    by_role = F.filter(names(enough(F.col("as_host"), 0.8, 0.35)), lambda s: F.array_contains("there", s))
    x = x.withColumn("h", F.filter("known", lambda s: F.array_contains("there", s))).withColumn("h", F.when(F.size("h") > 0, F.col("h")).otherwise(by_role))
    other = F.exists("there", lambda s: ~F.array_contains("h", s) & (s != "UNKNOWN"))
    said = F.filter("as_guest", lambda a: ~F.array_contains("h", a.speaker) & ~((a.speaker == "UNKNOWN") & other) & (a.sec >= 0.8))
    rest = lambda taken: first(F.array_except("there", taken))
    x = x.withColumn("g", first(names(said))).withColumn("g", F.when(F.size("g") > 0, F.col("g")).otherwise(rest(F.col("h"))))
    left = F.filter("active", lambda a: ~F.array_contains("g", a.speaker))
    lone = F.size(left) == 0
    x = x.withColumns({"h2": F.when(F.size("h") > 0, F.col("h")).when(lone, F.col("g")).otherwise(names(enough(left, 0.8, 0.25))), "g2": F.when((F.size("h") == 0) & lone, none).otherwise(F.col("g"))})
    x = x.withColumn("h3", F.when((F.size("g2") > 0) & (F.size("h2") > 1), F.array_except("h2", "g2")).otherwise(F.col("h2")))
    return x.select(*KEY, F.array_sort("h3").alias("hosts"), F.when(F.size("g2") > 0, F.col("g2")).otherwise(rest(F.col("h3"))).alias("guests"), "active")


def from_source(sections: DataFrame, sets: DataFrame, source: DataFrame, gap: float = 0.8, longest: int = 140) -> DataFrame:
    """Sentences of each section from the source by its speaker sets: KEY and ``sentences`` (speaker_id, start, end, text).

    sections: KEY, kind, start, end.  Bounds given the wrong way round are turned,
    and spans under 0.2 s widened.  In openings and comments only hosts are heard;
    in calls a speaker in neither set is left out under 1 s and under 12 % of the
    guest's time.  Neighbours of one role are one sentence while the gap is at most
    ``gap`` and the text at most ``longest``: a fold over the section's segments.
    """
    lo, hi = F.least("start", "end"), F.greatest("start", "end")
    narrow = hi - lo < 0.2
    wide = sections.select(*KEY, "kind", F.when(narrow, lo - 1).otherwise(lo).alias("lo"), F.when(narrow, hi + 3).otherwise(hi).alias("hi"))
    # durations over the bounds as they are used here
    active = _by_speaker(wide, ("lo", "hi"), source).groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("speaker", "sec"))).alias("sec_of"))
    rows = _within(wide, _spoken(source)).join(sets.select(*KEY, "hosts", "guests"), KEY).join(active, KEY, "left")
    sec = lambda s: F.coalesce(F.try_element_at("sec_of", s), F.lit(0.0))
    main = F.aggregate("guests", F.lit(0.0), lambda most, s: F.greatest(most, sec(s)))
    is_host, is_guest, call = F.array_contains("hosts", F.col("speaker")), F.array_contains("guests", F.col("speaker")), F.col("kind") == "call"
    minor = ~is_host & ~is_guest & (F.size("guests") > 0) & (sec(F.col("speaker")) < F.greatest(F.lit(1.0), main * 0.12))
    heard = rows.filter(F.when(call, ~minor).otherwise(is_host)).withColumn("role", F.when(~call | is_host, "host").otherwise("guest"))
    unit = F.struct("pos", F.col("role").alias("speaker_id"), F.col("start_s").alias("start"), F.col("end_s").alias("end"), "text")
    ordered = heard.groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(unit)), lambda u: u.dropFields("pos")).alias("units"))

    def joined(said: Column, u: Column) -> Column:
        last = F.try_element_at(said, F.lit(-1))
        fits = (F.size(said) > 0) & (last.speaker_id == u.speaker_id) & (u.start - last.end <= gap)
        fits = fits & (F.length(last.text) + F.length(u.text) <= longest)
        both = F.struct(last.speaker_id.alias("speaker_id"), last.start.alias("start"), F.greatest(last.end, u.end).alias("end"), F.concat(last.text, u.text).alias("text"))
        return F.when(fits, F.concat(F.slice(said, 1, F.size(said) - 1), F.array(both))).otherwise(F.concat(said, F.array(u)))

    empty = F.array().cast("array<struct<speaker_id:string,start:double,end:double,text:string>>")
    return ordered.select(*KEY, F.aggregate("units", empty, joined).alias("sentences"))
