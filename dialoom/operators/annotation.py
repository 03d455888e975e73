"""Validation of annotation records kept as JSON lines.

Five kinds of records share a shape: an audit stamp, a source, and turns under
a name of their own.  Structure is read by a schema; rules of records and of
turns run in the record's row, without windows or shuffles.  A file with a line
that is no JSON fails as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.operators import qc, validation

#: The kinds of records, and the field that holds the turns of each.
KINDS = {"conversation": "turns", "turn_sft": "history", "style_label": None, "preference_pair": "context", "benchmark_case": "messages"}
TURN = "array<struct<turn_index:bigint,role:string,speaker_id:string,start:double,end:double>>"
SCHEMA = (
    "record_type string, audit struct<created_at:string,updated_at:string>, category string, evidence array<string>,"
    "source struct<start:double,end:double,turn_index:bigint,target_start:double,target_end:double>,"
    f"turns {TURN}, history {TURN}, context {TURN}, messages {TURN}, target_reply struct<turn_index:bigint,start:double,end:double>,"
    "labels struct<style_tone_primary:string,style_tone_secondary:array<string>>,"
    "chosen_reply struct<candidate_id:string,text:string>, rejected_reply struct<candidate_id:string,text:string>"
)
SLACK = 1e-6


def _off(a: Column, b: Column) -> Column:
    return F.abs(a - b) > SLACK


def record_rules() -> list[qc.Rule]:
    """Rules on whole records, each for its kind."""
    of = lambda kind, when: (F.col("r.record_type") == kind) & when
    last = lambda turns: F.try_element_at(F.col(f"r.{turns}"), F.lit(-1))["role"]
    reply, source = F.col("r.target_reply"), F.col("r.source")
    differ = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    return [
        qc.Rule("audit_time_reversed", F.col("r.audit.updated_at").try_cast("timestamp_ntz") < F.col("r.audit.created_at").try_cast("timestamp_ntz"), path="$.audit"),
        qc.Rule("history_must_end_with_user", of("turn_sft", last("history") != "user"), path="$.history"),
        qc.Rule("target_time_reversed", of("turn_sft", reply["start"] > reply["end"]), path="$.target_reply"),
        qc.Rule("target_turn_index_mismatch", of("turn_sft", differ("r.target_reply.turn_index", "r.source.turn_index")), path="$.target_reply.turn_index"),
        qc.Rule("target_start_mismatch", of("turn_sft", _off(reply["start"], source["target_start"])), path="$.target_reply.start"),
        qc.Rule("target_end_mismatch", of("turn_sft", _off(reply["end"], source["target_end"])), path="$.target_reply.end"),
        qc.Rule("missing_evidence", of("style_label", F.coalesce(F.size("r.evidence"), F.lit(0)) < 1), "warning", "$.evidence"),
        qc.Rule("duplicate_primary_secondary_style", of("style_label", F.array_contains("r.labels.style_tone_secondary", F.col("r.labels.style_tone_primary"))), "warning", "$.labels"),
        qc.Rule("context_must_end_with_user", of("preference_pair", last("context") != "user"), path="$.context"),
        qc.Rule("duplicate_candidate_id", of("preference_pair", ~differ("r.chosen_reply.candidate_id", "r.rejected_reply.candidate_id"))),
        qc.Rule("duplicate_candidate_text", of("preference_pair", ~differ("r.chosen_reply.text", "r.rejected_reply.text"))),
        qc.Rule("too_few_messages_for_multiturn", of("benchmark_case", (F.col("r.category") == "multi_turn_followup") & (F.coalesce(F.size("r.messages"), F.lit(0)) < 3)), "warning", "$.messages"),
    ]


def _turn_rules(turns: Column, base: Column, lead: str, section: Column) -> Column:
    """Issues of a record's turns: their sequence, speakers and times, and for conversations whether they lie in the section."""
    # for each turn the last end that is known before it
    ended = F.aggregate(turns, F.array(F.lit(None).cast("double")), lambda e, t: F.concat(e, F.array(F.coalesce(t.end, F.element_at(e, -1)))))
    is_section = F.col("r.record_type") == "conversation"

    def of(t: Column, i: Column) -> Column:
        at = F.concat(base, F.lit("["), i.cast("string"), F.lit("]"))
        says = lambda role, speaker: (t.role == role) & ~t.speaker_id.eqNullSafe(speaker)
        before = F.get(turns, i - 1)
        return F.array_compact(F.array(
            _issue(~t.turn_index.eqNullSafe(i), "turn_index_not_sequential", F.concat(at, F.lit(".turn_index"))),
            _issue(says(lead, "host") | says("user", "guest"), "role_speaker_mismatch", at),
            _issue(t.start > t.end, "turn_time_reversed", at),
            _issue((i > 0) & (before.role == t.role), "adjacent_same_role_turns", at),
            _issue(t.start < F.get(ended, i) - SLACK, "turn_time_overlap", at, "warning"),
            _issue(is_section & (t.start < section.start - SLACK), "turn_outside_section", at, "warning"),
            _issue(is_section & (t.end > section.end + SLACK), "turn_outside_section", at, "warning"),
        ))

    return F.flatten(F.transform(turns, of))


def _message_rules(messages: Column) -> Column:
    def of(t: Column, i: Column) -> Column:
        at = F.concat(F.lit("$.messages["), i.cast("string"), F.lit("].turn_index"))
        return F.array_compact(F.array(
            _issue(~t.turn_index.eqNullSafe(i), "message_turn_index_not_sequential", at),
            _issue((i > 0) & (t.turn_index <= F.get(messages, i - 1).turn_index), "message_turn_index_not_increasing", at),
        ))

    return F.flatten(F.transform(messages, of))


def _issue(when: Column, code: str, path: Column, severity: str = "error") -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), path.alias("path")))


def issues(lines: DataFrame, lead: str = "lead", schemas: dict[str, dict] | None = None) -> DataFrame:
    """``file``, ``line``, ``severity``, ``code`` and ``path`` of all issues of ``lines`` (file, line, raw).

    ``lead``: the role whose turns the host speaks; ``schemas``: a JSON Schema for
    each kind, whose issues have the code ``schema_validation_error``.  A file with
    a line that is no JSON has one issue, on line 0, and its other lines are not
    looked at.  Records are parsed once and judged in their own row.
    """
    raw = lines.filter(F.trim("raw") != "").withColumn("__bad", F.try_parse_json("raw").isNull())
    failed = raw.groupBy("file").agg(F.bool_or("__bad").alias("__bad")).filter("__bad").select("file")
    columns = ["file", "line", "severity", "code", "path"]
    load = failed.select("file", F.lit(0).cast("long").alias("line"), F.lit("error").alias("severity"), F.lit("json_load_error").alias("code"), F.lit("$").alias("path"))
    good = raw.join(failed, "file", "left_anti").select("file", F.col("line").cast("long").alias("line"), "raw", F.from_json("raw", SCHEMA).alias("r"), F.trim("raw").startswith("{").alias("object"))
    kind, none = F.col("r.record_type"), F.array().cast("array<struct<severity:string,code:string,path:string>>")
    rules = [
        qc.Rule("record_not_object", ~F.col("object")),
        qc.Rule("unknown_record_type", F.col("object") & ~F.coalesce(kind.isin(*KINDS), F.lit(False)), path="$.record_type"),
        *record_rules(),
    ]
    turned = {k: field for k, field in KINDS.items() if field and k != "benchmark_case"}
    turns, base = F.lit(None).cast(TURN), F.lit(None).cast("string")
    for name, field in turned.items():
        turns, base = F.when(kind == name, F.col(f"r.{field}")).otherwise(turns), F.when(kind == name, f"$.{field}").otherwise(base)
    judged = qc.evaluated(good, rules).withColumns({"turns": turns, "base": base}).withColumn("turn_issues", _turn_rules(F.col("turns"), F.col("base"), lead, F.col("r.source")))
    found = [F.col("issues"), F.coalesce("turn_issues", none), F.when(kind == "benchmark_case", F.coalesce(_message_rules(F.col("r.messages")), none)).otherwise(none)]
    if schemas:
        judged = validation.validated(judged, "raw", schemas)
        found.append(F.transform("schema_issues", lambda x: F.struct(F.lit("error").alias("severity"), F.lit("schema_validation_error").alias("code"), x.path.alias("path"))))
    own = judged.select("file", "line", qc.outer(F.concat(*found))).filter("i is not null").select("file", "line", "i.severity", "i.code", "i.path")
    return load.unionByName(own.select(columns))


def statuses(lines: DataFrame, found: DataFrame) -> DataFrame:
    """``file``, ``line`` and ``status`` of each record, or of line 0 of a file that fails as a whole."""
    failed = found.filter("code = 'json_load_error'").select("file")
    own = lines.filter(F.trim("raw") != "").select("file", F.col("line").cast("long").alias("line")).join(failed, "file", "left_anti")
    every = own.unionByName(failed.select("file", F.lit(0).cast("long").alias("line")))
    by = found.groupBy("file", "line").agg(F.bool_or(F.col("severity") == "error").alias("e"))
    return every.join(by, ["file", "line"], "left").select("file", "line", F.when(F.col("e"), "fail").when(F.col("e").isNotNull(), "warn").otherwise("pass").alias("status"))
