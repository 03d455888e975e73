"""Where a bad case comes from, what its trace holds, and the records made of it.

Values count as given when they hold more than white space.  Message lists and
trace parts are JSON text, as they are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGES = "array<struct<role:string,content:string>>"
VERSION = "export_v1"


def given(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def first_given(*values: Column) -> Column:
    return F.coalesce(*[given(v) for v in values])


def source_id(body: Column, trace: Column, live_turn: Column, run: Column, case: Column, trace_id: Column) -> Column:
    """What a bad case points to: what is said, the trace's source, a live turn, a run's case, a case, a trace."""
    both = F.concat(given(run), F.lit(":"), given(case))
    return F.coalesce(given(body), given(trace), given(live_turn), both, given(case), given(trace_id))


def source_type(body: Column, trace: Column, live_turn: Column) -> Column:
    return F.coalesce(given(body), given(trace), F.when(given(live_turn).isNotNull(), "live_turn").otherwise("offline_case"))


def same_suite(suite: Column, left: Column, right: Column) -> tuple[Column, Column]:
    """The suite of a judgment (what is said, else the runs'), and whether both runs are of it."""
    of = F.coalesce(given(suite), given(left), given(right))
    return of, F.coalesce(left == of, F.lit(True)) & F.coalesce(right == of, F.lit(True))


def messages(raw: Column) -> Column:
    """Messages with a role and content, of JSON text; none of anything else."""
    rows = F.coalesce(F.from_json(raw, MESSAGES), F.array().cast(MESSAGES))
    clean = F.transform(F.filter(rows, lambda m: m.isNotNull()), lambda m: F.struct(F.trim(m["role"]).alias("role"), m["content"].alias("content")))
    return F.filter(clean, lambda m: (F.coalesce(m["role"], F.lit("")) != "") & (F.coalesce(m["content"], F.lit("")) != ""))


def first_messages(*raw: Column) -> Column:
    """The first list that is not empty."""
    out = messages(raw[-1])
    for one in reversed(raw[:-1]):
        own = messages(one)
        out = F.when(F.size(own) > 0, own).otherwise(out)
    return out


def trace_output(response: Column, top: Column, raw: Column, clean_record: Column, raw_record: Column) -> Column:
    """A trace's output text: of its response, its own, of its raw output, else the generation's; empty without any."""
    text = lambda c: F.get_json_object(c, "$.output_text")
    return F.coalesce(given(text(response)), given(top), F.nullif(text(raw), F.lit("")), F.nullif(clean_record, F.lit("")), F.nullif(raw_record, F.lit("")), F.lit(""))


def failure_tags(raw: Column) -> Column:
    """Tags of a JSON list, empty ones left out; none of anything else."""
    return F.filter(F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))


def rubric_scores(raw: Column) -> Column:
    """Scores of a JSON object; none of anything else."""
    none = F.create_map().cast("map<string,double>")
    return F.when(F.startswith(F.trim(raw), F.lit("{")), F.coalesce(F.from_json(raw, "map<string,double>"), none)).otherwise(none)


def _id(case: Column, source: Column, suffix: str) -> Column:
    return F.coalesce(given(case), F.concat(F.coalesce(source, F.lit("case")), F.lit(suffix)))


def training_candidate(case_id: Column, source: Column, inputs: Column, output: Column, target: Column, tags: Column, tokens: Column) -> Column:
    return F.struct(
        F.lit("sft_candidate").alias("record_type"), F.lit(VERSION).alias("version"), _id(case_id, source, "_sft").alias("candidate_id"), source.alias("source_id"), inputs.alias("input_messages"),
        output.alias("model_output"), target.alias("edited_target"), tags.alias("failure_tags"), F.coalesce(tokens.try_cast("long"), F.lit(0).cast("long")).alias("prompt_tokens"),
    )


def preference_candidate(case_id: Column, source: Column, context: Column, chosen: Column, rejected: Column) -> Column:
    side = lambda name, by, text: F.struct(F.lit(name).alias("candidate_id"), F.lit(by).alias("provenance"), text.alias("text"))
    return F.struct(
        F.lit("preference_pair_candidate").alias("record_type"), F.lit(VERSION).alias("version"), _id(case_id, source, "_pair").alias("pair_id"), source.alias("source_id"), context.alias("context_messages"),
        side("cand_a", "human", chosen).alias("chosen"), side("cand_b", "model", rejected).alias("rejected"), F.struct(F.lit("chosen").alias("winner"), F.lit("medium").alias("preference_strength")).alias("judgement"),
    )


def live_trace(source: Column, status: Column, request: Column, response: Column, trim: Column, output: Column) -> Column:
    """A row of a live turn's trace from its request and response."""
    num = lambda c, p: F.get_json_object(c, p).try_cast("double")
    return F.struct(
        source.alias("source_id"), F.coalesce(given(status), F.lit("succeeded")).alias("status"), F.get_json_object(request, "$.messages").alias("final_messages"), F.get_json_object(request, "$.generation").alias("generation"),
        num(trim, "$.finalEstimatedPromptTokens").alias("prompt_tokens"), num(response, "$.generated_tokens").alias("generated_tokens"), num(response, "$.latency_ms").alias("latency_ms"),
        F.nullif(F.coalesce(output, F.get_json_object(response, "$.output_text")), F.lit("")).alias("output_text"), F.nullif(F.get_json_object(response, "$.trace_path"), F.lit("")).alias("artifact_path"),
    )


# Whole records, as reviewers' tools read them

CASE = (
    "id", "source_type", "source_id", "case_id", "model_deployment_id", "eval_run_id", "live_session_id", "live_turn_id", "source_slice", "slice", "failure_tags_json", "topic_primary", "difficulty", "reply_type", "notes",
    "runtime_signature", "trace", "source_path", "trace_path", "annotator_id", "reviewer_id", "created_at",
)


def _source(of: Column) -> Column:
    """Where a record is from; ``of`` is the source's id, the case's where it has none."""
    signed = lambda name: given(F.get_json_object("runtime_signature", f"$.{name}")).alias(name)
    return F.struct(
        F.col("source_type"), of.alias("source_id"), given(F.col("model_deployment_id")).alias("model_id"), given(F.col("model_deployment_id")).alias("deployment_id"), given(F.col("eval_run_id")).alias("run_id"),
        given(F.col("live_session_id")).alias("live_session_id"), given(F.col("live_turn_id")).alias("live_turn_id"), given(F.col("case_id")).alias("case_id"),
        first_given(F.col("source_slice"), F.col("slice")).alias("slice"), signed("prompt_version"), signed("context_builder_version"), signed("generation_config_version"),
    )


def _measure(*names: str) -> Column:
    """The first of the trace's numbers that is there; 0 where it is none."""
    x = F.coalesce(*[F.get_json_object("trace", f"$.{n}") for n in names])
    return F.coalesce(x.try_cast("double"), F.lit(0.0))


def whole_records(cases: DataFrame, messages_col: str, output: str, target: str) -> DataFrame:
    """``cases`` with ``sft`` and ``pair``: the training candidate and the preference pair of each, nested as their readers expect.

    cases: CASE, ``messages_col`` (array of role and content), ``output`` (what the
    model said) and ``target`` (what a person wrote).  Blank fields are null; tags
    that are no JSON list are none; a record without an id takes the source's, or
    the word case, with a suffix.
    """
    of = F.coalesce(given(F.col("source_id")), given(F.col("case_id")))
    own = lambda suffix: F.coalesce(given(F.col("id")), F.concat(F.coalesce(of, F.lit("case")), F.lit(suffix)))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    people = [F.col(c) for c in ("annotator_id", "reviewer_id")]
    paths = [F.nullif(F.col(c), F.lit("")).alias(c) for c in ("source_path", "trace_path")]
    tail = [*[F.nullif(c, F.lit("")).alias(n) for c, n in zip(people, ("annotator_id", "reviewer_id"), strict=True)], F.col("created_at"), given(F.col("notes")).alias("notes")]
    sft = F.struct(
        F.lit("sft_candidate").alias("record_type"), F.lit(VERSION).alias("version"), own("_sft").alias("candidate_id"), _source(of).alias("source"), F.col(messages_col).alias("input_messages"),
        text(output).alias("model_output"), text(target).alias("edited_target"),
        F.struct(failure_tags(F.col("failure_tags_json")).alias("failure_tags"), *[given(F.col(c)).alias(c) for c in ("topic_primary", "difficulty", "reply_type")]).alias("labels"),
        F.struct(*paths, _measure("promptTokens", "estimatedPromptTokens").cast("long").alias("prompt_tokens"), _measure("generatedTokens").cast("long").alias("generated_tokens"), _measure("totalLatencyMs", "firstTokenLatencyMs").alias("latency_ms"), *tail).alias("metadata"),
    )
    side = lambda name, by, c: F.struct(F.lit(name).alias("candidate_id"), F.lit(by).alias("provenance"), text(c).alias("text"))
    judged = F.struct(F.lit("chosen").alias("winner"), F.lit("medium").alias("preference_strength"), F.array().cast("array<string>").alias("reason_tags"), F.create_map().cast("map<string,double>").alias("scores"))
    pair = F.struct(
        F.lit("preference_pair_candidate").alias("record_type"), F.lit(VERSION).alias("version"), own("_pair").alias("pair_id"), _source(of).alias("source"), F.col(messages_col).alias("context_messages"),
        side("cand_a", "human", target).alias("chosen"), side("cand_b", "model", output).alias("rejected"), judged.alias("judgement"), F.struct(*paths, *tail).alias("metadata"),
    )
    return cases.withColumns({"sft": sft, "pair": pair})


def as_line(record: str) -> Column:
    """A record as a line of JSON, null fields included."""
    return F.to_json(record, {"ignoreNullFields": "false"})
