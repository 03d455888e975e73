"""Checks of formal section files, and reasons to reject a section as a conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.operators import qc, validation

SLACK = 1e-6
ISSUES = "array<struct<severity:string,code:string,path:string>>"


def _issue(when: Column, severity: str, code: str, path: Column | str) -> Column:
    at = F.lit(path) if isinstance(path, str) else path
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), at.alias("path")))


def _number(v: Column, path: str) -> Column:
    """The number at ``path``; null where there is none or where it is of another type."""
    x = F.try_variant_get(v, path, "variant")
    return F.when(validation.kind_of(x).isin(*validation.NUMBERS), F.try_variant_get(x, "$", "double"))


def checked(files: DataFrame, raw: str, schema: dict | None = None) -> DataFrame:
    """``files`` with ``issues`` (severity, code, path) and ``status`` of the JSON text ``raw``.

    Text that is no JSON fails; what is no object with ``meta`` and ``sentences``
    is skipped; else counts, times and texts are checked, sentence by sentence in
    the row, and the ``schema`` if one is given.  Fields of other types are the
    schema's matter and nothing here.
    """
    v = F.col("__v")
    x = files.withColumn("__v", F.try_parse_json(raw))
    is_list = validation.kind_of(F.try_variant_get(v, "$.sentences", "variant")) == "ARRAY"
    has_meta = validation.kind_of(F.try_variant_get(v, "$.meta", "variant")) == "OBJECT"
    applies = F.try_variant_get(v, "$.meta", "variant").isNotNull() & F.try_variant_get(v, "$.sentences", "variant").isNotNull()
    count = F.try_variant_get(v, "$.meta.sentence_count", "variant")
    x = x.withColumns({
        "__applies": F.coalesce(applies, F.lit(False)), "__checks": F.coalesce(is_list & has_meta, F.lit(False)), "__s": F.try_variant_get(v, "$.sentences", "array<variant>"),
        "__a": _number(v, "$.meta.start"), "__b": _number(v, "$.meta.end"), "__n": F.when(validation.kind_of(count) == "BIGINT", F.try_variant_get(count, "$", "long")),
    })

    def of(s: Column, i: Column) -> Column:
        at = F.concat(F.lit("$.sentences["), i.cast("string"), F.lit("]"))
        start, end = _number(s, "$.start"), _number(s, "$.end")
        text = F.try_variant_get(s, "$.text", "variant")
        blank = (validation.kind_of(text) == "STRING") & (F.regexp_replace(F.try_variant_get(text, "$", "string"), r"\s", "") == "")
        outside = F.col("__b").isNotNull() & ((start < F.col("__a") - SLACK) | (end > F.col("__b") + SLACK)) & F.col("__a").isNotNull() & start.isNotNull() & end.isNotNull()
        whole = F.array_compact(F.array(
            _issue(start > end, "error", "sentence_time_reversed", at), _issue(outside, "warning", "sentence_outside_section", at), _issue(blank, "warning", "empty_sentence_text", F.concat(at, F.lit(".text"))),
        ))
        return F.when(validation.kind_of(s) == "OBJECT", whole).otherwise(F.array(_issue(F.lit(True), "error", "sentence_not_object", at)))

    section = F.array_compact(F.array(
        _issue(F.col("__n") != F.size("__s"), "error", "sentence_count_mismatch", "$.meta.sentence_count"), _issue(F.col("__a") > F.col("__b"), "error", "section_time_reversed", "$.meta"),
    ))
    none = F.array().cast(ISSUES)
    found = F.when(F.col("__checks"), F.concat(section, F.flatten(F.transform("__s", of)))).otherwise(none)
    if schema:
        shape = F.transform(validation.issues(schema, v, F.lit("$")), lambda i: F.struct(F.lit("error").alias("severity"), F.lit("schema_validation_error").alias("code"), i.path.alias("path")))
        found = F.concat(F.when(F.col("__applies"), shape).otherwise(none), found)
    load = F.array(F.struct(F.lit("error").alias("severity"), F.lit("json_load_error").alias("code"), F.lit("$").alias("path")))
    x = x.withColumn("issues", F.when(v.isNull(), load).otherwise(found))
    return x.withColumn("status", qc.status_of(F.col("issues"), F.col("__applies") | v.isNull())).select(*files.columns, "issues", "status")


def rejected(sections: DataFrame, sentences: DataFrame, by: list[str], least_turns: int = 4, preview: int = 8, roles: int = 12) -> DataFrame:
    """``by``, ``reason_codes`` and what is told of each section that does not make a conversation.

    sentences: ``by``, pos, speaker_id, start, end, text.  Neighbouring sentences
    of the host or of the guest are one turn; sentences of others are in no turn.
    Reasons, in this order: empty_sentences, no_host_sentences, no_guest_sentences,
    unexpected_speaker_id, turn_count_lt_N, no_targetable_persona_turn (the host
    after a guest), empty_turn_text.
    """
    own = sentences.withColumn("text", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")))
    who = F.col("speaker_id")
    counts = own.groupBy(*by).agg(
        F.count("*").alias("sentence_count"), F.count_if(who == "host").alias("host_sentence_count"), F.count_if(who == "guest").alias("guest_sentence_count"),
        F.count_if(who.isNotNull() & ~who.isin("host", "guest")).alias("others"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("pos") < preview, F.struct("pos", "speaker_id", "start", "end", "text")))), lambda s: s.dropFields("pos")).alias("preview_sentences"),
    )
    w = W.partitionBy(*by).orderBy("pos")
    said = own.filter(who.isin("host", "guest")).withColumn("before", F.lag("speaker_id").over(w))
    said = said.withColumn("turn", F.sum(F.when(F.col("before").eqNullSafe(F.col("speaker_id")), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)) - 1)
    turns = said.groupBy(*by, "turn").agg(F.first("speaker_id").alias("speaker_id"), F.bool_and(F.col("text") == "").alias("empty"))
    role = F.when(F.col("speaker_id") == "host", "persona").otherwise("user")
    # turns alternate, so a host's turn that is not the first follows a guest's
    of = turns.groupBy(*by).agg(
        F.count("*").alias("merged_turn_count"), F.bool_or((F.col("speaker_id") == "host") & (F.col("turn") > 0)).alias("targetable"), F.bool_or("empty").alias("empty"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("turn") < roles, F.struct("turn", role.alias("role"))))), lambda t: t.role).alias("merged_role_sequence"),
    )
    x = sections.select(*by).join(counts, by, "left").join(of, by, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    made = [
        ("empty_sentences", zero("sentence_count") == 0), ("no_host_sentences", zero("host_sentence_count") == 0), ("no_guest_sentences", zero("guest_sentence_count") == 0),
        ("unexpected_speaker_id", zero("others") > 0), (f"turn_count_lt_{least_turns}", zero("merged_turn_count") < least_turns),
        ("no_targetable_persona_turn", ~F.coalesce("targetable", F.lit(False))), ("empty_turn_text", F.coalesce("empty", F.lit(False))),
    ]
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("sentence_count", "merged_turn_count", "host_sentence_count", "guest_sentence_count")]
    reasons = F.array_compact(F.array(*[F.when(when, code) for code, when in made]))
    return x.select(*by, reasons.alias("reason_codes"), *numbers, F.coalesce("merged_role_sequence", F.array().cast("array<string>")).alias("merged_role_sequence"), "preview_sentences").filter(F.size("reason_codes") > 0)
