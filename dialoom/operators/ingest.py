"""Generation records joined with their trace artifacts, field by field in order of precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.operators.validation import NUMBERS, kind_of


def _object(v: Column, path: str) -> Column:
    """The JSON text of an object at ``path``; null for anything else."""
    x = F.try_variant_get(v, path, "variant")
    return F.when(kind_of(x) == "OBJECT", F.to_json(x))


def _said(v: Column, path: str) -> Column:
    """A text at ``path`` that is not empty."""
    x = F.try_variant_get(v, path, "variant")
    return F.nullif(F.when(kind_of(x) == "STRING", F.try_variant_get(x, "$", "string")), F.lit(""))


def _whole(v: Column, path: str) -> Column:
    """A whole number at ``path``, 0 included."""
    x = F.try_variant_get(v, path, "variant")
    number = F.when(kind_of(x).isin(*NUMBERS), F.try_variant_get(x, "$", "double"))
    return F.when(number % 1 == 0, number.cast("long"))


def with_traces(records: DataFrame, traces: DataFrame, by: str = "case_id") -> DataFrame:
    """``records`` as rows of a run, with what their traces know better.

    records: ``by``, runtime_signature, messages, generation (JSON texts),
    clean_output, raw_output, prompt_tokens, generated_tokens, latency_ms,
    trace_path; traces: ``by``, ``trace`` (JSON text), of which one of a key is
    taken if there are several.

    A trace's messages count if they are a list, empty or not; its generation and
    signature if they are objects; its output and path if they are not empty; its
    numbers if they are whole, 0 included.  An empty clean output falls back to
    the raw one.  What no object is, or has no trace, is as without one, and
    ``missing_trace`` says so.
    """
    one = traces.groupBy(by).agg(F.min("trace").alias("trace"))
    v = F.col("__v")
    x = records.join(one, by, "left").withColumn("__v", F.try_parse_json("trace")).withColumn("__v", F.when(kind_of(v) == "OBJECT", v))
    messages = F.try_variant_get(v, "$.request.messages", "variant")
    built = F.to_json(F.struct(
        F.col("raw_output").alias("raw_output_text"), F.col("clean_output").alias("clean_output_text"), "generated_tokens", "prompt_tokens", "latency_ms"), {"ignoreNullFields": "false"})
    return x.select(
        by, F.coalesce(_object(v, "$.runtime_signature"), F.col("runtime_signature")).alias("runtime_signature"),
        F.when(kind_of(messages) == "ARRAY", F.to_json(messages)).otherwise(F.col("messages")).alias("messages"),
        F.coalesce(_object(v, "$.request.generation"), F.col("generation")).alias("generation"), _object(v, "$.request.trace_meta").alias("trace_meta"),
        F.coalesce(_said(v, "$.response.clean_output_text"), F.nullif("clean_output", F.lit("")), F.col("raw_output")).alias("output_text"),
        F.coalesce(_object(v, "$.response"), built).alias("raw_output_json"),
        F.coalesce(_whole(v, "$.metrics.prompt_tokens"), F.col("prompt_tokens")).alias("prompt_tokens"), F.coalesce(_whole(v, "$.metrics.generated_tokens"), F.col("generated_tokens")).alias("generated_tokens"),
        F.coalesce(_whole(v, "$.metrics.latency_ms"), F.col("latency_ms")).alias("latency_ms"), F.coalesce(_said(v, "$.artifacts.trace_path"), F.nullif("trace_path", F.lit(""))).alias("trace_path"),
        v.isNull().alias("missing_trace"),
    )
