"""Annotation records: the rules of each kind, files that fail, and schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.operators import annotation, qc, validation
from dialoom.plans.base import query
from dialoom.sources.tables import table

#: Turns with faults of every kind; a conversation is a record, made into JSON and read again.
TURNS_SQL = """WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, turn + CASE WHEN conv_id % 7 = 0 AND turn > 2 THEN 1 WHEN conv_id % 11 = 3 AND turn = 3 THEN -1 ELSE 0 END AS turn_index,
CASE WHEN (conv_id + turn) % 11 = 0 THEN 'user' WHEN role = 'assistant' THEN 'lead' ELSE role END AS role, CASE WHEN (conv_id + 3 * turn) % 13 = 0 THEN 'guest' WHEN role = 'assistant' THEN 'host' ELSE 'guest' END AS speaker_id,
turn * 10.0 AS s, turn * 10.0 + 8 + CASE WHEN (conv_id + turn) % 5 = 0 THEN 4 WHEN (conv_id * turn) % 17 = 16 THEN -9 ELSE 0 END AS e FROM conversations WHERE role <> 'system'),
n AS (SELECT conv_id AS c, count(*) AS n, arg_max(role, pos) AS last_role FROM t GROUP BY conv_id),
i AS (SELECT *, lag(role) OVER w AS before, lag(e) OVER w AS ended, lag(turn_index) OVER w AS last_index FROM t JOIN n ON c = conv_id WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
seq AS (SELECT *, unnest([CASE WHEN turn_index <> pos THEN 'turn_index_not_sequential' END, CASE WHEN (role = 'lead' AND speaker_id <> 'host') OR (role = 'user' AND speaker_id <> 'guest') THEN 'role_speaker_mismatch' END,
CASE WHEN s > e THEN 'turn_time_reversed' END, CASE WHEN before = role THEN 'adjacent_same_role_turns' END, CASE WHEN s < ended - 1e-6 THEN 'turn_time_overlap' END]) AS code FROM i),
audit AS (SELECT c, 'error' AS severity, 'audit_time_reversed' AS code, '$.audit' AS path FROM n WHERE c % 9 = 0 AND c % 10 <> 1)
"""


def _sequence(name: str) -> str:
    return f"SELECT conv_id AS line, CASE WHEN code = 'turn_time_overlap' THEN 'warning' ELSE 'error' END AS severity, code, '$.{name}[' || pos || ']' || CASE WHEN code = 'turn_index_not_sequential' THEN '.turn_index' ELSE '' END AS path FROM seq WHERE code IS NOT NULL"


def _when(*rules: tuple[str, str, str, str]) -> str:
    return " ".join(f"UNION ALL SELECT c, '{severity}', '{code}', '{path}' FROM n WHERE {when}" for severity, code, path, when in rules)


AUDIT = " UNION ALL SELECT * FROM audit "
KIND_SQL = {
    "conversation": TURNS_SQL + _sequence("turns") + AUDIT + """UNION ALL SELECT conv_id, 'warning', 'turn_outside_section', '$.turns[' || pos || ']' FROM i WHERE s < (c % 3) * 5.0 - 1e-6
UNION ALL SELECT conv_id, 'warning', 'turn_outside_section', '$.turns[' || pos || ']' FROM i WHERE e > n * 10.0 - 3 + 1e-6""",
    "turn_sft": TURNS_SQL + _sequence("history") + AUDIT + _when(
        ("error", "history_must_end_with_user", "$.history", "last_role <> 'user'"), ("error", "target_time_reversed", "$.target_reply", "c % 6 = 0"),
        ("error", "target_turn_index_mismatch", "$.target_reply.turn_index", "c % 8 = 0"), ("error", "target_start_mismatch", "$.target_reply.start", "c % 7 = 0"), ("error", "target_end_mismatch", "$.target_reply.end", "c % 5 = 0")),
    "style_label": TURNS_SQL + "SELECT c AS line, severity, code, path FROM audit " + _when(
        ("warning", "missing_evidence", "$.evidence", "c % 3 = 0"), ("warning", "duplicate_primary_secondary_style", "$.labels", "c % 4 = 0")),
    "preference_pair": TURNS_SQL + _sequence("context") + AUDIT + _when(
        ("error", "context_must_end_with_user", "$.context", "last_role <> 'user'"), ("error", "duplicate_candidate_id", "$", "c % 4 = 1"), ("error", "duplicate_candidate_text", "$", "c % 6 = 2")),
    "benchmark_case": TURNS_SQL + "SELECT c AS line, severity, code, path FROM audit " + _when(("warning", "too_few_messages_for_multiturn", "$.messages", "c % 2 = 0 AND n < 3")) + """
UNION ALL SELECT conv_id, 'error', 'message_turn_index_not_sequential', '$.messages[' || pos || '].turn_index' FROM i WHERE turn_index <> pos
UNION ALL SELECT conv_id, 'error', 'message_turn_index_not_increasing', '$.messages[' || pos || '].turn_index' FROM i WHERE turn_index <= last_index""",
}


def _records(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """One JSON line for each conversation: file, line (its id) and raw."""
    c, turn, role = F.col("conv_id"), F.col("turn"), F.col("role")
    lead = role == "assistant"
    bent = F.when((c + turn) % 5 == 0, 4).when((c * turn) % 17 == 16, -9).otherwise(0)
    t = table(spark, d, "conversations").filter("role <> 'system'").select(
        c, turn, F.struct(
            (turn + F.when((c % 7 == 0) & (turn > 2), 1).when((c % 11 == 3) & (turn == 3), -1).otherwise(0)).alias("turn_index"),
            F.when((c + turn) % 11 == 0, "user").when(lead, "lead").otherwise(role).alias("role"), F.when((c + 3 * turn) % 13 == 0, "guest").when(lead, "host").otherwise("guest").alias("speaker_id"),
            (turn * 10.0).alias("start"), (turn * 10.0 + 8 + bent).alias("end"),
        ).alias("t"))
    r = t.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"]).alias("turns")).withColumn("n", F.size("turns"))
    n, end = F.col("n"), F.col("n") * 10.0 + F.when(c % 6 == 0, -1.0).otherwise(5.0)
    text = F.concat(F.lit("x"), c.cast("string"))
    audit = F.struct(F.lit("2024-01-02T00:00:00").alias("created_at"), F.when(c % 10 == 1, "bad").when(c % 9 == 0, "2024-01-01T00:00:00").otherwise("2024-01-03T00:00:00").alias("updated_at"))
    own: dict[str, dict[str, Column]] = {
        "conversation": {"source": F.struct(((c % 3) * 5.0).alias("start"), (n * 10.0 - 3).alias("end"))},
        "turn_sft": {
            "target_reply": F.struct(n.alias("turn_index"), (n * 10.0).alias("start"), end.alias("end")),
            "source": F.struct((n + F.when(c % 8 == 0, 1).otherwise(0)).alias("turn_index"), (n * 10.0 + F.when(c % 7 == 0, 0.5).otherwise(0.0)).alias("target_start"), (end + F.when(c % 5 == 0, 1.0).otherwise(0.0)).alias("target_end")),
        },
        "style_label": {
            "evidence": F.when(c % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("x"))),
            "labels": F.struct(F.lit("calm").alias("style_tone_primary"), F.when(c % 4 == 0, F.array(F.lit("calm"), F.lit("dry"))).otherwise(F.array(F.lit("dry"))).alias("style_tone_secondary")),
        },
        "preference_pair": {
            "chosen_reply": F.struct(F.lit("a").alias("candidate_id"), text.alias("text")),
            "rejected_reply": F.struct(F.when(c % 4 == 1, "a").otherwise("b").alias("candidate_id"), F.when(c % 6 == 2, text).otherwise("y").alias("text")),
        },
        "benchmark_case": {"category": F.when(c % 2 == 0, "multi_turn_followup").otherwise("single")},
    }
    fields = own[kind] | ({annotation.KINDS[kind]: F.col("turns")} if annotation.KINDS[kind] else {})
    raw = F.to_json(F.struct(F.lit(kind).alias("record_type"), audit.alias("audit"), *[v.alias(k) for k, v in fields.items()]))
    return r.select(F.lit(f"{kind}.jsonl").alias("file"), c.alias("line"), raw.alias("raw"))


def _enter(kind: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return annotation.issues(_records(spark, d, kind)).select("line", "severity", "code", "path")

    run.__name__ = f"annotation_{kind}_issues"
    query(KIND_SQL[kind])(run)


for _kind in annotation.KINDS:
    _enter(_kind)


@query(f"""SELECT line, CASE WHEN bool_or(severity = 'error') THEN 'fail' WHEN count(severity) > 0 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT DISTINCT conv_id AS line FROM conversations WHERE role <> 'system') LEFT JOIN ({KIND_SQL["style_label"]}) USING (line) GROUP BY line""")
def annotation_status(spark: SparkSession, d: str) -> DataFrame:
    lines = _records(spark, d, "style_label")
    return annotation.statuses(lines, annotation.issues(lines)).select("line", "status")


@query("""WITH l AS (SELECT doc_id % 50 AS f, doc_id, CASE WHEN doc_id % 50 = 7 AND doc_id % 3 = 0 THEN 'bad' WHEN doc_id % 11 = 0 THEN 'list' WHEN doc_id % 13 = 0 THEN 'odd' ELSE 'ok' END AS k FROM documents),
b AS (SELECT f FROM l GROUP BY f HAVING bool_or(k = 'bad'))
SELECT f AS file, 0 AS line, 'json_load_error' AS code FROM b
UNION ALL SELECT f, doc_id, CASE k WHEN 'list' THEN 'record_not_object' ELSE 'unknown_record_type' END FROM l WHERE k IN ('list', 'odd') AND f NOT IN (SELECT f FROM b)""")
def annotation_load_issues(spark: SparkSession, d: str) -> DataFrame:
    """Files of lines of which some are no JSON, no object, or of no known kind."""
    i = F.col("doc_id")
    raw = F.when((i % 50 == 7) & (i % 3 == 0), '{"record_type": ').when(i % 11 == 0, "[1]").when(i % 13 == 0, '{"record_type": "other"}').otherwise('{"record_type": "style_label", "evidence": ["x"]}')
    lines = table(spark, d, "documents").select((i % 50).alias("file"), i.alias("line"), raw.alias("raw"))
    return annotation.issues(lines).select("file", "line", "code")


SCHEMA = {
    "type": "object", "required": ["id", "lang", "size"], "additionalProperties": False,
    "$defs": {"code": {"type": "string", "pattern": "^[a-z]{2}$"}},
    "properties": {
        "id": {"type": "integer", "minimum": 0}, "lang": {"$ref": "#/$defs/code", "enum": ["en", "de", "fr", "es"]}, "size": {"type": "object", "required": ["chars"], "properties": {"chars": {"type": "integer", "maximum": 5000}}},
        "tags": {"type": "array", "minItems": 1, "uniqueItems": True}, "kind": {"const": "document"},
    },
}


@query("""SELECT doc_id, unnest(list_filter([CASE WHEN doc_id % 7 = 0 THEN '$.lang: required' END, CASE WHEN doc_id % 10 = 3 THEN '$: additionalProperties' END, CASE WHEN doc_id % 5 = 0 THEN '$.id: minimum' END, CASE WHEN doc_id % 7 <> 0 AND doc_id % 6 = 1 THEN '$.lang: pattern' END, CASE WHEN doc_id % 7 <> 0 AND doc_id % 6 = 1 THEN '$.lang: enum' END,
CASE WHEN doc_id % 9 = 0 THEN '$.size.chars: required' END, CASE WHEN doc_id % 9 <> 0 AND n_chars > 5000 THEN '$.size.chars: maximum' END, CASE WHEN doc_id % 4 = 0 THEN '$.tags: minItems' END, CASE WHEN doc_id % 4 = 1 THEN '$.tags: uniqueItems' END, CASE WHEN doc_id % 8 = 5 THEN '$.kind: const' END], lambda x: x IS NOT NULL)) AS path FROM documents""")
def schema_issues(spark: SparkSession, d: str) -> DataFrame:
    """Documents as JSON against a schema with references, patterns and closed properties."""
    i = F.col("doc_id")
    raw = F.to_json(F.struct(
        F.when(i % 5 == 0, -1 - i).otherwise(i).alias("id"), F.when(i % 7 == 0, None).when(i % 6 == 1, "EN").otherwise(F.col("lang")).alias("lang"),
        F.struct(F.when(i % 9 != 0, F.col("n_chars")).alias("chars")).alias("size"),
        F.when(i % 4 == 0, F.array().cast("array<string>")).when(i % 4 == 1, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a"))).alias("tags"),
        F.when(i % 8 == 5, "page").otherwise("document").alias("kind"), F.when(i % 10 == 3, 1).alias("extra"),
    ))
    rows = validation.validated(table(spark, d, "documents").select("doc_id", raw.alias("raw")), "raw", {"document": SCHEMA, "page": SCHEMA}, "kind")
    at = F.concat("i.path", F.when(F.col("i.keyword") == "required", F.concat(F.lit("."), "i.detail")).otherwise(""), F.lit(": "), "i.keyword")
    return rows.select("doc_id", qc.outer("schema_issues")).filter("i is not null").select("doc_id", at.alias("path"))


#: A record with a list of nested turns; formats are not asserted, as validators do by default.
RECORD_SCHEMA = {
    "type": "object", "additionalProperties": False, "required": ["record_type", "id", "turns", "audit"],
    "properties": {
        "record_type": {"const": "talk"}, "id": {"type": "string", "minLength": 2}, "audit": {"type": "object", "required": ["created_at"], "properties": {"created_at": {"type": "string", "format": "date-time"}}},
        "turns": {"type": "array", "minItems": 3, "items": {
            "type": "object", "additionalProperties": False, "required": ["turn_index", "role"],
            "properties": {"turn_index": {"type": "integer", "minimum": 0}, "role": {"type": "string", "enum": ["user", "assistant"]}, "start": {"type": "number"}, "tags": {"type": "array", "uniqueItems": True, "items": {"type": "string"}}},
        }},
    },
}


@query("""WITH t AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, count(*) OVER (PARTITION BY conv_id) AS n, conv_id + turn AS s FROM conversations),
r AS (SELECT DISTINCT conv_id, n FROM t)
SELECT conv_id, path, keyword, detail FROM (
SELECT conv_id, '$.id' AS path, 'minLength' AS keyword, NULL AS detail FROM r WHERE length(CAST(conv_id AS VARCHAR)) < 2 AND conv_id % 6 <> 5
UNION ALL SELECT conv_id, '$.id', 'type', NULL FROM r WHERE conv_id % 6 = 5
UNION ALL SELECT conv_id, '$', 'required', 'audit' FROM r WHERE conv_id % 5 = 1
UNION ALL SELECT conv_id, '$.audit', 'required', 'created_at' FROM r WHERE conv_id % 5 = 2
UNION ALL SELECT conv_id, '$', 'additionalProperties', 'note' FROM r WHERE conv_id % 4 = 3
UNION ALL SELECT conv_id, '$.turns', 'minItems', NULL FROM r WHERE n < 3
UNION ALL SELECT conv_id, '$.turns[' || pos || '].turn_index', 'minimum', NULL FROM t WHERE s % 7 = 0
UNION ALL SELECT conv_id, '$.turns[' || pos || ']', 'required', 'turn_index' FROM t WHERE s % 7 = 3
UNION ALL SELECT conv_id, '$.turns[' || pos || '].role', 'enum', NULL FROM t WHERE role NOT IN ('user', 'assistant')
UNION ALL SELECT conv_id, '$.turns[' || pos || '].start', 'type', NULL FROM t WHERE s % 9 = 4
UNION ALL SELECT conv_id, '$.turns[' || pos || '].tags', 'uniqueItems', NULL FROM t WHERE s % 8 = 2
UNION ALL SELECT conv_id, '$.turns[' || pos || ']', 'additionalProperties', 'odd' FROM t WHERE s % 10 = 6)""")
def record_schema_issues(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as nested records under a schema that reaches into the items of their turns."""
    c, s = F.col("conv_id"), F.col("conv_id") + F.col("turn")
    turn = F.struct(
        F.when(s % 7 == 0, -1).when(s % 7 != 3, F.col("turn")).alias("turn_index"), "role", F.when(s % 9 == 4, "late").otherwise("1").alias("start"),
        F.when(s % 8 == 2, F.array(F.lit("x"), F.lit("y"), F.lit("x"))).when(s % 8 == 3, F.array(F.lit("x"))).alias("tags"), F.when(s % 10 == 6, True).alias("odd"),
    )
    r = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", turn.alias("t")))), lambda x: x.t).alias("turns"))
    audit = F.when(c % 5 != 1, F.struct(F.when(c % 5 != 2, F.lit("no date")).alias("created_at")))
    told = F.struct(F.lit("talk").alias("record_type"), c.cast("string").alias("id"), "turns", audit.alias("audit"), F.when(c % 4 == 3, "n").alias("note"))
    # starts are numbers unless they are words, ids strings unless they are numbers
    raw = F.regexp_replace(F.to_json(told), '"start":"1"', '"start":1.5')
    raw = F.when(c % 6 == 5, F.regexp_replace(raw, r'"id":"(\d+)"', '"id":$1')).otherwise(raw)
    found = validation.validated(r.select("conv_id", raw.alias("raw")), "raw", {"talk": RECORD_SCHEMA})
    return found.select("conv_id", qc.outer("schema_issues")).filter("i is not null").select("conv_id", "i.path", "i.keyword", "i.detail")


@query("""WITH m AS (SELECT conv_id, count(*) AS n, min(turn) AS a, max(turn) AS b, count(*) FILTER (WHERE role = 'assistant') AS h FROM conversations GROUP BY conv_id)
SELECT conv_id, list_filter([CASE WHEN conv_id % 6 = 0 THEN 'meta_keys' END, CASE WHEN n <> b - a + 1 + conv_id % 4 // 3 THEN 'sentence_count' END, CASE WHEN conv_id % 3 = 0 AND h > 0 AND h < n THEN 'speaker_ids' END], lambda x: x IS NOT NULL) AS faults FROM m""")
def formal_assertions(spark: SparkSession, d: str) -> DataFrame:
    """Exact keys, declared counts, and the speakers that a kind of section may have: one in openings, any in calls."""
    c = F.col("conv_id")
    r = table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.min("turn").alias("a"), F.max("turn").alias("b"), F.sort_array(F.collect_set(F.when(F.col("role") == "assistant", "host").otherwise("guest"))).alias("speakers"))
    want = F.array(F.lit("kind"), F.lit("sentence_count"), F.lit("speakers"))
    keys = F.when(c % 6 == 0, F.array(F.lit("kind"), F.lit("speakers"))).otherwise(want)
    declared, kind = F.col("b") - F.col("a") + 1 + F.floor((c % 4) / 3), F.when(c % 3 == 0, "opening").otherwise("call")
    made = [F.when(F.size(F.array_except(want, keys)) + F.size(F.array_except(keys, want)) > 0, "meta_keys"), F.when(F.col("n") != declared, "sentence_count"), F.when((kind == "opening") & (F.size("speakers") > 1), "speaker_ids")]
    return r.select("conv_id", F.array_compact(F.array(*made)).alias("faults"))
