"""Bad cases: their sources, traces and export records; services' rows brought up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import exports as ops
from dialoom.operators import ingest
from dialoom.plans.base import query
from dialoom.sources.tables import table

#: Documents as bad cases, of which many fields are missing or blank.
CASES_SQL = """WITH c AS (SELECT doc_id, 'b' || doc_id AS id, CASE WHEN doc_id % 5 = 0 THEN ' s' || doc_id WHEN doc_id % 5 = 1 THEN ' ' END AS body_source, CASE WHEN doc_id % 7 = 0 THEN 't' || doc_id END AS trace_source, CASE WHEN doc_id % 4 = 0 THEN 'l' || doc_id END AS live_turn,
CASE WHEN doc_id % 2 = 0 THEN 'r' || doc_id % 10 END AS run, CASE WHEN doc_id % 3 <> 0 THEN 'c' || doc_id % 20 END AS case_id, CASE WHEN doc_id % 11 <> 0 THEN 'x' || doc_id END AS trace_id, lang, source, n_chars FROM documents),
s AS (SELECT *, coalesce(nullif(trim(body_source), ''), trace_source, live_turn, run || ':' || case_id, case_id, trace_id) AS source_id FROM c)
"""


def _cases(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    name = lambda p, n=None: F.concat(F.lit(p), (i if n is None else i % n).cast("string"))
    c = table(spark, d, "documents").select(
        "doc_id", name("b").alias("id"), F.when(i % 5 == 0, name(" s")).when(i % 5 == 1, " ").alias("body_source"), F.when(i % 7 == 0, name("t")).alias("trace_source"), F.when(i % 4 == 0, name("l")).alias("live_turn"),
        F.when(i % 2 == 0, name("r", 10)).alias("run"), F.when(i % 3 != 0, name("c", 20)).alias("case_id"), F.when(i % 11 != 0, name("x")).alias("trace_id"), "lang", "source", "n_chars")
    return c.withColumn("source_id", ops.source_id(*[F.col(x) for x in ("body_source", "trace_source", "live_turn", "run", "case_id", "trace_id")]))


@query(CASES_SQL + "SELECT id, source_id, CASE WHEN doc_id % 9 = 0 THEN 'manual' WHEN live_turn IS NOT NULL THEN 'live_turn' ELSE 'offline_case' END AS source_type FROM s")
def bad_case_sources(spark: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("doc_id") % 9 == 0, "manual").when(F.col("doc_id") % 9 == 1, "  ")
    return _cases(spark, d).select("id", "source_id", ops.source_type(said, F.lit(None).cast("string"), F.col("live_turn")).alias("source_type"))


@query(CASES_SQL + """SELECT id, coalesce(CASE WHEN doc_id % 6 = 0 THEN source END, lang) AS suite, CASE WHEN doc_id % 6 = 0 THEN false ELSE doc_id % 8 <> 3 END AS allowed FROM s""")
def same_suite_guard(spark: SparkSession, d: str) -> DataFrame:
    """Two runs may be judged together if both are of the suite that is said, or of the first one's."""
    i = F.col("doc_id")
    suite, ok = ops.same_suite(F.when(i % 6 == 0, F.col("source")), F.col("lang"), F.when(i % 8 == 3, "other").otherwise(F.col("lang")))
    return _cases(spark, d).select("id", suite.alias("suite"), ok.alias("allowed"))


@query(CASES_SQL + """SELECT id, CASE doc_id % 4 WHEN 0 THEN 'trace' WHEN 1 THEN 'parsed' WHEN 2 THEN 'record' ELSE '' END AS first_content, CASE doc_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END AS n,
CASE doc_id % 5 WHEN 0 THEN 'response' WHEN 1 THEN 'top' WHEN 2 THEN 'raw' WHEN 3 THEN 'clean' ELSE 'rawrec' END AS output FROM s""")
def trace_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Messages and output of a trace by precedence; blank roles and empty contents do not count."""
    i = F.col("doc_id")
    request = F.when(i % 4 == 0, '[{"role":" user ","content":"trace"},{"role":" ","content":"x"},{"role":"assistant","content":""},{"role":"assistant","content":"y"}]').when(i % 4 == 1, "[]")
    final = F.when(i % 4 <= 1, '[{"role":"user","content":"parsed"}]').when(i % 4 == 2, "no list")
    record = F.when(i % 4 != 3, '[{"role":"user","content":"record"}]')
    m = ops.first_messages(request, final, record)
    blank = lambda k, text: F.when(i % 5 == k, text)
    out = ops.trace_output(F.when(i % 5 == 0, '{"output_text": "response"}').otherwise('{"output_text": " "}'), F.when(i % 5 <= 1, "top").otherwise(" "), F.when(i % 5 == 2, '{"output_text": "raw"}'), blank(3, "clean"), F.lit("rawrec"))
    return _cases(spark, d).select("id", F.coalesce(F.get(m, F.lit(0))["content"], F.lit("")).alias("first_content"), F.size(m).alias("n"), out.alias("output"))


@query(CASES_SQL + """SELECT id, CASE doc_id % 4 WHEN 0 THEN 'a,b' WHEN 1 THEN 'a' ELSE '' END AS tags, CASE WHEN doc_id % 3 = 0 THEN 4.5 END AS score, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END AS n FROM s""")
def tags_and_rubrics(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    tags = ops.failure_tags(F.when(i % 4 == 0, '["a","","b"]').when(i % 4 == 1, '["a"]').when(i % 4 == 2, "broken ["))
    scores = ops.rubric_scores(F.when(i % 3 == 0, '{"style": 4.5, "truth": 3}').when(i % 3 == 1, "[1]"))
    return _cases(spark, d).select("id", F.array_join(tags, ",").alias("tags"), F.try_element_at(scores, F.lit("style")).alias("score"), F.size(scores).alias("n"))


RECORD_SQL = CASES_SQL + """, k AS (SELECT *, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE id END AS own FROM s)
"""


@query(RECORD_SQL + """SELECT doc_id, '{"record_type":"sft_candidate","version":"export_v1","candidate_id":"' || coalesce(own, coalesce(source_id, 'case') || '_sft') || '",' || coalesce('"source_id":"' || source_id || '",', '') || '"input_messages":[{"role":"user","content":"q"}],"model_output":"out ' || lang || '","edited_target":"' || source || '","failure_tags":["a"],"prompt_tokens":' || CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE 0 END || '}' AS record FROM k""")
def training_candidates(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d)
    i = F.col("doc_id")
    made = ops.training_candidate(F.when(i % 13 != 0, F.col("id")), F.col("source_id"), ops.messages(F.lit('[{"role":"user","content":"q"}]')), F.concat(F.lit("out "), F.col("lang")), F.col("source"), ops.failure_tags(F.lit('["a"]')), F.when(i % 2 == 0, F.col("n_chars").cast("string")).otherwise("none"))
    return c.select("doc_id", F.to_json(made).alias("record"))


@query(RECORD_SQL + """SELECT doc_id, '{"record_type":"preference_pair_candidate","version":"export_v1","pair_id":"' || coalesce(own, coalesce(source_id, 'case') || '_pair') || '",' || coalesce('"source_id":"' || source_id || '",', '') || '"context_messages":[],"chosen":{"candidate_id":"cand_a","provenance":"human","text":"' || source || '"},"rejected":{"candidate_id":"cand_b","provenance":"model","text":"' || lang || '"},"judgement":{"winner":"chosen","preference_strength":"medium"}}' AS record FROM k""")
def preference_candidates(spark: SparkSession, d: str) -> DataFrame:
    made = ops.preference_candidate(F.when(F.col("doc_id") % 13 != 0, F.col("id")), F.col("source_id"), ops.messages(F.lit(None).cast("string")), F.col("source"), F.col("lang"))
    return _cases(spark, d).select("doc_id", F.to_json(made).alias("record"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'failed' ELSE 'succeeded' END AS status, '[{"role":"user"}]' AS final_messages, CASE WHEN doc_id % 3 = 0 THEN n_chars::DOUBLE END AS prompt_tokens, (doc_id % 50)::DOUBLE AS generated_tokens,
CASE WHEN doc_id % 4 = 0 THEN 'said' WHEN doc_id % 4 = 1 THEN NULL ELSE lang END AS output_text, CASE WHEN doc_id % 6 = 0 THEN source END AS artifact_path FROM documents""")
def live_traces(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    response = F.to_json(F.struct((i % 50).alias("generated_tokens"), F.when(i % 4 == 1, "").otherwise(F.col("lang")).alias("output_text"), F.when(i % 6 == 0, F.col("source")).otherwise("").alias("trace_path")))
    trim = F.when(i % 3 == 0, F.to_json(F.struct(F.col("n_chars").alias("finalEstimatedPromptTokens"))))
    row = ops.live_trace(i, F.when(i % 5 == 0, "failed").otherwise(" "), F.lit('{"messages": [{"role":"user"}]}'), response, trim, F.when(i % 4 == 0, "said"))
    keep = ("status", "final_messages", "prompt_tokens", "generated_tokens", "output_text", "artifact_path")
    return table(spark, d, "documents").select("doc_id", row.alias("t")).select("doc_id", *[f"t.{c}" for c in keep])


@query("""WITH h AS (SELECT s_suppkey AS id, s_name AS name, 'ready' AS state FROM supplier WHERE s_suppkey % 3 <> 0), r AS (SELECT s_suppkey AS id, s_name || '!' AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'down' ELSE 'ready' END AS state FROM supplier WHERE s_suppkey % 5 <> 0)
SELECT coalesce(r.id, h.id) AS id, coalesce(r.name, h.name) AS name, CASE WHEN r.id IS NULL THEN 'stale' ELSE r.state END AS state, CASE WHEN r.id IS NULL THEN 'kept' WHEN h.id IS NULL THEN 'inserted' ELSE 'updated' END AS change FROM h FULL JOIN r ON h.id = r.id""")
def remote_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue after a remote snapshot: rows of it are inserted or brought up to date, others are kept as stale."""
    s, i = table(spark, d, "supplier"), F.col("s_suppkey")
    here = s.filter(i % 3 != 0).select(i.alias("id"), F.col("s_name").alias("old"), F.lit(True).alias("here"))
    there = s.filter(i % 5 != 0).select(i.alias("id"), F.concat("s_name", F.lit("!")).alias("new"), F.when(i % 4 == 0, "down").otherwise("ready").alias("now"))
    gone = F.col("now").isNull()
    return here.join(there, "id", "full").select("id", F.coalesce("new", "old").alias("name"), F.when(gone, "stale").otherwise(F.col("now")).alias("state"), F.when(gone, "kept").when(F.col("here").isNull(), "inserted").otherwise("updated").alias("change"))


@query("""SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE 'starting' END AS state, event_type NOT IN ('view', 'click') AS claimed FROM events""")
def claim_where_free(spark: SparkSession, d: str) -> DataFrame:
    """A claim takes what is in none of the busy states."""
    free = ~F.col("event_type").isin("view", "click")
    return table(spark, d, "events").select("event_id", F.when(free, "starting").otherwise(F.col("event_type")).alias("state"), free.alias("claimed"))


@query("""WITH p AS (SELECT l.doc_id, left(d.text, 20) AS now, CASE l.doc_id % 4 WHEN 0 THEN left(d.text, 20) WHEN 1 THEN 'before' ELSE 'b' END AS before, CASE l.doc_id % 4 WHEN 1 THEN left(d.text, 20) ELSE 'after' END AS after, d.doc_id IS NOT NULL AND l.doc_id % 9 <> 0 AS there FROM labels l LEFT JOIN documents d USING (doc_id))
SELECT doc_id, CASE WHEN NOT there THEN 'missing' WHEN now = before THEN 'already_reverted' WHEN now = after THEN 'revert' ELSE 'conflict' END AS outcome, CASE WHEN there AND now <> before AND now = after THEN before WHEN there THEN now END AS text FROM p""")
def patch_revert_status(spark: SparkSession, d: str) -> DataFrame:
    """A patch is taken back where the text is what the patch made, and only there."""
    docs = table(spark, d, "documents").filter("doc_id % 9 <> 0").select("doc_id", F.left("text", F.lit(20)).alias("now"))
    p = table(spark, d, "labels").select("doc_id").join(docs, "doc_id", "left")
    i, now = F.col("doc_id") % 4, F.col("now")
    before, after = F.when(i == 0, now).when(i == 1, "before").otherwise("b"), F.when(i == 1, now).otherwise("after")
    out = F.when(now.isNull(), "missing").when(now == before, "already_reverted").when(now == after, "revert").otherwise("conflict")
    return p.withColumns({"outcome": out, "before": before}).select("doc_id", "outcome", F.when(F.col("outcome") == "revert", F.col("before")).otherwise(now).alias("text"))


#: Documents as bad cases with all that their records tell.
WHOLE_SQL = """WITH c AS (SELECT doc_id, CASE WHEN doc_id % 13 <> 0 THEN 'b' || doc_id END AS id, CASE WHEN doc_id % 4 = 0 THEN 'live_turn' ELSE 'offline_case' END AS source_type, CASE WHEN doc_id % 5 < 3 THEN 's' || doc_id END AS own, CASE WHEN doc_id % 3 <> 0 THEN 'c' || doc_id % 20 END AS case_id,
CASE WHEN doc_id % 7 <> 0 THEN 'm' || doc_id % 3 END AS model, CASE WHEN doc_id % 2 = 0 THEN 'r1' END AS run, CASE WHEN doc_id % 4 = 0 THEN 'l' || doc_id END AS turn, CASE WHEN doc_id % 6 = 0 THEN 'deep' WHEN doc_id % 6 = 1 THEN 'flat' END AS slice, CASE WHEN doc_id % 2 = 1 THEN 'p2' END AS prompt, lang, source, n_chars FROM documents),
s AS (SELECT *, coalesce(own, case_id) AS sid FROM c),
r AS (SELECT *, struct_pack(source_type := source_type, source_id := sid, model_id := model, deployment_id := model, run_id := run, live_session_id := CAST(NULL AS VARCHAR), live_turn_id := turn, case_id := case_id, slice := slice, prompt_version := prompt, context_builder_version := CASE WHEN doc_id % 2 = 1 THEN 'k' END, generation_config_version := CAST(NULL AS VARCHAR)) AS src,
CASE WHEN doc_id % 9 = 0 THEN [struct_pack(role := 'user', content := lang)] ELSE [] END AS msgs, CASE WHEN doc_id % 8 = 0 THEN 'a/' || doc_id END AS path, CASE WHEN doc_id % 5 = 0 THEN 'ann' END AS ann FROM s)
"""


def _whole(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    name = lambda p, n=None: F.concat(F.lit(p), (i if n is None else i % n).cast("string"))
    no = F.lit(None).cast("string")
    given = {
        "id": F.when(i % 13 != 0, name("b")).otherwise(" "), "source_type": F.when(i % 4 == 0, "live_turn").otherwise("offline_case"), "source_id": F.when(i % 5 < 3, name(" s")), "case_id": F.when(i % 3 != 0, name("c", 20)).otherwise(""),
        "model_deployment_id": F.when(i % 7 != 0, name("m", 3)), "eval_run_id": F.when(i % 2 == 0, "r1"), "live_session_id": F.lit(" "), "live_turn_id": F.when(i % 4 == 0, name("l")),
        "source_slice": F.when(i % 6 == 0, "deep"), "slice": F.when(i % 6 < 2, "flat"), "failure_tags_json": F.when(i % 4 == 0, '["a","","b"]').when(i % 4 == 1, '{"a":1}').when(i % 4 == 2, "["), "topic_primary": F.when(i % 3 == 0, F.col("lang")),
        "difficulty": F.lit(" hard "), "reply_type": no, "notes": F.when(i % 10 == 0, " seen "), "runtime_signature": F.when(i % 2 == 1, '{"prompt_version":"p2","context_builder_version":" k "}').otherwise("none"),
        "trace": F.when(i % 3 == 0, F.to_json(F.struct(F.col("n_chars").alias("estimatedPromptTokens"), F.lit("x").alias("generatedTokens"), F.lit(12.7).alias("totalLatencyMs"), F.lit(3).alias("firstTokenLatencyMs")))).when(i % 3 == 1, '{"promptTokens":5,"generatedTokens":"6"}'),
        "source_path": F.when(i % 8 == 0, name("a/")).otherwise(""), "trace_path": no, "annotator_id": F.when(i % 5 == 0, "ann"), "reviewer_id": F.lit(""), "created_at": F.lit("2024-01-01T00:00:00Z"),
    }
    said = ops.messages(F.when(i % 9 == 0, F.to_json(F.array(F.struct(F.lit(" user ").alias("role"), F.col("lang").alias("content"))))))
    cases = table(spark, d, "documents").select("doc_id", *[v.alias(k) for k, v in given.items()], said.alias("said"), F.col("lang").alias("output"), F.when(i % 11 != 0, F.col("source")).alias("target"))
    return ops.whole_records(cases, "said", "output", "target")


@query(WHOLE_SQL + """SELECT doc_id, CAST(to_json(struct_pack(record_type := 'sft_candidate', version := 'export_v1', candidate_id := coalesce(id, coalesce(sid, 'case') || '_sft'), source := src, input_messages := msgs, model_output := lang, edited_target := CASE WHEN doc_id % 11 <> 0 THEN source ELSE '' END,
labels := struct_pack(failure_tags := CASE WHEN doc_id % 4 = 0 THEN ['a', 'b'] ELSE [] END, topic_primary := CASE WHEN doc_id % 3 = 0 THEN lang END, difficulty := 'hard', reply_type := CAST(NULL AS VARCHAR)),
metadata := struct_pack(source_path := path, trace_path := CAST(NULL AS VARCHAR), prompt_tokens := CASE doc_id % 3 WHEN 0 THEN n_chars WHEN 1 THEN 5 ELSE 0 END, generated_tokens := CASE doc_id % 3 WHEN 1 THEN 6 ELSE 0 END, latency_ms := CASE doc_id % 3 WHEN 0 THEN 12.7::DOUBLE ELSE 0.0::DOUBLE END, annotator_id := ann, reviewer_id := CAST(NULL AS VARCHAR), created_at := '2024-01-01T00:00:00Z', notes := CASE WHEN doc_id % 10 = 0 THEN 'seen' END))) AS VARCHAR) AS record FROM r""")
def sft_export_records(spark: SparkSession, d: str) -> DataFrame:
    """Training candidates in full, null fields included."""
    return _whole(spark, d).select("doc_id", ops.as_line("sft").alias("record"))


@query(WHOLE_SQL + """SELECT doc_id, CAST(to_json(struct_pack(record_type := 'preference_pair_candidate', version := 'export_v1', pair_id := coalesce(id, coalesce(sid, 'case') || '_pair'), source := src, context_messages := msgs,
chosen := struct_pack(candidate_id := 'cand_a', provenance := 'human', text := CASE WHEN doc_id % 11 <> 0 THEN source ELSE '' END), rejected := struct_pack(candidate_id := 'cand_b', provenance := 'model', text := lang), judgement := struct_pack(winner := 'chosen', preference_strength := 'medium', reason_tags := CAST([] AS VARCHAR[]), scores := MAP {}),
metadata := struct_pack(source_path := path, trace_path := CAST(NULL AS VARCHAR), annotator_id := ann, reviewer_id := CAST(NULL AS VARCHAR), created_at := '2024-01-01T00:00:00Z', notes := CASE WHEN doc_id % 10 = 0 THEN 'seen' END))) AS VARCHAR) AS record FROM r""")
def pair_export_records(spark: SparkSession, d: str) -> DataFrame:
    """Preference pairs in full, null fields included."""
    return _whole(spark, d).select("doc_id", ops.as_line("pair").alias("record"))


@query("""SELECT doc_id AS case_id, CASE WHEN t = 0 THEN '{"prompt_version":"t"}' ELSE CASE WHEN doc_id % 2 = 0 THEN '{"prompt_version":"r"}' END END AS runtime_signature, CASE WHEN t < 2 THEN '[]' ELSE '[{"role":"user"}]' END AS messages, CASE WHEN t = 0 THEN '{"top_p":0.5}' ELSE '{"top_k":1}' END AS generation,
CASE WHEN t = 1 THEN '{"n":1}' END AS trace_meta, CASE WHEN t = 0 THEN 'traced' WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN '' ELSE lang END AS output_text,
CASE WHEN t = 0 THEN '{"clean_output_text":"traced"}' WHEN t = 1 THEN '{"clean_output_text":""}' ELSE '{"raw_output_text":"' || CASE WHEN doc_id % 3 = 1 THEN '' ELSE lang END || '","clean_output_text":"' || CASE WHEN doc_id % 3 = 0 THEN lang ELSE '' END || '","generated_tokens":2,"prompt_tokens":' || n_chars || ',"latency_ms":null}' END AS raw_output_json,
CASE WHEN t = 0 THEN 0 ELSE n_chars END AS prompt_tokens, CAST(2 AS BIGINT) AS generated_tokens, CASE WHEN t = 1 THEN 7 END AS latency_ms, CASE WHEN t = 1 THEN 'a/b' WHEN doc_id % 2 = 1 THEN source END AS trace_path, t > 1 AS missing_trace
FROM (SELECT *, doc_id % 5 AS t FROM documents)""")
def traced_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of a run with their traces: full, with holes, broken, of another type, or missing."""
    i = F.col("doc_id")
    docs = table(spark, d, "documents")
    records = docs.select(
        i.alias("case_id"), F.when(i % 2 == 0, '{"prompt_version":"r"}').alias("runtime_signature"), F.lit('[{"role":"user"}]').alias("messages"), F.lit('{"top_k":1}').alias("generation"), F.when(i % 3 == 0, F.col("lang")).otherwise("").alias("clean_output"),
        F.when(i % 3 == 1, "").otherwise(F.col("lang")).alias("raw_output"), F.col("n_chars").cast("long").alias("prompt_tokens"), F.lit(2).cast("long").alias("generated_tokens"), F.lit(None).cast("long").alias("latency_ms"), F.when(i % 2 == 1, F.col("source")).otherwise("").alias("trace_path"))
    full = '{"runtime_signature":{"prompt_version":"t"},"request":{"messages":[],"generation":{"top_p":0.5},"trace_meta":[]},"response":{"clean_output_text":"traced"},"metrics":{"prompt_tokens":0,"generated_tokens":2.5,"latency_ms":"9"},"artifacts":{"trace_path":""}}'
    holes = '{"runtime_signature":"none","request":{"messages":[],"generation":3,"trace_meta":{"n":1}},"response":{"clean_output_text":""},"metrics":{"latency_ms":7},"artifacts":{"trace_path":"a/b"}}'
    traces = docs.filter(i % 5 < 4).select(i.alias("case_id"), F.when(i % 5 == 0, full).when(i % 5 == 1, holes).when(i % 5 == 2, "{").otherwise("[1]").alias("trace"))
    return ingest.with_traces(records, traces)
