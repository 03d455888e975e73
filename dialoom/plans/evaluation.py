"""Runs, comparisons, judgments, bad cases and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.plans.base import query
from dialoom.sources.tables import table

RUN_SQL = """WITH r AS (SELECT doc_id // 40 AS case_id, source AS run, lang AS slice, text, doc_id FROM documents),
run AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id, run ORDER BY doc_id DESC) AS k FROM r) WHERE k = 1)
"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Outputs by case and run; of several the last wins."""
    r = table(spark, d, "documents").withColumn("case_id", F.floor(F.col("doc_id") / 40))
    return r.groupBy("case_id", F.col("source").alias("run")).agg(F.max(F.struct("doc_id", "lang", "text")).alias("m")).select("case_id", "run", "m.doc_id", F.col("m.lang").alias("slice"), "m.text")


@query(RUN_SQL + "SELECT a.case_id, a.doc_id AS left_id, b.doc_id AS right_id, a.slice, length(a.text) - length(b.text) AS longer FROM run a JOIN run b ON a.case_id = b.case_id AND a.run = 'src1' AND b.run = 'src2'")
def arena_compare(spark: SparkSession, d: str) -> DataFrame:
    runs = _runs(spark, d)
    side = lambda run, p: runs.filter(F.col("run") == run).select("case_id", *[F.col(c).alias(p + c) for c in ("doc_id", "slice", "text")])
    return side("src1", "l_").join(side("src2", "r_"), "case_id").select("case_id", F.col("l_doc_id").alias("left_id"), F.col("r_doc_id").alias("right_id"), F.col("l_slice").alias("slice"), (F.length("l_text") - F.length("r_text")).alias("longer"))


@query("SELECT doc_id, CASE quality * 2 + toxic WHEN 0 THEN 'left' WHEN 1 THEN 'right' WHEN 2 THEN NULL ELSE NULL END AS winner, CASE WHEN quality = 1 AND toxic = 0 THEN 'tie' WHEN quality = 1 THEN 'skip' ELSE 'decided' END AS kind FROM labels")
def arena_winner(spark: SparkSession, d: str) -> DataFrame:
    """The run a judgment names; ties and skips name none."""
    code = F.col("quality") * 2 + F.col("toxic")
    return table(spark, d, "labels").select("doc_id", F.when(code == 0, "left").when(code == 1, "right").alias("winner"), F.when(code == 2, "tie").when(code == 3, "skip").otherwise("decided").alias("kind"))


@query("""WITH e AS (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) SELECT CASE WHEN e.doc_id IS NULL THEN 'imported' WHEN quality = 1 THEN 'updated' ELSE 'skipped' END AS outcome, count(*) AS n, count(*) FILTER (WHERE d.n_chars = 0) AS missing FROM documents d LEFT JOIN e USING (doc_id) GROUP BY 1""")
def ingest_status(spark: SparkSession, d: str) -> DataFrame:
    """Incoming rows against those there: imported, updated by force, or skipped."""
    there = table(spark, d, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    outcome = F.when(F.col("quality").isNull(), "imported").when(F.col("quality") == 1, "updated").otherwise("skipped")
    return table(spark, d, "documents").join(there, "doc_id", "left").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") == 0).alias("missing"))


CASES_SQL = """WITH c AS (SELECT l.doc_id, CASE WHEN quality = 1 THEN substr(text, 1, 20) END AS edited, CASE WHEN toxic = 0 THEN substr(text, 1, 10) END AS chosen, CASE WHEN n_chars > 800 THEN substr(text, 2, 10) END AS rejected, lang FROM labels l JOIN documents d USING (doc_id)),
k AS (SELECT *, CASE WHEN edited IS NOT NULL THEN 'sft_candidate' WHEN chosen IS NOT NULL AND rejected IS NOT NULL THEN 'preference_pair_candidate' END AS kind FROM c)
"""


def _cases(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "n_chars", "lang")
    c = table(spark, d, "labels").join(docs, "doc_id").select("doc_id", "lang", F.when(F.col("quality") == 1, F.substring("text", 1, 20)).alias("edited"), F.when(F.col("toxic") == 0, F.substring("text", 1, 10)).alias("chosen"), F.when(F.col("n_chars") > 800, F.substring("text", 2, 10)).alias("rejected"))
    return c.withColumn("kind", F.when(F.col("edited").isNotNull(), "sft_candidate").when(F.col("chosen").isNotNull() & F.col("rejected").isNotNull(), "preference_pair_candidate"))


@query(CASES_SQL + "SELECT doc_id, kind, coalesce(nullif(edited, ''), chosen) AS target, rejected FROM k WHERE kind IS NOT NULL")
def export_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, d).filter("kind is not null").select("doc_id", "kind", F.coalesce(F.nullif("edited", F.lit("")), "chosen").alias("target"), "rejected")


@query(CASES_SQL + "SELECT lang, count(*) AS seen, count(kind) AS exported, count(*) FILTER (WHERE kind IS NULL AND chosen IS NULL) AS no_chosen, count(*) FILTER (WHERE kind IS NULL AND chosen IS NOT NULL) AS no_rejected, CASE count(DISTINCT kind) WHEN 1 THEN 'single' ELSE 'mixed' END AS bundle FROM k GROUP BY lang")
def export_skips(spark: SparkSession, d: str) -> DataFrame:
    none = F.col("kind").isNull()
    return _cases(spark, d).groupBy("lang").agg(F.count("*").alias("seen"), F.count("kind").alias("exported"), F.count_if(none & F.col("chosen").isNull()).alias("no_chosen"), F.count_if(none & F.col("chosen").isNotNull()).alias("no_rejected"), F.when(F.countDistinct("kind") == 1, "single").otherwise("mixed").alias("bundle"))


@query("SELECT d.doc_id, d.lang, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 1 ELSE 0 END AS judged FROM documents d WHERE d.lang IN ('en', 'de')")
def judged_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Rows in a list of keys with whether a judgment exists."""
    there = table(spark, d, "labels").select("doc_id", F.lit(1).alias("j")).distinct()
    return table(spark, d, "documents").filter(F.col("lang").isin("en", "de")).join(there, "doc_id", "left").select("doc_id", "lang", F.coalesce("j", F.lit(0)).alias("judged"))


@query("""SELECT doc_id, CASE WHEN least(s1, s2, s3) = 1 THEN 'fail' WHEN (s1 = 2)::INT + (s2 = 2)::INT + (s3 = 2)::INT >= 2 THEN 'fail' WHEN (s1 = 3)::INT + (s2 = 3)::INT + (s3 = 3)::INT >= 2 THEN 'marginal' ELSE 'pass' END AS verdict FROM (SELECT doc_id, 1 + doc_id % 5 AS s1, 1 + doc_id // 5 % 5 AS s2, 1 + doc_id // 25 % 5 AS s3 FROM documents)""")
def rubric_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Any 1 fails, so do two 2s; two 3s are marginal."""
    s = F.array(*[1 + F.floor(F.col("doc_id") / k) % 5 for k in (1, 5, 25)])
    n = lambda k: F.size(F.filter("s", lambda x: x == k))
    return table(spark, d, "documents").withColumn("s", s).select("doc_id", F.when(n(1) > 0, "fail").when(n(2) >= 2, "fail").when(n(3) >= 2, "marginal").otherwise("pass").alias("verdict"))


@query("""SELECT conv_id, turn, list_filter([CASE WHEN contains(lower(text), 'th') THEN 'recall' END, CASE WHEN length(text) >= 60 THEN 'plan' END, CASE WHEN turn >= 3 THEN 'guard' END, 'reply'], lambda x: x IS NOT NULL)[1:3] AS tools FROM conversations WHERE role = 'user'""")
def tool_plan(spark: SparkSession, d: str) -> DataFrame:
    """Tools by cues and lengths, in order, three at most."""
    tools = F.array_compact(F.array(F.when(F.lower("text").contains("th"), "recall"), F.when(F.length("text") >= 60, "plan"), F.when(F.col("turn") >= 3, "guard"), F.lit("reply")))
    return table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", F.slice(tools, 1, 3).alias("tools"))


@query("""SELECT doc_id, list_filter(tags, lambda x, i: list_position(tags, x) = i AND x IN ('src1', 'en', 'fr')) AS tags FROM (SELECT doc_id, [trim(x) FOR x IN string_split(source || ', ' || lang || ',,' || lang, ',')] AS tags FROM documents)""")
def allowed_tags(spark: SparkSession, d: str) -> DataFrame:
    """Trimmed, distinct values of an allowed list, in order."""
    tags = F.transform(F.split(F.concat("source", F.lit(", "), "lang", F.lit(",,"), "lang"), ","), lambda x: F.trim(x))
    return table(spark, d, "documents").select("doc_id", F.array_distinct(F.filter(tags, lambda x: x.isin("src1", "en", "fr"))).alias("tags"))


@query("""SELECT a.conv_id, count(DISTINCT b.w) AS known FROM (SELECT conv_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{2,}'))) AS w FROM conversations WHERE role = 'user') a JOIN (SELECT DISTINCT conv_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{2,}'))) AS w FROM conversations WHERE role = 'assistant') b ON a.conv_id = b.conv_id AND a.w = b.w GROUP BY 1""")
def shared_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Words that both sides of a conversation use: an intersection of distinct sets."""
    w = table(spark, d, "conversations").select("conv_id", "role", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]{2,}"), F.lit(0))).alias("w"))
    side = lambda r: w.filter(F.col("role") == r).select("conv_id", "w")
    return side("user").intersect(side("assistant")).groupBy("conv_id").agg(F.count("*").alias("known"))


@query("SELECT 'run::' || url_encode(source || ' ' || doc_id) AS trace_id, source || ' ' || doc_id AS key FROM documents")
def trace_viewer_ids(spark: SparkSession, d: str) -> DataFrame:
    """Viewer ids with percent-encoded keys, and the keys decoded from them."""
    key = F.concat("source", F.lit(" "), F.col("doc_id"))
    coded = F.concat(F.lit("run::"), F.replace(F.url_encode(key), F.lit("+"), F.lit("%20")))
    return table(spark, d, "documents").select(coded.alias("trace_id"), F.url_decode(F.get(F.split(coded, "::"), F.lit(1))).alias("key"))


@query("""SELECT c_custkey, count(o_orderkey) AS orders, coalesce(sum(o_totalprice), 0) AS total, n_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY c_custkey, n_name""")
def eager_graph(spark: SparkSession, d: str) -> DataFrame:
    """An entity with its children and its parent in one row; children are aggregated before the join."""
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("total"))
    c = table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("total", F.lit(0)).alias("total"), "n_name")


