"""Chat samples, previews, context windows and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import scalars
from dialoom.operators import chat as ops
from dialoom.plans.base import query
from dialoom.sources.tables import CHAT_SQL, chat, table

MERGED_SQL = CHAT_SQL + """, r AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'assistant' WHEN role = 'user' THEN 'user' END AS role, trim(text) AS text FROM chat),
k AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS c FROM r WHERE role IS NOT NULL AND text <> ''),
i AS (SELECT *, CAST(sum(c) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS p FROM k),
m AS (SELECT conv_id, p, role, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS content FROM i GROUP BY conv_id, p, role),
b AS (SELECT *, min(CASE WHEN role = 'user' THEN p END) OVER (PARTITION BY conv_id) AS f, max(CASE WHEN role = 'assistant' THEN p END) OVER (PARTITION BY conv_id) AS l FROM m),
merged AS (SELECT conv_id, p - f AS pos, role, content FROM b WHERE p >= f AND p <= l)
"""
SAMPLES_SQL = MERGED_SQL + """, s AS (SELECT conv_id, pos, role, lag(role) OVER w AS before, sum(length(content)) OVER w AS chars, count(*) OVER w AS n FROM merged WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
samples AS (SELECT conv_id, 'conv_' || conv_id || '__' || lpad(CAST(row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS VARCHAR), 4, '0') AS sample_id, pos AS target_pos, n AS n_messages, CAST(chars AS BIGINT) AS n_chars,
CASE WHEN CAST('0x' || substr(sha1('20260327:' || conv_id), 1, 12) AS BIGINT) / 281474976710656.0 < 0.05 THEN 'dev' ELSE 'train' END AS split FROM s WHERE role = 'assistant' AND before = 'user')
"""


@query(MERGED_SQL + "SELECT * FROM merged")
def chat_turn_merge(spark: SparkSession, d: str) -> DataFrame:
    return ops.merge_turns(chat(spark, d))


@query(SAMPLES_SQL + "SELECT * FROM samples")
def sft_turn_samples(spark: SparkSession, d: str) -> DataFrame:
    chars = F.aggregate("messages", F.lit(0).cast("long"), lambda n, m: n + F.length(m["content"]))
    return ops.turn_samples(ops.merge_turns(chat(spark, d))).select(
        "conv_id", "sample_id", "target_pos", F.size("messages").cast("long").alias("n_messages"), chars.alias("n_chars"), ops.split_of(F.col("conv_id").cast("string")).alias("split"))


@query(SAMPLES_SQL + "SELECT split, count(*) AS samples, count(DISTINCT conv_id) AS conversations, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM samples GROUP BY split")
def sft_split_stats(spark: SparkSession, d: str) -> DataFrame:
    return sft_turn_samples(spark, d).groupBy("split").agg(F.count("*").alias("samples"), F.countDistinct("conv_id").alias("conversations"), F.sum("n_chars").alias("n_chars"))


@query(CHAT_SQL + """, s AS (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM chat WHERE role IN ('user', 'assistant') AND text <> '')
SELECT conv_id, turn, role, NOT (role = 'user' AND (after IS NULL OR after = 'user')) AS stable FROM s""")
def stable_orphan_turns(spark: SparkSession, d: str) -> DataFrame:
    return ops.stable_turns(chat(spark, d)).select("conv_id", "turn", "role", "stable")


@query(CHAT_SQL + """, a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS age FROM chat),
u AS (SELECT *, greatest(1, CAST(ceil(sum(length(role) + length(text) + 8) OVER (PARTITION BY conv_id ORDER BY turn DESC) / 4.0) AS BIGINT)) AS used FROM a WHERE age <= 6)
SELECT conv_id, turn, used, used <= 120 AS kept FROM u""")
def context_window_trim(spark: SparkSession, d: str) -> DataFrame:
    return ops.trimmed_context(chat(spark, d), 6, 120).select("conv_id", "turn", "used", "kept")


@query(CHAT_SQL + """, p AS (SELECT conv_id, trim(coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), arg_max(text, turn))) AS t, greatest(1, CAST(ceil(sum(length(role) + length(text) + 8) / 4.0) AS BIGINT)) AS tokens FROM chat GROUP BY conv_id)
SELECT conv_id, CASE WHEN length(t) > 160 THEN substr(t, 1, 157) || '...' ELSE t END AS preview, tokens FROM p""")
def prompt_preview(spark: SparkSession, d: str) -> DataFrame:
    """The last user message, else the last one, cut to 160; and the estimated tokens."""
    user = F.when(F.col("role") == "user", F.col("turn"))
    rows = chat(spark, d).groupBy("conv_id").agg(F.max_by("text", user).alias("u"), F.max_by("text", "turn").alias("t"), F.collect_list(F.length("role") + F.length("text")).alias("n"))
    return rows.select("conv_id", scalars.preview(F.coalesce("u", "t")).alias("preview"), scalars.estimated_tokens(F.col("n")).alias("tokens"))


@query("""SELECT event_id, lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS compact,
lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS clock,
lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || '.25' AS hundredths,
lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || ',250' AS srt, s AS parsed FROM (SELECT event_id, event_id * 7 % 80000 AS s FROM events)""")
def timestamp_formats(spark: SparkSession, d: str) -> DataFrame:
    s = (F.col("event_id") * 7 % 80000).cast("long")
    return table(spark, d, "events").select(
        "event_id", scalars.hhmmss(s + 0.25).alias("compact"), scalars.clock(s + 0.25).alias("clock"), scalars.clock_hundredths(s + 0.25).alias("hundredths"),
        scalars.srt_time(s + 0.25).alias("srt"), scalars.parse_clock(scalars.clock(s)).cast("long").alias("parsed"))


@query("""SELECT doc_id, CAST('0x' || substr(sha1('20260327:' || doc_id), 1, 12) AS BIGINT) / 281474976710656.0 < 0.05 AS dev, 'part_' || substr(sha1(CAST(doc_id AS VARCHAR)), 1, 16) AS part_id, substr(sha256(source || lang), 1, 16) AS signature FROM documents""")
def stable_bucket_split(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    return table(spark, d, "documents").select("doc_id", (scalars.split_bucket("20260327", key) < 0.05).alias("dev"), scalars.stable_id(key, "part_").alias("part_id"), F.substring(F.sha2(F.concat("source", "lang"), 256), 1, 16).alias("signature"))


@query("""SELECT doc_id, h % 2 = 0 AS left_is_a, least(source, lang) AS one, greatest(source, lang) AS two, n FROM (SELECT *,
list_reduce(list_prepend(CAST(2166136261 AS BIGINT), list_transform(string_split('case-' || doc_id, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda h, c: (xor(h, c) * 16777619) & 4294967295) AS h,
CAST(list_sum(list_transform(string_split(source, ''), lambda c: ascii(c))) AS BIGINT) AS n FROM documents)""")
def blind_slot(spark: SparkSession, d: str) -> DataFrame:
    """The side of a blind comparison by the parity of a stable hash; canonical pairs; sums of code points."""
    return table(spark, d, "documents").select(
        "doc_id", (scalars.fnv32(F.concat(F.lit("case-"), F.col("doc_id"))) % 2 == 0).alias("left_is_a"), F.least("source", "lang").alias("one"), F.greatest("source", "lang").alias("two"),
        scalars.code_point_sum(F.col("source")).cast("long").alias("n"))


@query("""WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([。！？.!?])', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS l FROM documents),
e AS (SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) AS pos FROM s)
SELECT doc_id, pos, length(sentence) AS chars, CAST(sum(length(sentence)) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS upto FROM e""")
def sentence_split_timed(spark: SparkSession, d: str) -> DataFrame:
    """Sentences with their share of the text, from which times are dealt in proportion."""
    from pyspark.sql import Window as W

    rows = table(spark, d, "documents").select("doc_id", F.posexplode(scalars.sentences(F.col("text"))).alias("p", "sentence"))
    w = W.partitionBy("doc_id").orderBy("p")
    return rows.select("doc_id", (F.col("p") + 1).cast("long").alias("pos"), F.length("sentence").cast("long").alias("chars"), F.sum(F.length("sentence")).over(w).alias("upto"))


@query("""WITH q AS (SELECT item_id, unnest(list_distinct(list_concat(regexp_extract_all(lower(text), '[a-z0-9]{2,}'), regexp_extract_all(lower(text), '[一-鿿]')))) AS w FROM benchmark),
d AS (SELECT doc_id, unnest(list_distinct(list_concat(regexp_extract_all(lower(text), '[a-z0-9]{2,}'), regexp_extract_all(lower(text), '[一-鿿]')))) AS w FROM documents),
s AS (SELECT item_id, doc_id, sum(CASE WHEN regexp_matches(w, '^[0-9]+$') THEN 5 ELSE 2 END)::BIGINT AS score FROM q JOIN d USING (w) GROUP BY ALL)
SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id DESC) AS rank FROM s QUALIFY rank <= 4""")
def tokenise_overlap_topk(spark: SparkSession, d: str) -> DataFrame:
    """The four memories of most shared words for each query, numbers counting 3 more, by an inverted join on words."""
    from pyspark.sql import Window as W

    q = table(spark, d, "benchmark").select("item_id", F.explode(scalars.tokens(F.col("text"))).alias("w"))
    m = table(spark, d, "documents").select("doc_id", F.explode(scalars.tokens(F.col("text"))).alias("w"))
    weight = F.when(F.col("w").rlike("^[0-9]+$"), 5).otherwise(2)
    s = q.join(m, "w").groupBy("item_id", "doc_id").agg(F.sum(weight).alias("score"))
    return s.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(F.desc("score"), F.desc("doc_id"))).cast("long")).filter("rank <= 4")


@query("""SELECT doc_id, t = '' AS blank, length(t) < 30 AS short, regexp_matches(raw, '<\\|[^|]*\\|>|</?think>') AS control, length(regexp_replace(t, '[^a-zA-Z0-9À-ÿ]', '', 'g')) >= 15 AS substantial FROM (
SELECT *, trim(regexp_replace(regexp_replace(raw, '(?s)<think>.*?</think>|</?think>', '', 'g'), '<\\|[^|]*\\|>', '', 'g')) AS t FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '<think>' || substr(text, 1, 20) || '</think>' || substr(text, 1, 40) WHEN 1 THEN '<|end|>' WHEN 2 THEN substr(text, 1, 29) ELSE substr(text, 1, 30) END AS raw FROM documents))""")
def blank_short_control(spark: SparkSession, d: str) -> DataFrame:
    sub = lambda n: F.substring("text", 1, n)
    k = F.col("doc_id") % 4
    raw = F.when(k == 0, F.concat(F.lit("<think>"), sub(20), F.lit("</think>"), sub(40))).when(k == 1, "<|end|>").when(k == 2, sub(29)).otherwise(sub(30))
    t = scalars.without_control(raw)
    return table(spark, d, "documents").select("doc_id", (t == "").alias("blank"), (F.length(t) < 30).alias("short"), scalars.has_control(raw).alias("control"),
        (F.length(F.regexp_replace(t, "[^a-zA-Z0-9À-ÿ]", "")) >= 15).alias("substantial"))


NAMES = "'2024年' || (1 + event_id % 12) || '月' || (1 + event_id % 28) || '日_part0' || (1 + event_id % 5)"


@query(f"""SELECT event_id, '2024-' || lpad(CAST(1 + event_id % 12 AS VARCHAR), 2, '0') || '-' || lpad(CAST(1 + event_id % 28 AS VARCHAR), 2, '0') AS day, '2024' AS year, CAST(1 + event_id % 5 AS INTEGER) AS part, '2024年' || (1 + event_id % 12) || '月' || (1 + event_id % 28) || '日' AS base,
'2024-01-02' AS date, '010203' AS start, 'tag_' || event_id AS tag, CASE event_id % 4 WHEN 0 THEN 'opening' WHEN 1 THEN 'call' WHEN 2 THEN 'comment' ELSE 'unknown' END AS kind, 'a_b_' || event_id AS safe, 'n_' || event_id AS ascii FROM events""")
def file_name_grammar(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    name = F.concat(F.lit("2024年"), 1 + e % 12, F.lit("月"), 1 + e % 28, F.lit("日_part0"), 1 + e % 5)
    rec = scalars.recording_name(F.concat(F.lit("2024-01-02_010203_020304_tag_"), e, F.lit(".mp3")))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("01_Opening", "02_call_x", "03_comment", "04_other")]), (e % 4 + 1).cast("int"))
    return table(spark, d, "events").select(
        "event_id", scalars.chinese_date(name).alias("day"), scalars.year_digits(name).alias("year"), scalars.part_number(name).alias("part"), scalars.base_name(name).alias("base"),
        rec["date"].alias("date"), rec["start"].alias("start"), rec["tag"].alias("tag"), scalars.section_kind(kind).alias("kind"),
        scalars.safe_name(F.concat(F.lit("a/ b:_"), e)).alias("safe"), scalars.ascii_name(F.concat(F.lit("_名n "), e, F.lit("。"))).alias("ascii"))


#: Topics in order of precedence, by English stand-ins for their keywords.
TOPICS = [("ing", "career"), ("tion", "marriage"), ("ción", "money"), ("keit", "family"), ("eau", "study")]


@query("SELECT doc_id, CASE WHEN contains(text, 'ing') THEN 'career' WHEN contains(text, 'tion') THEN 'marriage' WHEN contains(text, 'ción') THEN 'money' WHEN contains(text, 'keit') THEN 'family' WHEN contains(text, 'eau') THEN 'study' ELSE 'other' END AS topic FROM documents")
def topic_first_match(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", scalars.first_match(F.col("text"), TOPICS, "other").alias("topic"))


@query("SELECT event_id, CASE WHEN event_id % 8 BETWEEN 1 AND 5 THEN event_id % 8 END AS score, greatest(0.0, least(10.0, value / 10)) AS temperature, floor(1 / (1 + exp(-20 * (value / 1000 - 0.02))) * 1e6 + 0.5) / 1e6 AS confidence FROM events")
def numeric_clamps(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("event_id") % 8 == 7, "").otherwise((F.col("event_id") % 8).cast("string"))
    return table(spark, d, "events").select("event_id", scalars.clamped_score(text).cast("long").alias("score"), F.greatest(F.lit(0.0), F.least(F.lit(10.0), F.col("value") / 10)).alias("temperature"),
        (F.floor(scalars.sigmoid_confidence(F.col("value") / 1000) * 1e6 + 0.5) / 1e6).alias("confidence"))


@query("SELECT event_id, CASE WHEN try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL THEN 1 ELSE 0 END AS has_k, array_to_string(list_sort(json_keys(props)), '|') AS shape FROM events")
def json_shape(spark: SparkSession, d: str) -> DataFrame:
    """Sorted keys of an object joined by bars."""
    return table(spark, d, "events").select("event_id", F.when(F.get_json_object("props", "$.k").try_cast("long").isNotNull(), 1).otherwise(0).alias("has_k"), F.array_join(F.array_sort(F.json_object_keys("props")), "|").alias("shape"))
