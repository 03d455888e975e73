"""Tags, topics, cleaning and settings over made-up sentences, which the test tables do not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import texts
from dialoom.plans.base import query
from dialoom.sources.tables import table

SAID = (
    "我今年28岁，博士在读", "在美国上班", "医学博士，离异", "硕士，国企工作", "我是程序员", "65岁的父母", "读博的男友", "高端VC", "老公是富二代", "我31岁，本科", "香港做金融", "YC的offer", "短婚，无娃",
    "哈喽，你说！", "你好，听得到吗？我想聊一聊最近的一些事情和家里的关系", "做产品运营", "离异，国企", "女生", "没什么", "清纯类型", "高中教师", "我是19岁，学生",
)
_list = "[" + ", ".join(f"'{s}'" for s in SAID) + "]"
SAID_SQL = f"WITH p AS (SELECT {_list} AS s), t AS (SELECT doc_id, s[doc_id % {len(SAID)} + 1] || CASE WHEN doc_id % 3 = 0 THEN '。' || s[(doc_id // 7) % {len(SAID)} + 1] ELSE '' END AS text FROM documents, p)\n"


def _said(spark: SparkSession, d: str) -> DataFrame:
    s, i = F.array(*[F.lit(x) for x in SAID]), F.col("doc_id")
    second = F.when(i % 3 == 0, F.concat(F.lit("。"), F.get(s, (F.floor(i / 7) % len(SAID)).cast("int")))).otherwise("")
    return table(spark, d, "documents").select("doc_id", F.concat(F.get(s, (i % len(SAID)).cast("int")), second).alias("text"))


def _case(cascade: texts.Cascade, otherwise: str | None = None) -> str:
    one = lambda words: " AND ".join(f"contains(text, '{w}')" for w in words)
    whens = " ".join(f"WHEN {' OR '.join(f'({one(w)})' for w in ways)} THEN '{label}'" for label, ways in cascade)
    return f"CASE {whens} ELSE {'NULL' if otherwise is None else repr(otherwise)} END"


def _every(cascade: texts.Cascade) -> str:
    return "list_filter([" + ", ".join(_case([rule]) for rule in cascade) + "], lambda x: x IS NOT NULL)"


@query(SAID_SQL + f"SELECT doc_id, {_case(texts.IDENTITIES)} AS identity, {_case(texts.IDENTITIES + texts.OCCUPATIONS)} AS extended, {_case(texts.TOPICS, 'other')} AS topic FROM t")
def identity_and_topic(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return _said(spark, d).select("doc_id", texts.identity(text).alias("identity"), texts.identity(text, True).alias("extended"), texts.topic(text).alias("topic"))


@query(SAID_SQL + f"""SELECT doc_id, CASE WHEN age IS NULL AND len(l) = 0 THEN '观众' ELSE coalesce(age || '岁', '') || coalesce(array_to_string(l[1:2], ''), '') END AS tag
FROM (SELECT doc_id, nullif(regexp_extract(text, '(\\d\\d)岁', 1), '') AS age, list_concat(({_every(texts.TAG_DEGREES)})[1:1], {_every(texts.TAG_WORK)}) AS l FROM t)""")
def multi_tags(spark: SparkSession, d: str) -> DataFrame:
    return _said(spark, d).select("doc_id", texts.multi_tag(F.col("text")).alias("tag"))


@query(SAID_SQL + f"""SELECT doc_id, coalesce(age || '岁' || edu, age || '岁' || job, age || '岁', edu, job, nullif(regexp_extract(text, '(男生|女生)', 1), ''), nullif(regexp_extract(text, '(单身|已婚|离异)', 1), ''), '未知') AS tag FROM (SELECT *,
coalesce(CASE WHEN TRY_CAST(regexp_extract(text, '我今年(\\d\\d)岁', 1) AS INT) BETWEEN 20 AND 60 THEN regexp_extract(text, '我今年(\\d\\d)岁', 1) END, CASE WHEN TRY_CAST(regexp_extract(text, '我(\\d\\d)岁', 1) AS INT) BETWEEN 20 AND 60 THEN regexp_extract(text, '我(\\d\\d)岁', 1) END,
CASE WHEN TRY_CAST(regexp_extract(text, '我是(\\d\\d)岁', 1) AS INT) BETWEEN 20 AND 60 THEN regexp_extract(text, '我是(\\d\\d)岁', 1) END, list_filter(regexp_extract_all(text, '(\\d\\d)岁', 1), lambda x: CAST(x AS INT) BETWEEN 20 AND 60)[1]) AS age,
coalesce(nullif(regexp_extract(text, '({texts.TAG_EDUCATION})', 1), ''), CASE regexp_extract(text, '(读硕|读博|读研)', 1) WHEN '读硕' THEN '硕士' WHEN '读博' THEN '博士' WHEN '读研' THEN '读研' END) AS edu,
coalesce(nullif(regexp_extract(text, '我是.*?({texts.TAG_JOBS})', 1), ''), nullif(regexp_extract(text, '({texts.TAG_JOBS})', 1), ''), nullif(regexp_extract(text, '做.*?(开发|设计|销售|运营|管理)', 1), ''), nullif(regexp_extract(text, '(国企|外企|私企|创业)', 1), '')) AS job FROM t)""")
def validated_tags(spark: SparkSession, d: str) -> DataFrame:
    return _said(spark, d).select("doc_id", texts.validated_tag(F.col("text")).alias("tag"))


@query(SAID_SQL + """, b AS (SELECT doc_id, text, translate(lower(text), '，。！？ ', '') AS b FROM t) SELECT doc_id, b AS bare, regexp_matches(b, '你说|你讲|请讲|说吧|说说|讲吧|讲讲|慢慢说|听得到|能听到|在吗|在线吗') AND (regexp_matches(b, '^(哈喽|你好|嗨|喂|hello|hi)') OR length(b) <= 12) AS prompt,
array_to_string(list_transform(list_filter(list_transform(string_split_regex(text, '[。！？!?；;\\n]'), lambda s: trim(s)), lambda s: s <> ''), lambda s: substr(s, 1, 8)), '|') AS sentences FROM b""")
def prompts_and_sentences(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return _said(spark, d).select("doc_id", texts.bare(text).alias("bare"), texts.opening_prompt(text).alias("prompt"), F.array_join(texts.memory_sentences(text, 8), "|").alias("sentences"))


@query("""WITH n AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '0' || doc_id || '_call_Guest ' || lang || '_final' WHEN 1 THEN 'opening_开场白_formal' WHEN 2 THEN '主播开场_0003_' || doc_id WHEN 3 THEN lang || '_评论' WHEN 4 THEN lang || '_00012_77 x' WHEN 5 THEN ' -' || lang || '- ' END AS name,
CASE doc_id % 6 WHEN 0 THEN '1:02:03.5' WHEN 1 THEN '75:30' WHEN 2 THEN ' 12.25 ' WHEN 3 THEN 'soon' WHEN 4 THEN '' END AS t FROM documents)
SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'Guest ' || (SELECT lang FROM documents d WHERE d.doc_id = n.doc_id) WHEN 1 THEN '开场' WHEN 2 THEN '开场' WHEN 6 THEN '' ELSE (SELECT lang FROM documents d WHERE d.doc_id = n.doc_id) END AS title,
CASE doc_id % 6 WHEN 0 THEN 3723.5 WHEN 1 THEN 4530.0 WHEN 2 THEN 12.25 ELSE 0.0 END::DOUBLE AS seconds FROM n""")
def cleaned_titles(spark: SparkSession, d: str) -> DataFrame:
    i, lang = F.col("doc_id"), F.col("lang")
    cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    name = F.when(i % 7 == 0, cat("0", i, "_call_Guest ", lang, "_final")).when(i % 7 == 1, "opening_开场白_formal").when(i % 7 == 2, cat("主播开场_0003_", i)).when(i % 7 == 3, cat(lang, "_评论")).when(i % 7 == 4, cat(lang, "_00012_77 x")).when(i % 7 == 5, cat(" -", lang, "- "))
    t = F.when(i % 6 == 0, "1:02:03.5").when(i % 6 == 1, "75:30").when(i % 6 == 2, " 12.25 ").when(i % 6 == 3, "soon").when(i % 6 == 4, "")
    return table(spark, d, "documents").select("doc_id", texts.clean_title(name).alias("title"), texts.seconds_of(t).alias("seconds"))


@query("""SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y年%-m月%-d日 %H:%M:%S') AS shown, CASE WHEN length(props || props || props) <= 40 THEN props || props || props ELSE substr(props || props || props, 1, 24) || '...' || right(props || props || props, 12) END AS path,
CASE event_id % 3 WHEN 0 THEN 'fixed_v1' WHEN 1 THEN 'old; fixed_v1' ELSE 'x; fixed_v1' END AS notes, CASE event_id % 4 WHEN 0 THEN '$' WHEN 1 THEN '$.turns[3].start' WHEN 2 THEN '$.meta.id' ELSE '$.[0]' END AS at FROM events""")
def shown_values(spark: SparkSession, d: str) -> DataFrame:
    """Times in their zone, shortened paths, notes added once, and paths of issues."""
    i = F.col("event_id")
    old = F.when(i % 3 == 0, None).when(i % 3 == 1, "old").otherwise("x; fixed_v1")
    parts = F.when(i % 4 == 0, F.array().cast("array<string>")).when(i % 4 == 1, F.array(F.lit("turns"), F.lit("3"), F.lit("start"))).when(i % 4 == 2, F.array(F.lit("meta"), F.lit("id"))).otherwise(F.array(F.lit("0")))
    at = F.when(i % 4 == 3, F.lit("$.[0]")).otherwise(texts.issue_path(parts))
    return table(spark, d, "events").select("event_id", texts.shown_time(F.col("ts")).alias("shown"), texts.shown_path(F.concat("props", "props", "props"), 40).alias("path"), texts.noted(old, "fixed_v1").alias("notes"), at.alias("at"))


@query("""WITH c AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN '-3' WHEN 2 THEN 'many' END AS v FROM events), n AS (SELECT *, TRY_CAST(v AS DOUBLE) AS x FROM c)
SELECT event_id, CAST(CASE WHEN floor(x) > 0 THEN floor(x) ELSE 256 END AS BIGINT) AS max_new_tokens, CASE WHEN x IS NULL THEN 0.7 ELSE greatest(0, least(10, x)) END AS temperature, CASE WHEN x IS NULL THEN 0.95 ELSE greatest(0, least(1, x)) END AS top_p,
CASE WHEN event_id % 20 >= 3 THEN (event_id % 10) / 100.0 < 0.05 AND (event_id % 12) / 100.0 < 0.08 END AS monologue FROM n""")
def generation_settings(spark: SparkSession, d: str) -> DataFrame:
    """Settings within their bounds, and speech that looks like a monologue."""
    i = F.col("event_id")
    v = F.when(i % 4 == 0, F.col("value").cast("string")).when(i % 4 == 1, "-3").when(i % 4 == 2, "many")
    return table(spark, d, "events").select(
        "event_id", texts.positive_int(v, 256).alias("max_new_tokens"), texts.clamped(v, 0.7, 0, 10).alias("temperature"), texts.clamped(v, 0.95, 0, 1).alias("top_p"), texts.monologue(i % 20, (i % 10) / 100.0, (i % 12) / 100.0).alias("monologue"))


@query("""WITH w AS (SELECT doc_id, unnest(range(0, 12)) AS k FROM documents), l AS (SELECT doc_id, k, CASE WHEN (k * 5 < 18 AND k * 5 + 5 > 7) OR (k * 5 < 40 + doc_id % 9 AND k * 5 + 5 > 33) THEN doc_id + k ELSE -100 END AS label FROM w)
SELECT doc_id, array_to_string(list(label ORDER BY k) FILTER (WHERE k >= 12 - 8 - doc_id % 3), ' ') AS labels FROM l GROUP BY doc_id""")
def answer_label_masks(spark: SparkSession, d: str) -> DataFrame:
    """Labels of answers alone, of the last tokens that a sample may have."""
    i = F.col("doc_id")
    tokens = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.struct((k * 5).alias("start"), (k * 5 + 5).alias("end"), (i + k).alias("id")))
    spans = F.array(F.struct(F.lit(7).cast("long").alias("start"), F.lit(18).cast("long").alias("end")), F.struct(F.lit(33).cast("long").alias("start"), (i % 9 + 40).alias("end")))
    masks = [texts.label_mask(tokens, spans, n) for n in (8, 9, 10)]
    return table(spark, d, "documents").select("doc_id", F.array_join(F.when(i % 3 == 0, masks[0]).when(i % 3 == 1, masks[1]).otherwise(masks[2]).cast("array<string>"), " ").alias("labels"))
