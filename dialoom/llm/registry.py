"""Registered queries of the subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import bpe_transducer, context_tree, decontamination, filter_audit, fingerprints, line_dedup, minhash_dedup, quality, sharding, spelling, substring_dedup, suffix_dedup, token_counts
from dialoom.llm.session import documents


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.repeated_strings(documents(spark, sf_dir)))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir)).drop("body", "distance")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_passages(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", substring_dedup.n_removed().alias("n_removed"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.remove_boilerplate(documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir))


def op9_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(documents(spark, sf_dir))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.round_trip(documents(spark, sf_dir), _tokenizer("byte_bpe_multi_50k.tiktoken"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_audit(documents(spark, sf_dir))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(filter_audit.labelled(filter_audit.flags(documents(spark, sf_dir)), labels))


OP6_SQL = r"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key FROM l),
b AS (SELECT key, min(struct_pack(d := doc_id, p := pos)) AS first FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 10),
j AS (SELECT k.doc_id, k.pos, k.line, b.key IS NOT NULL AND struct_pack(d := k.doc_id, p := k.pos) <> b.first AS gone FROM k LEFT JOIN b ON k.key = b.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""

OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
m AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
  map {'A': len(words) < 100, 'B': 100 * list_unique(words) < 80 * len(words), 'C': 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 10 * length(d.text),
    'D': regexp_matches(d.text, '[#$%&*|]'), 'E': coalesce(d.doc_id > m.least, false)} AS fails
  FROM d JOIN m ON d.text = m.text LEFT JOIN l ON d.doc_id = l.doc_id),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT [a.c, b.c, e.c, g.c, h.c] AS letters FROM x a, x b, x e, x g, x h WHERE len(list_distinct([a.c, b.c, e.c, g.c, h.c])) = 5),
r AS (SELECT part, good, toxic, array_to_string(letters, '') AS filter_order, list_transform(letters, lambda c: fails[c]) AS failed FROM f, o),
s AS (SELECT *, coalesce(list_position(failed, true), 6) AS first, len(list_filter(failed, lambda b: b)) AS n_fails FROM r),
e AS (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM s),
n AS (SELECT part, filter_order, step, count(*) FILTER (WHERE first > step) AS kept, count(*) FILTER (WHERE first = step) AS removed,
  count(*) FILTER (WHERE failed[step] AND first < step) AS redundant, count(*) FILTER (WHERE failed[step] AND n_fails = 1) AS unique_fails,
  count(*) FILTER (WHERE first = step AND good) AS good_lost, count(*) FILTER (WHERE first = step AND toxic) AS toxic_lost FROM e GROUP BY ALL)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM n
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_array_dedup, op2_minhash_dedup, op3_quality_rules, op4_token_counts, op5_substring_dedup, op6_line_dedup, op7_decontamination, op8_sharding, op9_context_tree_scores, op10_bpe_codec, op11_spelling_variants, op12_fingerprints, op13_filter_audit)
}
ORACLE_SQL: dict[str, str] = {"op6_line_dedup": OP6_SQL, "op13_filter_audit": OP13_SQL}
