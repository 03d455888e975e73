"""Corpus pipeline: quality, boilerplate lines, near duplicates, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows it gets.  All but
the last return the columns of ``documents``; the last returns one row of ids
for each document left.

Cases, besides those of the operators: a null or empty text fails the quality
rules and goes there; what a later stage leaves empty stays, with no words, no
links and no ids; a null id is an id like others; very long texts are worked on
whole; rows that repeat an id and a text share their fate, and rows that repeat
an id alone are several documents, each with its own; ties are settled by the
smallest id (among texts of one id, or without one, by a hash of the text);
columns besides those of ``documents`` pass through whatever their names; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dialoom.llm import bpe_transducer, decontamination, line_dedup, minhash_dedup, quality
from dialoom.llm.session import documents, store

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality.keep(docs)


def line_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sites share; ``n_chars`` follows the text.  Whole copies wait for the next stage."""
    return line_dedup.clean(docs, keep_copies=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash_dedup.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of the documents left."""
    import public_tokenizers

    return bpe_transducer.round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_boilerplate),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", token_ids),
]

#: MinHash signatures and transducers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs, f"stage{k}")
    return docs
