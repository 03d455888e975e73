"""The pipeline's stages on the small tables, each on what the one before it left."""

from __future__ import annotations

import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline
from dialoom.llm import registry
from tests.llm import brute


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_contract_columns(name):
    assert name.startswith("op") and (name in registry.ORACLE_SQL) == (name in ("op6_line_dedup", "op13_filter_audit"))


def test_stages(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()} if k < 5 else {}
        stage(spark, docs, data).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if k < 4:
            assert docs.columns == columns and set(kept[name]) <= set(before)
        if k == 0:
            assert all(not brute.statistics(before[i])[-1] for i in kept[name])
        elif k == 1:
            assert set(kept[name]) == set(before) and all(r.n_chars == len(r.text) for r in kept[name].values() if r.text != before[r.doc_id])
        elif k == 2:
            assert set(kept[name]) == {i for i, _, _, first in brute.near(list(before.items())) if first}
        elif k == 3:
            items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(kept[name]) == {x[0] for x in brute.leaks(list(before.items()), items) if not x[-1]}
    import tiktoken

    from dialoom.llm.bpe_transducer import load_ranks

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path(corpus_pipeline.TOKENIZER)), special_tokens={})
    for i, row in kept["byte-level BPE"].items():
        text = kept["benchmark decontamination"][i].text
        assert row.ids_sha256 == brute.sha(np.array(library.encode_ordinary(text), "<u4").tobytes()) and row.decoded_sha256 == brute.sha(text.encode())
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, data).collect())
    assert got == sorted(tuple(r) for r in kept["byte-level BPE"].values())


STAGES = {name: stage for name, stage in corpus_pipeline.STAGES[:4]}
CLASHES = "__id,__body,__gone,__m,id,body,gone,node,of,key,row,c0,c1,Doc_ID_2,N".split(",")


def clashing(spark, rows):
    """documents with columns whose names the stages use themselves."""
    full = [(i, t, "en", f"s{k % 14}", len(t or ""), *[f"{c}{k}" for c in CLASHES]) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stage_passes_any_columns(spark, data, rows, name):
    docs = clashing(spark, rows)
    done = STAGES[name](spark, docs, data)
    assert done.columns == docs.columns
    before = {r["__id"]: r for r in docs.collect()}
    for r in done.collect():
        was = before[r["__id"]]
        assert [r[c] for c in ["doc_id", "lang", "source", *CLASHES]] == [was[c] for c in ["doc_id", "lang", "source", *CLASHES]] and (name == "line dedup" or r.text == was.text)
    assert STAGES[name](spark, docs.limit(0), data).collect() == []


def test_quality_stage_is_the_operators_verdict(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    verdict = {r.doc_id for r in registry.op3_quality_rules(spark, data).filter("kept").collect()}
    assert {r.doc_id for r in STAGES["quality rules"](spark, docs, data).select("doc_id").collect()} == verdict


def test_line_stage_removes_what_many_sites_share(spark, data):
    shared, own = "A line that every site has", "x"
    rows = [(k, f"{own} {k}\n{shared}\n{own} end {k}") for k in range(14)] + [(50, shared), (51, None), (52, ""), (53, f"{shared}\n{shared} ")]
    got = {r.doc_id: (r.text, r.n_chars) for r in STAGES["line dedup"](spark, clashing(spark, rows), data).collect()}
    # the first keeps the line once; a text of such lines only is a copy, and near-duplicate removal is for those
    assert got[0][0] == rows[0][1] and all(got[k] == (f"x {k}\nx end {k}", len(f"x {k}\nx end {k}")) for k in range(1, 14))
    assert got[51][0] is None and got[52][0] == "" and len(got) == len(rows)


def test_rows_that_share_an_id_keep_their_own_fate(spark, data):
    say = lambda s: " ".join(f"{s}{k}" for k in range(40))
    rows = [(1, say("w")), (2, say("w")), (2, say("other")), (None, say("n")), (None, say("m")), (None, say("w")), (3, say("m")), (4, say("q")), (4, say("q")), (5, None), (5, "")]
    got = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:1]) for r in STAGES["MinHash near-dedup"](spark, clashing(spark, rows), data).collect())
    # a null id is the least, as it is for the operator
    assert got == [(False, 2, "o"), (False, 4, "q"), (False, 4, "q"), (False, 5, ""), (False, 5, ""), (True, 0, "m"), (True, 0, "n"), (True, 0, "w")]
    words = spark.createDataFrame([("b", say("w")), ("a", say("w")), ("c", say("z"))], "name string, body string")
    from dialoom.llm import minhash_dedup

    kept = [r.name for r in minhash_dedup.one_of_each(words, "name", "body").collect()]
    assert sorted(kept) == ["a", "c"]


def test_texts_that_are_not_utf8(spark, data):
    from dialoom.llm import substring_dedup

    rows = spark.createDataFrame([(1, b"\xff\xfe word " * 60), (2, b"\xff\xfe word " * 60), (3, b"plain words " * 60)], "doc_id long, raw binary")
    docs = rows.selectExpr("doc_id", "cast(raw as string) text", "'en' lang", "'s' source", "0L n_chars")
    got = {r.doc_id: r.n_words for r in substring_dedup.repeated_passages(docs).select("doc_id", "n_words").collect()}
    assert got == {1: 120, 2: 120, 3: 120}
    for stage in STAGES.values():
        stage(spark, docs, data).count()
