"""Quality, lines, leaks, shards, tokens and scores on small tables."""

from __future__ import annotations

import base64
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dialoom.llm import bpe_transducer, context_tree, decontamination, line_dedup, quality, sharding, token_counts
from tests.llm import brute
from tests.llm.conftest import same, table

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", "it's 'S I'Ll they're 'x' ''s\t\n \x0b", "a  b \x1c\x1d×÷ _ __ ½²ª", "aaaa" * 300, "日本語テスト 123٣٤", "a<|endoftext|>b <|endoftext|>", "\x85\xa0  x​", " " * 200, "ab" * 400, "😀👍🏽 é"]


def test_statistics(docs, rows):
    got = quality.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    same(got, [(i, *brute.statistics(t)) for i, t in rows])


def test_outliers_go_and_clean_documents_stay(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(400)]
    good = [(k, "\n".join(" ".join(rng.choice(words, 12)) for _ in range(rng.integers(8, 30)))) for k in range(300)]
    bad = [(1000 + k, " ".join("#" * int(rng.integers(3, 9)) + w for w in rng.choice(words, 120))) for k in range(10)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in good + bad], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in quality.keep(docs).collect()}
    assert not kept & {i for i, _ in bad} and len(kept & {i for i, _ in good}) >= 297
    assert quality.keep(docs.limit(0)).count() == 0 and quality.keep(docs).columns == docs.columns


def test_small_groups_are_judged_by_all_rows_of_their_language(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(400)]
    good = lambda: "\n".join(" ".join(rng.choice(words, 12)) for _ in range(rng.integers(8, 30)))
    junk = lambda: " ".join("#" * int(rng.integers(3, 9)) + w for w in rng.choice(words, 120))
    large = [(k, good(), "en", f"s{k % 2}") for k in range(300)]
    odd = [(1000, junk(), "en", "rare"), (1001, good(), "en", "fine"), (1002, junk(), "xx", "rare"), (1003, good(), "xx", "fine")]
    pool = [(2000 + k, junk(), "en", f"pool{k % 3}") for k in range(60)]
    docs = spark.createDataFrame([(i, t, a, b, len(t)) for i, t, a, b in large + odd + pool], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in quality.keep(docs).collect()}
    assert kept & set(range(1000, 3000)) == {1001, 1003} and len(kept & set(range(300))) >= 294


def test_lines(spark):
    sites = [(k, f"own {k} text that is longer than the shared one\nshared line\n\nshared line", "en", f"s{k}", 9) for k in range(12)]
    few = [(100 + k, f"mine {k} is some text\nrare line", "en", f"s{k}", 9) for k in range(9)]
    copies = [(200 + k, "copied first line\ncopied second line", "en", f"s{k}", 9) for k in range(12)]
    odd = [(300, None, "en", "s0", None), (301, "", "en", None, 0), (302, "  shared line  \nand a good deal of other text here", "en", "s3", 9)]
    docs = spark.createDataFrame(sites + few + copies + odd, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(docs, keep_copies=True).collect()}
    assert got[0].n_removed == 1 and got[0].text == "own 0 text that is longer than the shared one\nshared line\n"
    assert all(got[k].n_removed == 2 and got[k].text == f"own {k} text that is longer than the shared one\n" for k in range(1, 12))
    assert all(got[100 + k].n_removed == 0 for k in range(9)), "nine sites are under the threshold"
    assert all(got[200 + k].n_removed == 0 for k in range(12)), "copies keep their lines"
    assert (got[300].text, got[300].n_lines, got[301].text, got[302].n_removed) == (None, 0, "", 1)
    assert got[302].text == "and a good deal of other text here"
    bare = {r.doc_id: r for r in line_dedup.remove_boilerplate(docs).collect()}
    assert bare[200].text == copies[0][1] and all((bare[200 + k].text, bare[200 + k].n_removed) == ("", 2) for k in range(1, 12)), "copies are no exception"
    assert all(bare[k].text == got[k].text for k in range(12))
    clean = line_dedup.clean(docs)
    assert clean.columns == docs.columns and clean.filter("doc_id = 302").first().n_chars == len(got[302].text)


def test_lines_of_documents_that_are_mostly_boilerplate(spark):
    menu, licence = "home products about contact imprint", "all rights reserved, no reproduction"
    mostly = [(k, f"{menu}\nown {k}\n{licence}", "en", f"s{k}", 9) for k in range(12)]
    only = [(50, f"{menu}\n{licence}", "en", "s1", 9), (51, f"{licence}\n{menu}", "en", "s2", 9), (52, menu, "en", "s3", 9)]
    copies = [(100 + k, f"first copied line\n\nsecond copied line {' ' * (k % 2)}", "en", f"s{k}", 9) for k in range(10)]
    nine = [(200 + k, f"{licence}\n{menu}\n{licence}\nheld by nine", "en", f"s{k}", 9) for k in range(9)]
    docs = spark.createDataFrame(mostly + only + copies + nine, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(docs, keep_copies=True).collect()}
    assert got[0].n_removed == 0, "the first document keeps each line once"
    assert all((got[k].text, got[k].n_removed) == (f"own {k}", 2) for k in range(1, 12))
    assert all((got[k].text, got[k].n_removed) == ("", n) for k, n in ((50, 2), (51, 2), (52, 1))), "two alike are no spread"
    assert all(got[100 + k].n_removed == 0 for k in range(10)), "their set of lines is on ten sites"
    assert all((got[200 + k].text, got[200 + k].n_removed) == ("held by nine", 3) for k in range(9))


def test_lines_with_clashing_columns(docs, empty):
    out = line_dedup.clean(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert line_dedup.remove_boilerplate(empty).count() == 0


ITEMS = [(1, None), (2, ""), (3, "One"), (4, "alpha beta gamma"), (5, " ".join(f"w{k}" for k in range(14))), (5, " ".join(f"w{k}" for k in range(14))), (None, "zz-top 9"), (6, "a a a a a a a a a a a")]


def test_leaks(spark, docs, rows):
    extra = [(400, "ALPHA, beta; gamma! w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 zz top 9"), (401, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (402, "alpha beta"), (403, "gamma"), (404, "a " * 30)]
    every = rows + extra
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontamination.decontaminate(table(spark, every), items)
    got = got.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), F.col("n_hit") > 0).collect()
    same(got, brute.leaks(every, ITEMS))
    kept = decontamination.clean(table(spark, every), items)
    assert kept.columns == docs.columns and kept.count() == sum(not x[-1] for x in brute.leaks(every, ITEMS))
    assert decontamination.decontaminate(docs, items.limit(0)).filter("n_hit > 0").count() == 0
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0


def test_items_that_share_an_id_count_once(spark):
    docs = spark.createDataFrame([(1, "alpha beta and gamma delta"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(5, "alpha beta"), (5, "gamma delta"), (7, "alpha beta")], "item_id long, text string")
    got = {r.doc_id: (r.items, r.n_hit) for r in decontamination.decontaminate(docs, items).collect()}
    assert got == {1: (["5", "7"], 4), 2: ([], 0)}


def test_proximity(spark):
    texts = ["a x x b", "a b", "b x x x x a", "a", None, "B a"]
    index = decontamination.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).cache()
    queries = spark.createDataFrame([(1, "a b"), (2, "b A"), (3, "a zz"), (4, ""), (5, "x")], "query int, text string")
    for within, want in ((2, {1, 5}), (4, {0, 1, 5}), (6, {0, 1, 2, 5})):
        got = {(r.query, r.id) for r in decontamination.search_near(index, queries, within).collect()}
        assert got == {(q, d) for q in "12" for d in want} | {("5", 0), ("5", 2)}


def test_many_buckets(spark, rows, monkeypatch):
    monkeypatch.setattr(decontamination, "BUCKET_BYTES", 2000)
    every = rows[:40] + [(400, "alpha beta gamma w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 zz top 9")] * 2
    got = decontamination.decontaminate(table(spark, every), spark.createDataFrame(ITEMS, "item_id long, text string"))
    same(got.select("doc_id", "n_words", "n_hit", F.size("items")).collect(), [x[:4] for x in brute.leaks(every, ITEMS)])


def test_shards(docs, rows):
    got = sharding.shard_rows(docs, 7).collect()
    assert len(got) == len(rows)
    same([(r.doc_id, r["size"], r.text_crc32) for r in got], [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows])
    by = [sorted(r.slot for r in got if r.shard == s) for s in range(7)]
    assert all(x == list(range(len(x))) for x in by) and max(map(len, by)) - min(map(len, by)) <= 1
    assert sorted(map(tuple, sharding.shard_rows(docs.repartition(5), 7).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert sharding.shard_rows(docs.limit(0), 7).count() == 0


def test_draws_beyond_what_numpy_takes():
    """Exact at any size: against numpy's law where it has one, and the first moments beyond."""
    from math import comb

    rng = np.random.default_rng(1)
    for good, bad, drawn in ((5, 7, 4), (30, 2, 10), (0, 5, 3), (5, 0, 3), (4, 4, 8), (3, 9, 0)):
        lo, hi = max(0, drawn - bad), min(good, drawn)
        draws = np.bincount([sharding.inverted(rng, good, bad, drawn) for _ in range(3000)], minlength=hi + 1)
        law = [comb(good, k) * comb(bad, drawn - k) / comb(good + bad, drawn) for k in range(hi + 1)]
        assert draws[:lo].sum() == 0 and len(draws) == hi + 1 and np.abs(draws / 3000 - law).max() < 0.035
    good, bad, drawn = 50_000_000, 1_950_000_000, 40_000_000
    k = np.array([sharding.hypergeometric(rng, good, bad, drawn) for _ in range(300)])
    mean, var = drawn * 0.025, drawn * 0.025 * 0.975 * (2e9 - drawn) / (2e9 - 1)
    assert abs(k.mean() - mean) < 4 * (var / 300) ** 0.5 and 0.7 < k.var() / var < 1.35
    rows, sizes = {b: 500_000_000 for b in range(5)}, [625_000_000] * 4
    m = sharding.communication_matrix(rows, sizes, 3)
    assert [sum(x) for x in m.values()] == list(rows.values()) and [sum(x) for x in zip(*m.values(), strict=True)] == sizes


def test_matrix_margins_and_mean():
    rows, sizes = {0: 1000, 1: 10, 2: 0, 3: 500}, [504, 503, 503]
    m = sharding.communication_matrix(rows, sizes, 1)
    assert [sum(m[b]) for b in rows] == list(rows.values()) and [sum(x) for x in zip(*m.values(), strict=True)] == sizes
    draws = [sharding.communication_matrix({0: 30, 1: 30}, [20, 20, 20], s)[0][0] for s in range(2000)]
    assert abs(np.mean(draws) - 10) < 0.3 and abs(np.var(draws) - 20 * 0.5 * 0.5 * 40 / 59) < 0.5


def test_token_counts(spark, docs, rows):
    library = Tokenizer.from_file(JSON)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    got = token_counts.count_tokens(docs, JSON)
    same(got.select("doc_id", "n_bytes", "n_tokens").collect(), want)
    assert got.filter("over_limit <> (n_tokens > 1024)").count() == 0 and token_counts.count_tokens(docs.limit(0), JSON).count() == 0
    assert token_counts.count_texts([*TEXTS, None], JSON) == [*(len(e.ids) for e in library.encode_batch(TEXTS, add_special_tokens=False)), 0]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec(docs, rows, library):
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha((t or "").encode())))
    same(bpe_transducer.round_trip(docs, RANKS).collect(), want)
    assert bpe_transducer.round_trip(docs.limit(0), RANKS).count() == 0


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_text_round_trips(library, text):
    ids = np.frombuffer(bpe_transducer.encode_text(text, RANKS), "<u4").tolist()
    assert ids == library.encode_ordinary(text)
    assert "".join(bpe_transducer.decode_stream(ids, {i: b for b, i in bpe_transducer.load_ranks(RANKS).items()}, 1)) == text


@given(st.binary(max_size=40), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_utf8_stream_is_that_of_the_whole(data, step):
    stream = bpe_transducer.Utf8Stream()
    got = "".join(stream.feed(data[k : k + step]) for k in range(0, len(data), step)) + stream.close()
    assert got == data.decode("utf-8", "replace")


def test_long_pieces_within_few_bytes(library, monkeypatch):
    """A machine that forgets in the midst of a piece goes on as if it had not."""
    monkeypatch.setattr(bpe_transducer, "STATE_BYTES", 20_000)
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("etaoinshrdlu"), 30_000))
    machine = bpe_transducer.MergeTransducer(bpe_transducer.load_ranks(RANKS))
    most, reset = [], machine._reset
    machine._reset = lambda keep=None: (most.append(machine.held), reset(keep))[1]
    got = machine.encode_piece(text.encode())
    assert got == library.encode_ordinary(text) and len(most) > 10 and max(most) < 22_000


def test_texts_that_are_not_utf8(spark):
    docs = spark.sql("select 1L as doc_id, cast(X'61FFC3' as string) as text union all select 2L, 'b'")
    got = {r.doc_id: r.text for r in bpe_transducer.recode(docs, RANKS).collect()}
    assert got == {1: "a\ufffd\ufffd", 2: "b"}
    assert token_counts.count_tokens(docs, JSON).count() == 2


def test_scores(spark, docs, rows):
    got = context_tree.score(docs).collect()
    assert len(got) == len(rows)
    train = [(i, t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    count = brute.Counter(w for _, t in train for w in [*brute.WORD.findall(brute.lower(t)), None])
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        w = [*brute.WORD.findall(brute.lower(t)), None]
        base = sum(np.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want.append((i, len(w), sum(count[x] > 0 for x in w), n, round(base, 6)))
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], want)
    assert all(r.score < 0 for r in got) and context_tree.score(docs.limit(0)).count() == 0


def test_context_tree_is_a_probability_and_learns():
    import pyarrow as pa

    data, offsets = context_tree.flat(pa.array(["abababab " * 30, "the cat sat"]))
    value, _ = context_tree.grams(data, offsets)
    codes, counts = context_tree.counted(value, np.ones(len(value), bool))
    nodes = context_tree.Nodes(codes, counts)
    top = context_tree.Top(*nodes.above())
    for context in (int(codes[0]) >> 8, 0x4142434445):
        every = np.array([context << 8 | b for b in range(256)], np.uint64)
        p = np.exp(context_tree.log_probabilities(every, nodes, top))
        assert abs(p.sum() - 1) < 1e-9 and p.min() > 0
    assert context_tree.log_probabilities(codes, nodes, top)[counts.argmax()] > np.log(0.5)
    assert np.allclose(context_tree.log_kt(np.array([0.0, 1.0, 2.0]), np.array([0.0, 0.0, 1.0])), np.log([1, 0.5, 0.5 * 0.75 * 0.5 / 3]))
