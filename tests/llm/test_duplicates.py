"""Suffix arrays, recompression, MinHash and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from dialoom.llm import components, minhash_dedup, repeats, substring_dedup, suffix_array, suffix_dedup, text
from tests.llm import brute
from tests.llm.conftest import same


def test_strings(docs, rows):
    same(suffix_dedup.digest(suffix_dedup.repeated_strings(docs)).collect(), brute.strings(rows))


@pytest.mark.parametrize("width", [16, 80, 100])
def test_strings_of_other_widths(docs, rows, width):
    same(suffix_dedup.digest(suffix_dedup.repeated_strings(docs, width)).collect(), brute.strings(rows, width))


def test_strings_with_little_memory_and_poor_hashes(docs, rows):
    """Shards ten times their memory, queues and arrays in files; hashes of 16 bits decide nothing."""
    got = suffix_dedup.repeated_strings(docs, memory=20_000, shard=200_000, bits=16)
    same(suffix_dedup.digest(got).collect(), brute.strings(rows))


def test_spans_with_equal_hashes_are_compared():
    data = np.frombuffer(b"abcabdabcxyzabd", np.uint8)
    start, size = np.arange(0, 15, 3), np.full(5, 3)
    assert repeats.classes(data, start, size, np.zeros(5, np.uint64)).tolist() == [0, 1, 0, 3, 1]


@pytest.mark.parametrize("memory,block", [(1 << 20, 1 << 16), (2000, 7), (400, 64)])
def test_suffix_order(memory, block):
    rng = random.Random(3)
    for turn in range(15):
        letters = rng.choice([b"ab", b"abcdef", b"a", b"\0\1"])
        base = bytes(rng.choice(letters) for _ in range(150))
        pieces = [base[(k := rng.randrange(100)) : k + rng.randrange(1, 100)] for _ in range(rng.randrange(1, 5))]
        if turn == 0:  # repeats far longer than the limit of common prefixes
            pieces = [b"abc" * 200, b"bc" + b"abc" * 180 + b"x", b"abc" * 200]
        data = np.frombuffer(b"".join(p + b"\0" for p in pieces), np.uint8)
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        order = suffix_array.SuffixOrder(data, ends, memory, block, limit=90)
        positions, common = (np.concatenate(x).tolist() for x in zip(*order, strict=True))
        assert order.spilled > 0 or memory > 2000 or turn > 0
        order.close()
        plain = [-1 if i in ends else int(x) for i, x in enumerate(data)]
        cut = lambda i: plain[i : next((int(e) for e in ends if e >= i), len(plain))]
        keys = [cut(i) for i in positions]
        assert keys == sorted(keys, reverse=True) and len(set(positions)) == len(positions) >= len(data)
        for k in range(1, len(positions)):
            a, b = keys[k - 1], keys[k]
            n = next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            if a and b:
                assert min(common[k], n) == min(n, 90), (a, b, common[k])
                assert common[k] == min(n, 90) or n == min(len(a), len(b))


def test_passages(docs, rows):
    from pyspark.sql import functions as F

    found = substring_dedup.repeated_passages(docs)
    got = found.select("doc_id", "n_words", substring_dedup.n_removed().alias("n"), F.sha2(F.encode("kept", "UTF-8"), 256))
    same(got.collect(), brute.passages(rows))
    poor = substring_dedup.repeated_passages(docs, bits=16)
    same(poor.select("doc_id", "n_words", substring_dedup.n_removed().alias("n"), F.sha2(F.encode("kept", "UTF-8"), 256)).collect(), brute.passages(rows))


def test_equal_windows_are_filed_alike():
    rng = random.Random(1)
    for _ in range(20):
        core = [rng.choice("abc") for _ in range(60)]
        texts = [" ".join([rng.choice("abcd") for _ in range(rng.randrange(40))] + core + [rng.choice("abcd") for _ in range(rng.randrange(40))]) for _ in range(2)]
        data, offsets = text.flat(pa.chunked_array([pa.array(texts)]))
        starts, ends, first = text.spans(data, offsets, text.WORD)
        words = text.word_hashes(data, starts, ends)
        rows, at, names = substring_dedup.filed(words, first, 50)
        hashes = text.windows(words, 50)[at]
        by = [dict(zip(hashes[rows == r].tolist(), names[rows == r].tolist(), strict=True)) for r in (0, 1)]
        both = set(by[0]) & set(by[1])
        assert len(both) >= 11 or len(set(core)) < 3
        assert all(by[0][h] == by[1][h] for h in both)


def test_near_duplicates(docs, rows):
    same(minhash_dedup.near_duplicates(docs).collect(), brute.near(rows))
    kept = minhash_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    want = [i for i, _, _, k in brute.near(rows) if k]
    same([(r.doc_id,) for r in kept.select("doc_id").collect()], [(i,) for i in want])


def test_long_lists_in_parts(docs, rows, monkeypatch):
    """Executors load the module anew, so parts are tried on one call of the stages here."""
    sigs = np.array([[k // 3] * minhash_dedup.COORDINATES for k in range(12)], np.uint16)
    a, b, strength = minhash_dedup._pairs(np.zeros(12, np.uint64), np.arange(12), np.arange(12), np.arange(12), np.full(12, 9), sigs)
    assert len(a) == 4 * 3 and (strength == minhash_dedup.COORDINATES).all()
    assert len(minhash_dedup.forest(a, b, strength, 12)) == 4 * 2


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 101), (101, 102), (200, 100), (7, 7), (500, 501), (500, 501)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 31)} | {101: 100, 102: 100, 200: 100, 501: 500}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(empty):
    assert suffix_dedup.repeated_strings(empty).count() == 0
    assert substring_dedup.repeated_passages(empty).count() == 0
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_span_hashes_do_not_depend_on_place():
    data, offsets = text.flat(pa.array(["abc abc", None, "", "x abc"]))
    starts, ends, first = text.spans(data, offsets, text.WORD)
    h = text.word_hashes(data, starts, ends)
    assert first.tolist() == [0, 2, 2, 2, 4] and h[0] == h[1] == h[3] != h[2]
