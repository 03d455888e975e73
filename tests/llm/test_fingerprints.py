"""Fingerprints: edits against plain slices, likeness against the same sampling in plain Python and against exact similarity."""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import xxhash

from dialoom.llm import fingerprints, registry
from tests.llm.conftest import table


def weights(text):
    return Counter(w for w in re.split(r"[\x20\x09-\x0D]+", text) if w)


def similarity(a, b):
    every = set(a) | set(b)
    return sum(min(a[w], b[w]) for w in every) / sum(max(a[w], b[w]) for w in every) if every else 1.0


def samples(text, number=fingerprints.SAMPLES):
    """The (word, t) of each sample, by the definition."""
    best = [(math.inf, None)] * number
    for word, weight in weights(text).items():
        base = xxhash.xxh64_intdigest(struct.pack("<Q", xxhash.xxh64_intdigest(word.encode(), 42)), 42)
        for k in range(number):
            one, two = (xxhash.xxh64_intdigest(struct.pack("<i", 2 * k + j), base) for j in (0, 1))
            piece = lambda x, at: ((x >> at & (1 << 25) - 1) + 0.5) / (1 << 25)
            r = -math.log(piece(one, 0) * piece(one, 25))
            c = -math.log(piece(two, 0) * piece(two, 25))
            b = ((one >> 50) * 16384 + (two >> 50)) / (1 << 28)
            t = math.floor(math.log(weight) / r + b)
            best[k] = min(best[k], (math.log(c) - r * (t - b + 1), (word, t)), key=lambda x: x[0])
    return [x[1] for x in best]


def agree(a, b):
    return sum(x == y for x, y in zip(a, b, strict=True)) / len(a)


def followed(rows):
    """Each text with its number of rows, its edited form and the next text, for rows (id, text) in order."""
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        q = len(text) // 4
        yield i, text, text[: len(text) - q] + following[:q], following


def test_whole_table(spark, data):
    got = {r.doc_id: r for r in registry.op12_fingerprints(spark, data).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect())
    assert len(got) == len(rows)
    errors, prints = [], defaultdict(set)
    for k, (i, text, edited, following) in enumerate(followed(rows)):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors += [r.near_edited - similarity(weights(text), weights(edited)), r.near_next - similarity(weights(text), weights(following))]
        prints[text].add(r.fingerprint)
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 4 * fingerprints.SAMPLES
        if k % 40 == 0:
            mine = samples(text)
            assert r.near_edited == agree(mine, samples(edited)) and r.near_next == agree(mine, samples(following))
    assert all(len(p) == 1 for p in prints.values()) and len(set.union(*prints.values())) > 0.98 * len(prints)
    # documents share words and so samples: their errors are not independent, and only each one's size is bounded here
    assert max(map(abs, errors)) < 5 * 0.5 / fingerprints.SAMPLES**0.5


def test_law_of_the_samples():
    """The share of equal samples is the generalised Jaccard similarity, for sets, for weights, and for both."""
    number = 4000
    words = [f"w{k}" for k in range(30)]
    base = " ".join(words)
    for other in (" ".join(words[:20]), " ".join(words * 3), " ".join(words[10:] * 2 + ["new"] * 5), " ".join(words[:5] * 7 + words[5:])):
        want = similarity(weights(base), weights(other))
        assert abs(agree(samples(base, number), samples(other, number)) - want) < 4 * (want * (1 - want) / number) ** 0.5


def test_odd_rows(spark, rows, docs, empty):
    got = fingerprints.edit_audit(docs).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"}
    # ids that stand once, with a next id that stands once, have a certain next text
    count = Counter(i for i, _ in rows)
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    by_id = {r.doc_id: r for r in got}
    checked = 0
    for k, (_, i, text) in enumerate(order):
        following = order[(k + 1) % len(order)]
        if count[i] == 1 and count[following[1]] == 1 and following[0]:
            edited = text[: len(text) - len(text) // 4] + following[2][: len(text) // 4]
            assert by_id[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and by_id[i].n_chars == len(text)
            assert by_id[i].near_edited == agree(samples(text), samples(edited)) and by_id[i].near_next == agree(samples(text), samples(following[2]))
            checked += 1
    assert checked > 30
    texts = defaultdict(set)
    for i, t in rows:
        if count[i] == 1:
            texts[t or ""].add(by_id[i].fingerprint)
    assert all(len(p) == 1 for p in texts.values())
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint and by_id[1].near_next == 1.0
    assert len({(r.fingerprint, r.edited_sha256) for r in got if r.doc_id == 200}) == 1
    assert fingerprints.edit_audit(empty).collect() == []
    alone = fingerprints.edit_audit(table(spark, [(5, "one two three four")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_weights_count(spark):
    """Similarity 1/4 by weights where the sets of words are equal."""
    words = " ".join(f"w{k}" for k in range(300))
    got = {r.doc_id: r for r in fingerprints.edit_audit(table(spark, [(1, words), (2, " ".join([words] * 4))]), samples=16).collect()}
    assert got[1].near_next == got[2].near_next == agree(samples(words, 16), samples(" ".join([words] * 4), 16))
    assert {len(r.fingerprint) for r in got.values()} == {64} and 0 < got[1].near_next < 0.6
