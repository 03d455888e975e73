"""The verdicts of the methods themselves against plain versions: estimates, context trees, recall at the threshold."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from dialoom.llm import context_tree, minhash_dedup, quality
from tests.llm import brute


def vector(text):
    words, chars, symbols, repeated, marked, _ = brute.statistics(text)
    lines = sum(bool(brute.WORD.search(x)) for x in text.split("\n"))
    return [math.log1p(words), math.log(chars / words), symbols / chars, repeated / max(lines, 1), marked / words]


def estimate(x):
    """Mean and covariance of the rows ``x`` by C-steps from both starts, and one reweighting."""
    floors, n = np.array(quality.FLOORS), len(x)
    middle = lambda v: np.sort(np.floor(v * 512), 0)[(n - 1) // 2] / 512
    fitted = lambda rows, scale: (rows.mean(0), scale * np.cov(rows.T, bias=True) + np.diag(floors**2))
    squared = lambda mean, cov: np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)
    mid = middle(x)
    ends = []
    for model in ((mid, np.diag(np.maximum(middle(np.abs(x - mid)) * 1.4826, floors) ** 2)), fitted(x, 1.0)):
        for _ in range(quality.STEPS):
            bins = np.floor(np.log(squared(*model) + 1e-9) * 64)
            model = fitted(x[bins <= np.sort(bins)[math.ceil(quality.SUBSET * n) - 1]], quality.CONSISTENT)
        ends.append(model)
    best = min(ends, key=lambda m: np.linalg.slogdet(m[1])[1])
    return fitted(x[squared(*best) <= quality.POINT_975], quality.REWEIGHTED)


def test_distances_are_those_of_the_plain_estimate(spark):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(300)]

    def text(symbols):
        lines = [" ".join(("#" * int(rng.integers(0, 4)) if rng.random() < symbols else "") + w for w in rng.choice(words, 12)) for _ in range(rng.integers(6, 25))]
        return "\n".join(lines + lines[: rng.integers(0, 3)])

    groups = [("en", "a", 130), ("en", "b", 70), ("en", "c", 3), ("de", "a", 30), ("de", "b", 30), (None, "a", 8), ("en", None, 2)]
    rows = [(text(0.9 if k % 13 == 0 else 0.05), lang, source) for lang, source, n in groups for k in range(n)] + [("too short", "en", "a"), (None, "en", "a")]
    rows = [(i, *r) for i, r in enumerate(rows)]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    fit = {i: (vector(t), lang, source) for i, t, lang, source in rows if not brute.statistics(t)[-1]}
    models = {}
    for i, _, lang, source in rows:
        if i not in fit:
            assert not got[i].kept
            continue
        for alike in (lambda v: v[1:] == (lang, source), lambda v: v[1] == lang, lambda v: True):  # noqa: B023
            peers = [k for k, v in fit.items() if alike(v)]
            if len(peers) >= quality.LEAST_ROWS:
                break
        if (peers[0], len(peers)) not in models:
            models[peers[0], len(peers)] = estimate(np.array([fit[k][0] for k in peers]))
        mean, cov = models[peers[0], len(peers)]
        away = np.array(fit[i][0]) - mean
        distance = float(np.sqrt(away @ np.linalg.inv(cov) @ away))
        assert got[i].distance == pytest.approx(distance, rel=1e-6) and got[i].kept == (distance <= quality.CUT)
    assert any(not got[i].kept for i in fit)
    assert len(models) == 5, "two of a source, two of a language, one of the table"


class Trees:
    """Context trees over bytes, by recursion over the contexts that training met."""

    def __init__(self, texts):
        self.counts, self.below, self.known = defaultdict(lambda: [0, 0]), defaultdict(set), {}
        for t in texts:
            for node, context, one in self.decisions(t):
                for d in range(context_tree.DEPTH + 1):
                    own = context[len(context) - d :]
                    self.counts[node, own][one] += 1
                    if d:
                        self.below[node, own[1:]].add(own)

    @staticmethod
    def decisions(text):
        data = b"\xff" * context_tree.DEPTH + brute.lower(text).encode() + b"\xff"
        for k in range(context_tree.DEPTH, len(data)):
            for bit in range(8):
                yield (bit, data[k] >> (8 - bit)), data[k - context_tree.DEPTH : k], data[k] >> (7 - bit) & 1

    @staticmethod
    def kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def weighted(self, node, own):
        """Log-probability that the tree below a context gives what training saw there."""
        if (node, own) not in self.known:
            mine = self.kt(*self.counts[node, own])
            if len(own) < context_tree.DEPTH:
                mine = math.log(0.5) + np.logaddexp(mine, sum(self.weighted(node, x) for x in self.below.get((node, own), ())))
            self.known[node, own] = mine
        return self.known[node, own]

    def log_probability(self, node, context, one):
        """By definition: the root's probability with one decision more, over that without."""
        new = old = 0.0
        for d in range(context_tree.DEPTH, -1, -1):
            own = context[len(context) - d :]
            zeros, ones = self.counts.get((node, own), (0, 0))
            mine = self.kt(zeros + (not one), ones + one)
            if d < context_tree.DEPTH:
                rest = sum(self.weighted(node, x) for x in self.below.get((node, own), ()))
                mine = math.log(0.5) + np.logaddexp(mine, rest - old + new)
            seen = (node, own) in self.counts
            new, old = mine, self.weighted(node, own) if seen else 0.0
        return new - old

    def score(self, text):
        return sum(self.log_probability(*x) for x in self.decisions(text)) / math.log(10)


def test_scores_are_those_of_plain_context_trees(spark):
    rng = np.random.default_rng(6)
    words = ["the", "cat", "sat", "on", "mats", "Été", "a", "dog"]
    rows = [(k, " ".join(rng.choice(words, rng.integers(1, 14)))) for k in range(40)]
    rows += [(40, None), (41, ""), (42, "ZZZZ unseen \x00 bytes"), (43, "日本語"), (44, "aaaa" * 20)]
    trees = Trees([t for i, t in rows if zlib.crc32(str(i).encode()) % 10])
    got = {r.doc_id: r for r in context_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i].held_out for i, _ in rows} == {True, False}
    for i, t in rows:
        assert got[i].score == pytest.approx(trees.score(t), rel=1e-5)


def test_held_out_text_is_coded_in_fewer_bits_than_its_bytes_alone(spark):
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(60)]
    rows = [(k, " ".join(rng.choice(words, 60))) for k in range(200)]
    out = {r.doc_id: -r.score / math.log10(2) for r in context_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.held_out}
    data = b"".join(t.encode() + b"\xff" for i, t in rows if i in out)
    share = np.bincount(np.frombuffer(data, np.uint8)) / len(data)
    entropy = -sum(p * math.log2(p) for p in share if p)
    assert len(out) > 5 and sum(out.values()) / len(data) < 0.6 * entropy


def test_pairs_at_the_threshold_are_found_and_pairs_under_it_are_not(spark):
    """Of pairs of 100 shingles, 86 to 88 in common are 0.754 to 0.786, and 85 are 0.739."""
    rng, rows, linked = np.random.default_rng(8), [], {}
    fresh = iter(f"w{k}" for k in rng.permutation(10**6))
    for pair in range(400):
        common = (86, 87, 88, 85)[pair % 4]
        shared = [next(fresh) for _ in range(common + 4)]
        for side in (0, 1):
            rows.append((2 * pair + side, " ".join(shared + [next(fresh) for _ in range(100 - common)])))
        linked[pair] = common > 85
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = {p: got[2 * p] == got[2 * p + 1] for p in linked}
    assert all(got[2 * p] == 2 * p for p in linked) and not any(found[p] for p in linked if not linked[p])
    assert sum(found[p] for p in linked if linked[p]) >= 0.99 * sum(linked.values())
