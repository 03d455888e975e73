"""Windows, exact means, votes and the chain of corrections against plain Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from dialoom.operators import voice_chain as ops

SAID = "file_id long, seg_idx long, start_s double, end_s double, text string, speaker string, confidence double, usable boolean, overlaps boolean"


def said(seed, files=40):
    rng = random.Random(seed)
    out = []
    for f in range(files):
        at = 0.0
        for i in range(rng.choice([1, 2, 3, 4, 9, 30])):
            seconds = rng.choice([0.1, 0.5, 0.9, 1.0, 1.6, 3.2])
            text = rng.choice(["ask: yes", "well", "a much longer sentence", "?!", "", "ask me, please"])
            out.append((f, i, at, at + seconds, text, rng.choice(["host", "guest"]), rng.randint(30, 95) / 100, rng.random() < 0.7, rng.random() < 0.3))
            at += seconds + rng.choice([0.0, 2.0])
    return out


def plain_chain(rows):
    rows = [dict(zip("file_id seg_idx start end text speaker conf usable overlaps".split(), r, strict=True)) for r in rows]
    for r in rows:
        if r["overlaps"]:
            r["conf"] = min(r["conf"] * 0.78, 0.84)
        r["sec"] = r["end"] - r["start"]
    for i in range(1, len(rows) - 1):
        a, r, b = rows[i - 1 : i + 2]
        if r["sec"] <= 1.0 and (not r["usable"] or r["conf"] < 0.55) and a["speaker"] == b["speaker"] != r["speaker"]:
            r["speaker"], r["conf"] = a["speaker"], max(r["conf"], 0.58)
    for i, r in enumerate(rows[:3]):
        if r["start"] - rows[0]["start"] <= 24 and r["speaker"] != "host" and r["text"].startswith("ask") and any(x["speaker"] == "guest" and x["sec"] >= 1.5 for x in rows[i + 1 : i + 3]):
            r["speaker"], r["conf"] = "host", max(0.66, min(r["conf"], 0.78))

    def edge(r, beside):
        size = len("".join(c for c in r["text"].lower() if c not in ops.SIGNS))
        if len(beside) < 2 or beside[0]["speaker"] != beside[1]["speaker"] or beside[0]["speaker"] == r["speaker"] or not size:
            return
        if not (r["sec"] > 1.2 and r["conf"] > 0.62) and (size <= 8 or r["conf"] <= 0.62 or not r["usable"]):
            r["speaker"], r["conf"] = beside[0]["speaker"], max(r["conf"], 0.6)

    if len(rows) >= 2:
        edge(rows[0], rows[1:3])
        edge(rows[-1], rows[max(0, len(rows) - 3) : len(rows) - 1])
    return [(r["file_id"], r["seg_idx"], r["speaker"], round(r["conf"], 9)) for r in rows]


def test_chain(spark):
    changed = 0
    for seed in (1, 2):
        rows = said(seed)
        done = ops.postprocessed(spark.createDataFrame(rows, SAID), F.startswith("text", F.lit("ask")))
        got = sorted((r.file_id, r.seg_idx, r.speaker, round(r.confidence, 9)) for r in done.collect())
        want = sorted(x for f in {r[0] for r in rows} for x in plain_chain([r for r in rows if r[0] == f]))
        assert got == want
        changed += sum(a[5] != b[2] for a, b in zip(sorted(rows), want, strict=True))
    assert changed > 20


def test_windows(spark):
    rows = [(1, 0, 0.0, 0.19), (1, 1, 0.0, 0.2), (1, 2, 1.0, 1.5), (1, 3, 2.0, 3.1), (1, 4, 0.0, 1.25), (1, 5, 5.0, 5.0)]
    got = sorted((r.seg_idx, r.k, r.left_s, r.right_s) for r in ops.windows(spark.createDataFrame(rows, "file_id long, seg_idx long, start_s double, end_s double")).collect())
    assert got == [(1, 0, 0.0, 0.2), (2, 0, 1.0, 1.5), (3, 0, 2.0, 2.5), (3, 1, 2.5, 3.0), (4, 0, 0.0, 0.5), (4, 1, 0.5, 1.0), (4, 2, 1.0, 1.25)]


def test_exact_means(spark):
    rng = random.Random(3)
    groups = {g: [round(rng.gauss(rng.choice([0.2, 0.6]), 0.1), 3) for _ in range(n)] for g, n in enumerate((1, 2, 3, 10, 60))} | {9: [0.5] * 4}
    got = {r.g: (r.n, r.low, r.high) for r in ops.two_means(spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g long, x double"), ["g"], "x").collect()}
    assert set(got) == {1, 2, 3, 4, 9}
    for g, (n, low, high) in got.items():
        xs = sorted(groups[g])
        mean = lambda a: sum(a) / len(a)
        cost = lambda k: sum((x - mean(xs[:k])) ** 2 for x in xs[:k]) + sum((x - mean(xs[k:])) ** 2 for x in xs[k:])
        assert n == len(xs) and min(abs(mean(xs[:k]) - low) + abs(mean(xs[k:]) - high) for k in range(1, n) if cost(k) < min(map(cost, range(1, n))) + 1e-9) < 1e-9


def test_votes_and_overrides(spark):
    near = lambda f, i, *xs: [(f, i, float(x)) for x in xs]
    measured = near(1, 0, 0.9, 0.9, 0.1) + near(1, 1, 0.1, 0.2, 0.1) + near(1, 2, 0.9, 0.1) + near(1, 3, 0.8) + near(1, 4, 0.52) + near(2, 0, *[0.5, 0.51] * 6) + near(3, 0, 0.1, 0.9)
    found = ops.votes(spark.createDataFrame(measured, "file_id long, seg_idx long, similarity double"))
    got = {(r.file_id, r.seg_idx): (r.n_windows, r.dominant, round(r.ratio, 3)) for r in found.collect()}
    # file 2's means lie too close, file 3 has too few windows; half of the windows are enough for the host
    assert got == {(1, 0): (3, "host", 0.667), (1, 1): (3, "guest", 1.0), (1, 2): (2, "host", 0.5), (1, 3): (1, "host", 1.0), (1, 4): (1, "host", 1.0)}
    said_ = [(f, i, "host" if i else "guest", 0.7) for f in (1, 4) for i in range(20)]
    sure = spark.createDataFrame([(4, 0.5)], "file_id long, silhouette double")
    done = ops.refined(spark.createDataFrame(said_, "file_id long, seg_idx long, speaker string, confidence double"), found, sure)
    rows = {(r.file_id, r.seg_idx): r for r in done.collect()}
    assert rows[1, 0].speaker == "host" and rows[1, 1].speaker == "guest" and rows[1, 2].confidence == 0.7 and rows[1, 0].changed and not rows[4, 0].changed
    # one window decides only far from the middle
    assert rows[1, 3].confidence != 0.7 and rows[1, 4].confidence == 0.7 and len(rows) == 40


def test_weighted_means(spark):
    from dialoom.functions.vectors import weighted_means

    rows = [("a", [1.0, 0.0], 1.0), ("a", [0.0, 4.0], 3.0), ("a", [9.0, 9.0], 0.9), ("b", [2.0, 2.0], 0.5), ("c", [1.0, -1.0], 2.0)]
    got = {r.k: (r.mean, r.weight) for r in weighted_means(spark.createDataFrame(rows, "k string, v array<double>, sec double"), ["k"], "v", "sec").collect()}
    assert got == {"a": ([0.25, 3.0], 4.0), "c": ([1.0, -1.0], 2.0)}
