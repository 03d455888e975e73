"""Spelling variants against plain neighbourhoods; the filter audit against a replay in plain Python and its SQL."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import pytest

from dialoom.llm import filter_audit, registry, spelling
from tests.llm.conftest import same, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = defaultdict(set)
    under = defaultdict(set)
    for w in words:
        for p in range(len(w)):
            under[p, w[:p], w[p + 1 :]].add(w)
            shorter = w[:p] + w[p + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in under.values():
        for w in group:
            near[w] |= group - {w}
    form = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: f for w, f in form.items() if words[f] >= 10 * words[w]}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None


def planted():
    """Chains of forms, inner, first and last letters, equal letters, ties, long runs, many words that share a half."""
    say = {"wanderer": 300, "wandderer": 30, "wandderers": 3, "xanderer": 3, "wandere": 2, "wandererr": 2, "wanderXer": 4, "étoilées": 40, "étoilêes": 3, "aaaaaaa": 20, "aaaaaaaa": 2, "banding": 50, "landing": 50, "handing": 5, "y" * 3000: 30, "y" * 2999: 3}
    rows = [(1000 + k, " ".join([w] * n)) for k, (w, n) in enumerate(say.items())]
    rows += [(100 + a, " ".join(f"prefixes{chr(97 + a)}{chr(97 + b)}" for b in range(26)) + " ") for a in range(26)] * 2
    rows += [(200 + a, " ".join(f"{chr(97 + a)}{chr(97 + b)}suffixes" for b in range(26))) for a in range(26)] * 2
    return rows + [(None, "nothing nothing"), (7, None), (8, ""), (9, "short WORDS only"), (300, "x÷z÷x÷z x÷z÷x÷z")]


COLUMNS = "word", "form", "root", "n", "n_near", "form_n"


@pytest.mark.parametrize("largest", [3, 256])
def test_variants_of_planted_words(spark, largest):
    want = list(plain_variants(planted()))
    assert any(w[1] and w[1] != w[2] for w in want) and max(w[4] for w in want) >= 50
    got = spelling.variants(table(spark, planted()), largest=largest).select(*COLUMNS).collect()
    same(got, want)


def crowded():
    """Blocks of few words of one length and many commoner ones of the other, so that a near word comes late among the block's words."""
    say = {"trifled": 2, "trifles": 25, "grounde": 2, "grounded": 20}
    say |= {f"tri{a}edal": 60 + k for k, a in enumerate("bcdefghjk")} | {f"gro{a}dal": 60 + k for k, a in enumerate("bcdefghjk")}
    return [(2000 + k, " ".join([w] * n)) for k, (w, n) in enumerate(say.items())]


@pytest.mark.parametrize("largest", [3, 256])
def test_forms_in_crowded_blocks(spark, largest):
    want = list(plain_variants(crowded()))
    assert {w[0]: w[1] for w in want if w[3] == 2} == {"trifled": "trifles", "grounde": "grounded"}
    rng = random.Random(11)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(7, 9))) for _ in range(300)]
    many = [(k, " ".join(rng.choice(words[: 20 if k % 3 else 300]) for _ in range(50))) for k in range(100)]
    for rows in (crowded(), many):
        same(spelling.variants(table(spark, rows), largest=largest).select(*COLUMNS).collect(), plain_variants(rows))


def test_variants_of_documents(spark, data, docs, rows, empty):
    table_rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    same(registry.op11_spelling_variants(spark, data).select(*COLUMNS).collect(), plain_variants(table_rows))
    same(spelling.variants(docs).select(*COLUMNS).collect(), plain_variants(rows))
    assert spelling.variants(empty).count() == 0


def plain_audit(rows, labels):
    text = lambda t: t or ""
    found = []
    for i, t, part in rows:
        t = text(t)
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        earlier = i is not None and any(text(u) == t and j is not None and j < i for j, u, _ in rows)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": earlier}
        says = [q for j, *q in labels if j is not None and j == i]
        found.append((part or "", fails, any(q == 1 for q, _ in says), any(x == 1 for _, x in says)))
    counts, shapley = defaultdict(lambda: [0] * 6), Counter()
    for part, fails, good, toxic in found:
        for order in map("".join, permutations("ABCDE")):
            first = next((k for k, c in enumerate(order) if fails[c]), 5)
            for k, c in enumerate(order):
                row = counts[part, order, k + 1]
                for at, yes in enumerate((first > k, first == k, fails[c] and first < k, fails[c] and sum(fails.values()) == 1, first == k and good, first == k and toxic)):
                    row[at] += yes
                shapley[part, c] += first == k
    return [(*key, *row, shapley[key[0], key[1][key[2] - 1]]) for key, row in counts.items()]


AUDIT = "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"


def test_audit_of_odd_rows(spark, rows, docs, empty):
    shout = [(400, "LOUD WORDS " * 60), (401, "LOUD WORDS " * 60), (402, "quiet words # " * 50), (403, " ".join(f"w{k}" for k in range(150))), (None, "one"), (None, None), (500, None)]
    every = rows + shout
    frame = table(spark, every)
    labels = [(4, 1, 0), (5, 1, 1), (400, None, 1), (401, 0, 1), (401, 1, None), (403, 1, 0), (None, 1, 1), (200, 1, 1)]
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.labelled(filter_audit.flags(frame), told)).select(*AUDIT).collect()
    parts = [(i, t, None if k % 7 == 0 else "en") for k, (i, t) in enumerate(every)]
    same(got, plain_audit(parts, labels))
    assert filter_audit.audit(filter_audit.labelled(filter_audit.flags(empty), told)).count() == 0


def test_audit_by_three_filters(spark):
    flagged = spark.createDataFrame([("p", True, False, True, True, False), ("p", False, True, False, False, False)], "part string, X boolean, Y boolean, Z boolean, good boolean, toxic boolean")
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(flagged, "XYZ").collect()}
    assert len(got) == 18 and got["XYZ", 1].removed == 1 and got["XYZ", 3].redundant == 1 and got["XYZ", 3].kept == 0 and got["ZXY", 1].good_lost == 1
    with pytest.raises(ValueError, match="six"):
        filter_audit.audit(flagged, "ABCDEFG")


def test_audit_same_as_sql(spark, data):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.register(name, spark.read.parquet(f"{data}/{name}.parquet").toPandas())
    want = con.sql(registry.ORACLE_SQL["op13_filter_audit"]).df()[list(AUDIT)]
    same(registry.op13_filter_audit(spark, data).select(*AUDIT).collect(), want.itertuples(index=False, name=None))
