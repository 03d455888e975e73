"""Plain versions of the operators' contracts, over (id, text) rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LEAST = -(2**63)


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def key(i: int | None) -> int:
    return LEAST if i is None else i


def strings(rows, width=50):
    """(id, bytes, removed, spans, digest) of each row."""
    first: dict[bytes, int] = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - width + 1):
            g = b[k : k + width]
            first[g] = min(first.get(g, key(i)), key(i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < key(i):
                gone[k : k + width] = b"\1" * width
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def passages(rows, width=50):
    """(id, words, removed, digest) of each row."""
    first: dict[tuple, int] = {}
    data = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in data:
        for k in range(len(w) - width + 1):
            g = tuple(w[k : k + width])
            first[g] = min(first.get(g, key(i)), key(i))
    out = []
    for i, w in data:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < key(i):
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return out


def shingles(text: str | None) -> frozenset:
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near(rows):
    """(id, shingles, component, kept) of each row; rows with one id are one document."""
    sets = [(key(i), shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    show = lambda x: None if x == LEAST else x
    return [(show(i), len(s), show(root(i)), root(i) == i) for i, s in sets]


def statistics(text: str | None):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    marked = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeated, len(marked), len(w) < 50 or 100 * len(marked) > 50 * len(w)


def leaks(rows, items, width=10):
    """(id, words, hit, items, digest, contaminated) of each row."""
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add("null" if i is None else str(i))
    sizes, out = {len(k) for k in windows}, []
    for i, t in rows:
        w, hit, found = ALNUM.findall(lower(t)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= got
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out
