"""Repeated word passages by recompression.

A document's words are symbols.  A round of recompression names runs of one
symbol and then pairs, whose first and second halves a bit of the symbols'
names tells apart.  Names are 64-bit hashes of what they stand for, so all
machines give equal words equal names.  A symbol depends only on words near it,
which are tracked exactly: where a window holds all words a symbol depends on,
any equal window has the same symbol at the same place.

Each 50-word window is filed under the least such symbol's name after
``ROUNDS`` rounds.  Spark finds the names that two documents or more have;
windows under other names occur nowhere else.  The words of the rest meet under
their names and are verified: words are numbered by their bytes, and windows
are equal when their 50 numbers are.  The smallest document id that holds a
window decides which are removed.  Names and hashes that are confused cost time
alone.

Runs of over ``LONGEST_RUN`` equal symbols stay single symbols, so that a long
run looks the same everywhere inside; a window in which no symbol is settled is
filed under its own hash.

Cases: a null or empty text has no words; a very long text is cut by names like
others, windows at a time; of equal windows the one with the smallest id stays;
a null id sorts before all others; of rows with one id none is smaller, so they
do not remove each other's words; extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.repeats import NAME_BITS, Stretches, classes, cut_out, inner, least_of, repeated, several_under, spans_of
from dialoom.llm.text import BYTE_BASE, BYTE_VALUES, WORD, between, blocks, flat, mix, prefix, spans, windows, word_hashes

WIDTH, ROUNDS, LONGEST_RUN = 50, 3, 4
U64 = np.uint64
#: Bytes of stretches whose windows are compared at a time, unless one name needs more.
SHARD = 1 << 20


def recompress(names: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after ``rounds`` rounds: names, and the words [left, right) each depends on.

    ``first``: each document's first word (documents + 1).  A symbol that
    depends on where its document begins or ends reaches over that edge.
    The top bits of a name tell how often it was joined, most first: symbols
    of many words are rare, and single common words are named last.
    """
    joined_in = np.zeros(len(names), np.uint64)
    left, right = np.arange(len(names)), np.arange(len(names)) + 1
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for turn in range(rounds):
        n = len(names)
        if not n:
            break
        at, last = np.arange(n), np.append(doc[1:] != doc[:-1], True)
        head = np.append(True, last[:-1])
        # runs
        begins = head | np.append(True, names[1:] != names[:-1])
        start = np.flatnonzero(begins)
        size = np.diff(np.append(start, n))
        run = np.cumsum(begins) - 1
        short = size[run] <= LONGEST_RUN
        keep = begins | ~short
        see = np.where(short, n, LONGEST_RUN + 1)
        lo = np.maximum(start[run] - 1, at - see)
        hi = np.minimum(start[run] + size[run], at + see)
        over = head[start[run]] & (lo < start[run])
        reach_left = np.where(over, first[doc] - 1, left[np.maximum(lo, 0)])
        end = start[run] + size[run] - 1
        over = last[end] & (hi > end)
        reach_right = np.where(over, first[doc + 1] + 1, right[np.minimum(hi, n - 1)])
        named = np.where(short & (size[run] > 1), mix(names * U64(0xD6E8FEB86659FD93) + size[run].astype(np.uint64)), names)
        joined_in = joined_in + (short & (size[run] > 1))
        names, left, right, doc, joined_in = named[keep], reach_left[keep], reach_right[keep], doc[keep], joined_in[keep]
        # pairs
        n = len(names)
        last = np.append(doc[1:] != doc[:-1], True)
        head = np.append(True, last[:-1])
        second = (mix(names ^ U64(0xA0761D6478BD642F * (turn + 1) % 2**64)) >> U64(63)).astype(bool)
        joins = ~second & np.append(second[1:], False) & ~last
        joined = np.append(False, joins[:-1])
        # one alone looked at the neighbour that it might have joined
        alone = ~joins & ~joined
        beyond = np.where(last, first[doc + 1] + 1, np.append(right[1:], 0))
        before = np.where(head, first[doc] - 1, np.append(0, left[:-1]))
        new_right = np.where(alone & ~second, np.maximum(right, beyond), right)
        new_left = np.where(alone & second, np.minimum(left, before), left)
        at = np.flatnonzero(joins)
        named = names.copy()
        named[at] = mix(names[at] * U64(0x8EBC6AF09C88C6E3) + names[at + 1] * U64(0x589965CC75374CC3) + U64(turn))
        new_right[at] = np.maximum(right[at], right[at + 1])
        new_left[at] = np.minimum(left[at], left[at + 1])
        depth = joined_in.copy()
        depth[at] = np.maximum(joined_in[at], joined_in[at + 1]) + U64(1)
        names, left, right, doc, joined_in = named[~joined], new_left[~joined], new_right[~joined], doc[~joined], depth[~joined]
    # of two symbols the later depends on nothing earlier, so that a window's symbols are neighbours
    names = (U64(3) - np.minimum(joined_in, U64(3))) << U64(62) | names >> U64(2)
    return names, np.maximum.accumulate(left), np.minimum.accumulate(right[::-1])[::-1]


def least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of values[lo:hi] for each pair with lo < hi."""
    size = hi - lo
    levels = [values]
    while 2 << (len(levels) - 1) <= (int(size.max()) if len(size) else 0):
        step = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    out = np.empty(len(lo), values.dtype)
    level = np.frexp(size)[1] - 1
    for k in range(len(levels)):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(levels[k][lo[at]], levels[k][hi[at] - (1 << k)])
    return out


def filed(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows: row of the document, first word, and name filed under."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(doc[: max(len(doc) - width + 1, 0)] == doc[width - 1 :])
    symbols, left, right = recompress(words, first)
    begin, end = np.searchsorted(left, at), np.searchsorted(right, at + width, "right")
    some = np.flatnonzero(begin < end)
    name = windows(words, width)[at] | U64(3) << U64(62)
    name[some] = least(symbols, begin[some], end[some])
    return doc[at], at, name


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, each with a space after it, and where each begins (words + 1)."""
    room = ends - starts + 1
    begin = np.append(0, np.cumsum(room))
    out = data[np.minimum(inner(starts, room), max(len(data) - 1, 0))]
    out[begin[1:] - 1] = 0x20
    return out, begin


def gather(texts: pa.ChunkedArray, width: int, bits: int) -> Stretches:
    data, offsets = flat(texts)
    parts, counts, text, n_bytes, n_words = [], [], [], 0, 0
    for lo, hi in blocks(offsets):
        piece, own = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, first = spans(piece, own, WORD)
        row, at, name = filed(word_hashes(piece, starts, ends), first, width)
        head = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (row[1:] != row[:-1]))) if len(row) else row
        strings = np.diff(np.append(head, len(row)))
        joined, begin = spaced(piece, starts, ends)
        start = begin[at[head]]
        end = begin[at[head] + strings + width - 1]
        mark = mix(between(prefix(BYTE_VALUES[joined], BYTE_BASE), start, end, BYTE_BASE) ^ strings.astype(np.uint64))
        parts.append((row[head] + lo, at[head] + n_words, strings, start + n_bytes, end - start, name[head] >> U64(64 - bits), mark >> U64(64 - bits)))
        counts.append(np.diff(first))
        text.append(joined)
        n_bytes += len(joined)
        n_words += len(starts)
    kinds = (np.int64,) * 5 + (np.uint64,) * 2
    of = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, k) for k in kinds]
    units = np.append(0, np.cumsum(np.concatenate(counts))) if counts else np.zeros(1, np.int64)
    return Stretches(np.concatenate(text) if text else np.zeros(0, np.uint8), units, *of)


def lower(best: np.ndarray, filed_at: np.ndarray, strings: np.ndarray, names: np.ndarray, begin: np.ndarray, size: np.ndarray, source: np.ndarray, width: int) -> None:
    """Compares the windows of a bucket's stretches, some names at a time."""
    by_name, group = several_under(names)
    upto, lo = np.cumsum(size[by_name]), 0
    while lo < len(by_name):
        hi = int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + SHARD, "right"))
        hi = int(np.searchsorted(group, group[max(hi - 1, lo)], "right"))
        own = by_name[lo:hi]
        text, offsets = cut_out(source, begin[own], size[own]), np.append(0, np.cumsum(size[own]))
        parts, words = [], 0
        for a, b in blocks(offsets):  # one name alone may need more than a block
            at, to, of = spans(text[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], WORD)
            parts.append((at + offsets[a], to + offsets[a], word_hashes(text[offsets[a] : offsets[b]], at, to), of[:-1] + words))
            words += len(at)
        starts, ends, hashes, first = (np.concatenate(x) for x in zip(*parts, strict=True))
        # words by their bytes, windows by their words
        word = classes(text, starts, ends - starts, hashes)
        at = inner(first, strings[own])
        kind = classes(word, at, np.full(len(at), width), windows(hashes, width)[at])
        slot = inner(filed_at[own], strings[own])
        best[slot] = least_of(best[slot], kind)
        lo = hi


def repeated_passages(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", bits: int = NAME_BITS) -> DataFrame:
    """One row per document: id, n_words, ``removed`` (word spans, end excluded) and ``kept`` (the words left, joined by a space).

    ``bits`` of hashes, which decide nothing.
    """

    def result(raw: pa.Array, texts: pa.ChunkedArray, own: Stretches, gone: np.ndarray) -> dict:
        # bytes of the words left, each with its space but the last
        starts = np.append(0, np.flatnonzero(own.data == 0x20) + 1)[: len(gone) + 1]
        room = np.diff(starts)
        stay, doc = ~gone, np.repeat(np.arange(len(raw)), np.diff(own.units))
        last = np.zeros(len(gone), bool)
        kept_at = np.flatnonzero(stay)
        last[kept_at[np.append(doc[kept_at][1:] != doc[kept_at][:-1], True)] if len(kept_at) else kept_at] = True
        keep = np.repeat(stay, room)
        keep[starts[1:][last] - 1] = False
        left = np.append(0, np.cumsum(keep))[starts[own.units]]
        kept = pa.Array.from_buffers(pa.large_string(), len(raw), [None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(own.data[keep].tobytes())])
        parts = [kept.slice(lo, hi - lo).cast(pa.string()) for lo, hi in blocks(left, 1 << 30)]
        return {"n_words": pa.array(np.diff(own.units), pa.int64()), "removed": spans_of(gone, own.units), "kept": pa.chunked_array(parts, pa.string())}

    return repeated(
        docs, width, lambda texts: gather(texts, width, bits), lambda *bucket: lower(*bucket, width), result,
        "n_words long, removed array<struct<start:bigint,end:bigint>>, kept string", id_col, text_col,
    )


def n_removed(spans_col: str = "removed"):
    return F.aggregate(spans_col, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
