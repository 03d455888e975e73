"""Strings of a fixed width that a document with a smaller id has too: the rounds that byte strings and word passages share.

A string is so many consecutive units (bytes, words) of one document.  Strings
are filed under names; consecutive strings under one name are a stretch, a span
of bytes.  The first round finds the names that two documents have; in the
second the stretches under them go to the names' buckets, equal ones of a chunk
once with the smallest document id, equal ones of a bucket once again.  What
the bucket finds for each string of its distinct stretches comes back as bits.

Hashes only say what may be equal: stretches count as equal when their bytes
are, and strings when the caller's ``lower`` has compared them.  Names that are
confused cost time alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dialoom.llm import dealing

MOST = np.iinfo(np.int64).max
#: Bits of a name that travel: what they confuse is sent in vain.
NAME_BITS = 48
#: Values of spans that are compared at a time.
BLOCK = 1 << 20


class Stretches(NamedTuple):
    """A chunk's texts as bytes, the units of each document, and of each stretch: row, first unit, strings, span of bytes, name, hash of the bytes."""

    data: np.ndarray
    units: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    strings: np.ndarray
    start: np.ndarray
    size: np.ndarray
    name: np.ndarray
    mark: np.ndarray

    def at(self, which: np.ndarray) -> Stretches:
        return Stretches(self.data, self.units, *(x[which] for x in self[2:]))


#: Lowers the smallest id of each string of a bucket's distinct stretches, where equal strings stand in several:
#: (ids to lower, first string of each stretch, strings, names, begin and size of their bytes, bytes).
Lower = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], None]


def cut_out(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The values of the spans, one after another."""
    return data[inner(start, size)]


def inner(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each, n of them."""
    return np.repeat(begin - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(int(n.sum()))


def classes(data: np.ndarray, start: np.ndarray, size: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Of each span, the first span with the same values.  ``mark``: a hash, which only saves comparisons."""
    out = np.arange(len(start))
    left = np.lexsort((size, mark))
    while len(left):
        key, n = mark[left], size[left]
        head = np.append(True, (key[1:] != key[:-1]) | (n[1:] != n[:-1]))
        first = left[np.flatnonzero(head)[np.cumsum(head) - 1]]
        follow = np.flatnonzero(~head)
        if not len(follow):
            break
        own, of = left[follow], first[follow]
        equal, upto, lo = np.ones(len(own), bool), np.cumsum(size[own]), 0
        while lo < len(own):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + BLOCK, "right")))
            n = size[own[lo:hi]]
            differ = cut_out(data, start[own[lo:hi]], n) != cut_out(data, start[of[lo:hi]], n)
            if differ.any():
                equal[lo:hi] = np.add.reduceat(differ, np.append(0, np.cumsum(n)[:-1]), dtype=np.int64) == 0
            lo = hi
        out[own[equal]] = of[equal]
        left = own[~equal]  # like the first by hash alone: among themselves once more
    return out


def least_of(ids: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The smallest id of each span's class."""
    out = np.full(len(ids), MOST)
    np.minimum.at(out, kind, ids)
    return out[kind]


def several_under(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that do not stand alone under their name, by name, and the number of the name of each."""
    order = np.argsort(names, kind="stable")
    own = names[order]
    edge = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(order))))
    several = np.bincount(group)[group] > 1
    return order[several], group[several]


def decide(blobs: list, lower: Lower) -> Iterator[bytes | None]:
    """To each chunk: a bit for each string of the stretches it sent, whether a smaller id has it."""
    parts = [dealing.unsqueezed(x, np.uint64, np.uint64, np.int64, np.uint32, np.uint32, np.uint8, np.int64) for x in blobs]
    names = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    marks, ids, strings, size, source = (np.concatenate([p[k] for p in parts]) for k in range(1, 6))
    strings, size = strings.astype(np.int64), size.astype(np.int64)
    parts = [(len(p[0]), p[6]) for p in parts]  # the bytes are held once
    begin = np.append(0, np.cumsum(size)[:-1])
    kind = classes(source, begin, size, marks)
    once = np.unique(kind)
    at = np.searchsorted(once, kind)
    filed = np.append(0, np.cumsum(strings[once]))
    best = np.repeat(least_of(ids, kind)[once], strings[once])
    lower(best, filed[:-1], strings[once], names[once], begin[once], size[once], source)
    lo = 0
    for count, tag in parts:
        own = np.arange(lo, lo + count)
        lo += count
        n = strings[own]
        bits = best[inner(filed[at[own]], n)] < np.repeat(ids[own], n)
        yield dealing.squeezed(np.packbits(bits), tag) if bits.any() else None


def repeated(docs: DataFrame, width: int, gather: Callable[[pa.ChunkedArray], Stretches], lower: Lower, result: Callable[[pa.Array, pa.ChunkedArray, Stretches, np.ndarray], dict], schema: str, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id and what ``result`` makes of the chunk's ids, texts and units that go."""
    dealt, buckets = dealing.deal(docs, id_col, text_col)
    buckets *= dealing.CHUNKS  # a bucket holds spans that overlap, so more bytes than a chunk

    def names(table: pa.Table, _: list) -> dealing.Sent:
        _, ids, texts = dealing.chunk_of(table)
        own = gather(texts)
        return dealing.send_names(*dealing.shared(own.name, ids[own.rows]), buckets)

    def sent_of(table: pa.Table, answers: list) -> tuple:
        """A chunk's stretches under names that others share, their ids and classes; one of each class by bucket and name, and the buckets' bounds."""
        _, ids, texts = dealing.chunk_of(table)
        every = gather(texts)
        often = dealing.answered(dealing.shared(every.name, ids[every.rows])[0], answers, buckets)
        own = every.at(np.flatnonzero(dealing.found(every.name, often)))
        kind = classes(own.data, own.start, own.size, own.mark)
        once = np.unique(kind)
        order, present, cuts = dealing.by_bucket(own.name[once], buckets)
        return own, ids[own.rows], kind, [(b, once[order[lo:hi]]) for b, lo, hi in zip(present, cuts, cuts[1:], strict=False)]

    def sort(table: pa.Table, answers: list) -> dealing.Sent:
        own, ids, kind, sent = sent_of(table, answers)
        best = least_of(ids, kind)
        for b, at in sent:
            yield b, dealing.squeezed(
                dealing.steps(own.name[at]), own.mark[at], best[at], own.strings[at].astype(np.uint32), own.size[at].astype(np.uint32), cut_out(own.data, own.start[at], own.size[at]), np.array([b])
            )

    def remove(table: pa.Table, shared: list, answers: list) -> pa.Table:
        raw, _, texts = dealing.chunk_of(table)
        own, ids, kind, sent = sent_of(table, shared)
        cover = np.zeros(int(own.units[-1]) + 1, np.int32)
        # stretches that a smaller id of this chunk has too
        at = np.flatnonzero(ids > least_of(ids, kind))
        np.add.at(cover, own.first[at], 1)
        np.add.at(cover, own.first[at] + own.strings[at] + width - 1, -1)
        # strings that a smaller id has elsewhere
        where, filed, bits, upto = dict(sent), np.full(len(own.rows), -1), [], 0
        for x in answers:
            packed, (b,) = dealing.unsqueezed(x, np.uint8, np.int64)
            at = where[int(b)]
            n = own.strings[at]
            filed[at] = upto + np.append(0, np.cumsum(n)[:-1])
            upto += int(n.sum())
            bits.append(np.unpackbits(packed, count=int(n.sum())).astype(bool))
        if bits:
            hit, of = np.concatenate(bits), np.flatnonzero(filed[kind] >= 0)
            n = own.strings[of]
            at = inner(own.first[of], n)[hit[inner(filed[kind[of]], n)]]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + width, -1)
        return pa.table({"id": raw, **result(raw, texts, own, np.cumsum(cover[:-1]) > 0)})

    shared = dealing.settle(dealing.send(dealt, None, names), dealing.shared_names)
    answers = dealing.settle(dealing.send(dealt, shared, sort), lambda blobs: decide(blobs, lower))
    return dealing.finish(dealt, [shared, answers], remove, f"id long, {schema}").withColumnRenamed("id", id_col)


def spans_of(gone: np.ndarray, units: np.ndarray) -> pa.ListArray:
    """Runs of units that go, of each document, as (start, end) from its first unit."""
    edge = np.zeros(len(gone) + 1, bool)
    edge[units] = True
    padded = np.concatenate([[False], gone, [False]])
    begin = np.flatnonzero(gone & (edge[:-1] | ~padded[:-2]))
    end = np.flatnonzero(gone & (edge[1:] | ~padded[2:])) + 1
    shift = units[np.searchsorted(units, begin, "right") - 1]
    span = pa.StructArray.from_arrays([pa.array(begin - shift, pa.int64()), pa.array(end - shift, pa.int64())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begin, units), pa.int32()), span)
