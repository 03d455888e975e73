"""Repeated byte strings by suffix arrays of shards.

Every ``width``-byte string of a document is filed under the least hash of the
``GRAM``-byte strings within it, so equal strings are filed alike wherever they
stand.  Names that one document alone has hold no repeats; a round of messages
finds them.  For the others, the stretch of bytes that consecutive strings
under one name cover goes to the name's bucket, equal stretches of a chunk
once, with the smallest document id.  A bucket's stretches, equal ones again
once, are dealt to shards by name and put in suffix order with common prefixes
by ``suffix_array``, which works outside memory; neighbours that share
``width`` bytes or more are one string, and the smallest id among them decides
which documents lose it.

Hashes only say what may be equal: stretches count as equal when their bytes
are, and strings when the suffix order says so.  Only names go by hash, and two
that are confused cost time alone.

Cases: a null or empty text has no bytes; strings never cross documents; a very
long text is one more row of its chunk, cut by names like others; of equal
strings the one with the smallest id stays; a null id sorts before all others;
rows with one id do not remove each other's bytes; bytes left may not be whole
characters, so the kept text is binary; extra columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.repeats import MOST, NAME_BITS, Stretches, cut_out, inner, repeated, several_under, spans_of
from dialoom.llm.suffix_array import MEMORY, SuffixOrder
from dialoom.llm.text import BYTE_BASE, BYTE_VALUES, between, blocks, flat, mix, prefix

WIDTH, GRAM = 50, 16
U64 = np.uint64
#: Bytes of the shards that a bucket's names are dealt to; a name alone may need more.
SHARD = 1 << 20


def stretches(data: np.ndarray, offsets: np.ndarray, width: int, block: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By block: row, first byte (in ``data``), strings, name, and a hash of the bytes, of each stretch."""
    slots = width - GRAM + 1
    for lo, hi in blocks(offsets, block):
        own = offsets[lo : hi + 1] - offsets[lo]
        piece = data[offsets[lo] : offsets[hi]]
        n = len(piece) - width + 1
        if n <= 0:
            continue
        sums = prefix(BYTE_VALUES[piece], BYTE_BASE)
        at = np.arange(len(piece) - GRAM + 1)
        low, covered = between(sums, at, at + GRAM, BYTE_BASE), 1
        while 2 * covered <= slots:
            low, covered = np.minimum(low[:-covered], low[covered:]), 2 * covered
        if covered < slots:
            low = np.minimum(low[: n], low[slots - covered :])
        size = np.diff(own)
        valid = np.maximum(size - width + 1, 0)
        row = np.repeat(np.arange(hi - lo), valid)
        at = np.repeat(own[:-1] - np.append(0, np.cumsum(valid)[:-1]), valid) + np.arange(len(row))
        name = low[at]
        head = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (row[1:] != row[:-1]))) if len(row) else row
        strings = np.diff(np.append(head, len(row)))
        start = at[head]
        mark = mix(between(sums, start, start + strings + width - 1, BYTE_BASE) ^ strings.astype(np.uint64))
        yield row[head] + lo, start + offsets[lo], strings, name[head], mark


def gathered(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    parts = list(stretches(data, offsets, width))
    kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, k) for k in kinds]


def gather(texts: pa.ChunkedArray, width: int, bits: int) -> Stretches:
    data, offsets = flat(texts)
    rows, start, strings, name, mark = gathered(data, offsets, width)
    return Stretches(data, offsets, rows, start, strings, start, strings + width - 1, name >> U64(64 - bits), mark >> U64(64 - bits))


def lower(best: np.ndarray, filed: np.ndarray, strings: np.ndarray, names: np.ndarray, begin: np.ndarray, size: np.ndarray, source: np.ndarray, width: int, memory: int, shard: int) -> None:
    """Puts a bucket's stretches in suffix order, shard by shard; stretches with one name go together."""
    by_name, group = several_under(names)
    source, upto, lo = np.append(source, np.uint8(0)), np.cumsum(size[by_name] + 1), 0
    while lo < len(by_name):
        hi = int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + shard, "right"))
        hi = int(np.searchsorted(group, group[max(hi - 1, lo)], "right"))
        own = by_name[lo:hi]
        _lower_shard(best, filed[own], strings[own], begin[own], source, width, memory)
        lo = hi


def _lower_shard(best: np.ndarray, filed: np.ndarray, strings: np.ndarray, begin: np.ndarray, source: np.ndarray, width: int, memory: int) -> None:
    """Lowers each string's id in ``best`` to the smallest of all equal strings of the shard's stretches."""
    room = strings + width  # one more after each for its end
    where = np.append(0, np.cumsum(room))
    text = cut_out(source, begin, room)
    slot_of = np.full(len(text) + 1, -1)
    starts = np.repeat(where[:-1] - np.append(0, np.cumsum(strings)[:-1]), strings) + np.arange(int(strings.sum()))
    slot_of[starts] = np.repeat(filed - np.append(0, np.cumsum(strings)[:-1]), strings) + np.arange(int(strings.sum()))
    suffixes = SuffixOrder(text, where[1:] - 1, memory, limit=width)
    try:
        held: list[np.ndarray] = []
        least = MOST
        for positions, common in suffixes:
            slot = slot_of[positions]
            own = np.where(slot >= 0, best[slot], MOST)
            new = np.flatnonzero(np.append(True, common[1:] < width))
            floor = np.minimum.reduceat(own, new)
            if common[0] >= width:  # goes on from the block before
                floor[0] = min(floor[0], least)
            elif held:
                _lower(best, held, least)
                held = []
            runs = np.repeat(floor, np.diff(np.append(new, len(own))))
            last = new[-1]
            body = slot[:last]
            best[body[body >= 0]] = runs[:last][body >= 0]
            if len(new) > 1 and held:
                _lower(best, held, floor[0])
                held = []
            held.append(slot[last:])
            least = floor[-1]
        if held:
            _lower(best, held, least)
    finally:
        suffixes.close()


def _lower(best: np.ndarray, held: list[np.ndarray], least: int) -> None:
    slots = np.concatenate(held)
    best[slots[slots >= 0]] = least


def repeated_strings(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY, shard: int = SHARD, bits: int = NAME_BITS) -> DataFrame:
    """One row per document: id, n_bytes, ``removed`` (byte spans, end excluded) and ``kept`` (the bytes left).

    ``memory``: bytes that the sort of a shard may hold; ``shard``: bytes of a shard, unless one name needs more;
    ``bits`` of hashes, which decide nothing.
    """
    if width < GRAM:
        raise ValueError(f"strings must have {GRAM} bytes or more")

    def result(raw: pa.Array, _: pa.ChunkedArray, own: Stretches, gone: np.ndarray) -> dict:
        left = np.append(0, np.cumsum(~gone))[own.units]
        kept = pa.Array.from_buffers(pa.large_binary(), len(raw), [None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(own.data[~gone].tobytes())])
        parts = [kept.slice(lo, hi - lo).cast(pa.binary()) for lo, hi in blocks(left, 1 << 30)]
        return {"n_bytes": pa.array(np.diff(own.units), pa.int64()), "removed": spans_of(gone, own.units), "kept": pa.chunked_array(parts, pa.binary())}

    return repeated(
        docs, width, lambda texts: gather(texts, width, bits), lambda *bucket: lower(*bucket, width, memory, shard), result,
        "n_bytes long, removed array<struct<start:bigint,end:bigint>>, kept binary", id_col, text_col,
    )


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        id_col, "n_bytes", F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
