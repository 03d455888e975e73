"""Whole-array text primitives: word spans and span hashes over UTF-8 bytes.

A batch of texts is one byte array plus document offsets; nulls are empty
texts.  All hashes are 64-bit polynomials over per-byte random values, so a
span's hash does not depend on where the span lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Multipliers of the polynomials; odd, so they have inverses modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words that end at white space.
WORD = ~SPACE
#: Bytes of words of letters and digits (after lower-casing) and all non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (documents + 1) of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]), offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes, or of one document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and each document's first word (documents + 1)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (edge[:-1] | ~inside[:-2]))
    ends = np.flatnonzero(inside[1:-1] & (edge[1:] | ~inside[2:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    got = _powers.get(base)
    if got is None or len(got[0]) <= n:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * U64(pow(b, len(p), 2**64))])
            both.append(p)
        got = (both[0], both[1])
        if size <= 1 << 22:
            _powers[base] = got
    return got


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Running sums of values[i] * base**i, one longer than values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[0][: len(values)], out=out[1:])
    return out


def between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the spans whose running sums are given."""
    return mix((sums[ends] - sums[starts]) * powers(base, len(sums))[1][starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return between(prefix(BYTE_VALUES[data], BYTE_BASE), starts, ends, BYTE_BASE)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each ``width`` consecutive words, by first word."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    at = np.arange(len(hashes) - width + 1)
    return between(prefix(hashes, WORD_BASE), at, at + width, WORD_BASE)
