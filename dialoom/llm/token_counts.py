"""Token counts by rank-synchronous merging of ragged symbol arrays.

A batch's distinct pre-tokens lie in one flat symbol array.  Each round finds
every sequence's lowest-ranked adjacent pair and merges all its occurrences
(left to right where they overlap) in all sequences at once; sequences with no
mergeable pair leave the arrays.  What is left are the tokens.

Cases: a null or empty text has 0 bytes and 0 tokens; a text that is not UTF-8
is read with U+FFFD for what is no character, but ``n_bytes`` counts the bytes
that are there; a very long text is one sequence of pieces like any other; of
overlapping pairs of one rank the left one merges; ids that repeat give one row
each; columns other than the id and the text are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the byte-level pre-token pattern of the vocabulary.  White space is
#: spelled out, since libraries differ on the information separators.
SPACES = r"\x09-\x0D\x20\x85\xA0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACES + r"\p{L}\p{N}]+|[" + SPACES + r"]+(?![^" + SPACES + r"])|[" + SPACES + r"]+"
)
#: The same cuts for texts of ASCII and accented Latin letters, which most are, in ``re``, which is faster.
LATIN = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u017F"
PLAIN = re.compile(rf" ?[{LATIN}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\t-\r {LATIN}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
FULL = regex.compile(PATTERN)
OTHER = re.compile("[^\x00-\x7E\u00C0-\u017F]")
NONE = np.iinfo(np.int32).max
#: Distinct pre-tokens remembered in a worker; beyond it the memory starts anew.
REMEMBERED = 700_000


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pre_tokens(text: str) -> list[str]:
    return (FULL if OTHER.search(text) else PLAIN).findall(text)


class RankMerger:
    """Byte-level merges of a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, of = spec["model"], byte_characters()
        vocab: dict[str, int] = model["vocab"]
        self.byte_ids = np.zeros(256, np.uint32)
        for c, b in of.items():
            self.byte_ids[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        bits = max(12, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self._place(bits)
        self.special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _place(self, bits: int) -> None:
        """Fill an open-addressed table of positions in ``keys``, all pending keys at a time."""
        mask, pending = (1 << bits) - 1, np.arange(len(self.keys), dtype=np.int32)
        at, self.probes = self._hash(self.keys), 0
        while len(pending):
            self.probes += 1
            free = self.slots[at] < 0
            self.slots[at[free]] = pending[free]
            lost = self.slots[at] != pending
            pending, at = pending[lost], (at[lost] + 1) & mask
        self.mask = mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each adjacent pair, or NONE."""
        keys = left.astype(np.uint64) << np.uint64(32) | right
        out = np.full(len(keys), NONE, np.int32)
        at, todo = self._hash(keys), np.arange(len(keys))
        for _ in range(self.probes):
            got = self.slots[at]
            used = got >= 0
            at, todo, got = at[used], todo[used], got[used]
            same = self.keys[got] == keys[todo]
            out[todo[same]] = self.ranks[got[same]]
            at, todo = (at[~same] + 1) & self.mask, todo[~same]
            if not len(todo):
                break
        return out

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out, ids = sizes.copy(), np.flatnonzero(sizes > 1)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.byte_ids[flat[np.repeat(sizes > 1, sizes)]]
        sizes = sizes[ids]
        ranks = None
        while len(ids):
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            last = starts + sizes - 1
            if ranks is None:
                ranks = np.full(len(symbols), NONE, np.int32)
                ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
                ranks[last] = NONE
            least = np.minimum.reduceat(ranks, starts)
            live = least < NONE
            if not live.all():
                out[ids[~live]] = sizes[~live]
                keep = np.repeat(live, sizes)
                symbols, ranks, ids, sizes, least = symbols[keep], ranks[keep], ids[live], sizes[live], least[live]
                if not len(ids):
                    break
            hit = np.flatnonzero(ranks == np.repeat(least, sizes))
            # of occurrences that overlap, every second goes
            if len(hit) > 1 and (touch := np.diff(hit) == 1).any():
                first = np.concatenate([[True], ~touch])
                run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            seq = np.repeat(np.arange(len(ids)), sizes)
            symbols[hit] = self.made[ranks[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            sizes = sizes - np.bincount(seq[hit], minlength=len(ids))
            # only pairs beside a merge change
            moved = hit - np.arange(len(hit))
            symbols, ranks, seq = symbols[keep], ranks[keep], seq[keep]
            near = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            inner = near[(near + 1 < len(symbols)) & (seq[np.minimum(near + 1, len(seq) - 1)] == seq[near])]
            ranks[near] = NONE
            ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        return out


_loaded: dict[str, tuple[RankMerger, dict[str, int]]] = {}


def _model(path: str) -> tuple[RankMerger, dict[str, int]]:
    if path not in _loaded:
        _loaded[path] = (RankMerger(path), {})
    return _loaded[path]


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text, special strings counting as one token."""
    merger, known = _model(path)
    pieces_of, extra, new = [], [], set()
    for text in texts:
        text = text or ""
        parts = merger.split.split(text) if merger.split and merger.split.search(text) else [text]
        pieces = [p for part in parts for p in pre_tokens(part)] if len(parts) > 1 else pre_tokens(text)
        pieces_of.append(pieces)
        extra.append(len(parts) - 1)
        new.update(pieces)
    if len(known) > REMEMBERED:
        known.clear()
    new = [p for p in new if p not in known]
    if new:
        known.update(zip(new, merger.count([p.encode() for p in new]).tolist(), strict=True))
    return [e + sum(map(known.__getitem__, p)) for e, p in zip(extra, pieces_of, strict=True)]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens and whether it is over ``limit``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, lo = batch.column(0), batch.column(1), 0
            sizes = texts.cast(pa.large_binary()).fill_null(b"")
            while lo < len(ids):  # pieces of a few MB, so that what is held stays small
                hi, got = lo, 0
                while hi < len(ids) and got < 2_000_000:
                    got += len(sizes[hi].as_buffer())
                    hi += 1
                counts = count_texts([x.as_buffer().to_pybytes().decode("utf-8", "replace") for x in sizes.slice(lo, hi - lo)], path)
                yield pa.record_batch([ids.slice(lo, hi - lo), pa.array(counts, pa.int64())], ["id", "n_tokens"])
                lo = hi

    # The size travels with the id, so that the text is sent to Python once.
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n")).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id struct<id:{kind},n:bigint>, n_tokens long").select(
        F.col("id.id").alias(id_col), F.col("id.n").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
