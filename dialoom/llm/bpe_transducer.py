"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

The merges of a rank file decide, for each prefix of a piece, one last token:
the token that ends there and may follow the last token of the prefix before
it.  A state is the longest end of what was read that begins a token, a node of
the vocabulary's trie, which tells all places where a token may still start,
and the last tokens at those places and between them, back to the place that
all of them go through.  Reading a byte finds the new last token and the new
common place; tokens up to it are emitted.  A token starts no further back than
the longest token has bytes, so that is the lookahead.  States and transitions
are made when first met; all that a machine remembers is counted in bytes, and
beyond ``STATE_BYTES`` forgotten but for the state it is in, so a piece of any
length needs no more.  Remembered pieces have ``PIECE_BYTES``.  Both go when a
worker has had no partition for ``IDLE`` seconds; only the vocabulary stays.

Two tokens may stand side by side if no pair across their border would have
merged before they were whole.  That is read off the borders' histories: the
younger of the two symbols at the border is taken apart, again and again, and
each pair met on the way must not merge before the split it comes from.

Cases: a null or empty text has no ids and an empty decoded text; a text that
is not UTF-8 is read with U+FFFD for what is no character; very long texts take
no more memory than their ids and text; ids that repeat give one row each, ties
do not arise; columns other than the id and the text are ignored; an empty
table gives no rows; ids outside the vocabulary raise KeyError on decoding.
"""

from __future__ import annotations

import base64
import gc
import re
import threading
from bisect import insort
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.token_counts import pre_tokens

#: Bytes that a machine's states and pairs, and a worker's remembered pieces, may take.
STATE_BYTES, PIECE_BYTES = 128 << 20, 96 << 20
#: About what Python needs for a state and each of its places, a transition, a pair, and a piece besides its bytes.
STATE, PLACE, MOVE, PAIR, PIECE = 220, 8, 160, 120, 220
#: In place of a last token: none at the start of a piece, and one that no longer matters.
START, PAST = -1, -2
HIGH = re.compile("[\x80-\xff]+")
NEVER = 1 << 62
#: Seconds without work after which a worker forgets what it learnt.
IDLE = 2.0


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class MergeTransducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.size_of = {i: len(b) for b, i in ranks.items()}
        # trie: edge (node << 8 | byte) -> node; of each node its token or -1, its parent's edge to it, its depth
        self.edges: dict[int, int] = {}
        self.token_at, self.edge_to, self.depth = [-1], [0], [0]
        for piece, token in ranks.items():
            node = 0
            for byte in piece:
                key = node << 8 | byte
                made = self.edges.setdefault(key, len(self.token_at))
                if made == len(self.token_at):
                    self.token_at.append(-1)
                    self.edge_to.append(key)
                    self.depth.append(self.depth[node] + 1)
                node = made
            self.token_at[node] = token
        #: Of a node: the node of its longest end that is one, and (depths of all such ends, tokens among them).
        self.shorter: dict[int, int] = {0: 0}
        self.tails: dict[int, tuple[tuple[int, ...], tuple[int, ...]]] = {0: ((), ())}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.alone: dict[int, bool] = {}
        #: Histories tell about pairs only if every token comes after its parts.
        self.ordered = True
        self._reset()

    def _reset(self, keep: tuple[int, ...] | None = None) -> int:
        """Forget what was learnt, but for the state ``keep``; returns its number."""
        start = (0, START)
        self.states: list[tuple[int, ...]] = [start]
        self.ids: dict[tuple[int, ...], int] = {start: 0}
        #: (state << 8 | byte) -> state << 1, and 1 if ``emits`` has tokens for it.
        self.moves: dict[int, int] = {}
        self.emits: dict[int, tuple[int, ...]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.held = 0
        return 0 if keep is None else self._number(keep)

    def _number(self, key: tuple[int, ...]) -> int:
        got = self.ids.get(key)
        if got is None:
            got = self.ids[key] = len(self.states)
            self.states.append(key)
            self.held += STATE + PLACE * len(key)
        return got

    def _next(self, node: int, byte: int) -> int:
        """The longest end of node and byte that begins a token."""
        while (to := self.edges.get(node << 8 | byte)) is None:
            if not node:
                return 0
            node = self._shorter(node)
        return to

    def _shorter(self, node: int) -> int:
        got = self.shorter.get(node)
        if got is None:
            key = self.edge_to[node]
            got = self.shorter[node] = self._next(self._shorter(key >> 8), key & 255) if key >> 8 else 0
        return got

    def _tails(self, node: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
        got = self.tails.get(node)
        if got is None:
            depths, tokens = self._tails(self._shorter(node))
            token = self.token_at[node]
            if token >= 0 and self.follows(-1, token):
                tokens = (token, *tokens)
            got = self.tails[node] = ((self.depth[node], *depths), tokens)
        return got

    def merged(self, piece: bytes, parts_left: int = 1) -> list[int]:
        """Tokens after all merges, lowest rank first, down to ``parts_left``; for short pieces."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        get = self.ranks.get
        while len(parts) > parts_left:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [get(p) for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte."""
        if token in self.halves:
            return self.halves[token]
        piece = self.bytes_of[token]
        got = None
        if len(piece) > 1:
            parts = self.merged(piece, 2)
            if len(parts) == 2:
                got = (parts[0], parts[1])
            if got is None or max(got) >= token:
                self.ordered = False
        self.halves[token] = got
        return got

    def _apart(self, left: int, right: int) -> bool:
        """Whether no pair across the border of two tokens merges before both are whole."""
        get, bytes_of, limit = self.ranks.get, self.bytes_of, NEVER
        while True:
            rank = get(bytes_of[left] + bytes_of[right])
            if rank is not None and rank < limit:
                return False
            a, b = self.split(left), self.split(right)
            if a is None and b is None:
                return True
            # at equal ranks the left one merges first
            if b is None or (a is not None and left > right):
                limit, left = left, a[1]
            else:
                limit, right = right + 1, b[0]

    def follows(self, left: int, token: int) -> bool:
        """Whether ``token`` may come right after ``left`` (-1: at the start)."""
        if left < 0:
            known = self.alone.get(token)
            if known is None:
                known = self.alone[token] = self.merged(self.bytes_of[token]) == [token]
            return known
        key = left << 32 | token
        known = self.pairs.get(key)
        if known is None:
            known = self.follows(-1, token) and self._apart(left, token)
            if not self.ordered:
                known = self.merged(self.bytes_of[left] + self.bytes_of[token]) == [left, token]
            self.pairs[key] = known
            self.held += PAIR
        return known

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after a byte, and the tokens that are certain then."""
        now = self.states[state]
        node = self.edges.get(now[0] << 8 | byte)
        if node is None:
            node = self._next(now[0], byte)
        depths, tokens = self.tails.get(node) or self._tails(node)
        # place k of the state is entry k + 1 of the tuple
        n, size_of, pairs = len(now), self.size_of, self.pairs
        for token in tokens:
            left = now[n - size_of[token]]
            if left < 0:
                break
            known = pairs.get(left << 32 | token)
            if known or (known is None and self.follows(left, token)):
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        last, kept = (*now, token), [PAST] * (n + 1)
        # back from all places where a token may start, the latest first, to the one place they share
        places = [n - d for d in depths]
        places.append(n)
        live = places[:1]
        while len(places) > 1:
            at = places.pop()
            kept[at] = token = last[at]
            at -= size_of[token]
            if at not in places:
                insort(places, at)
        base = at = places[0]
        out = []
        while at > 1:
            out.append(last[at])
            at -= size_of[last[at]]
        kept[0], kept[base] = node, last[base] if base in live else PAST
        key, out = (node, *kept[base:]), tuple(out[::-1])
        if self.held > STATE_BYTES:
            return self._reset(key), out
        to, move = self._number(key), state << 8 | byte
        self.moves[move] = to << 1 | bool(out)
        self.held += MOVE
        if out:
            self.emits[move] = out
            self.held += MOVE
        return to, out

    def _end(self, state: int) -> tuple[int, ...]:
        last, out = self.states[state][1:], []
        at = len(last) - 1
        while at:
            out.append(last[at])
            at -= self.size_of[last[at]]
        got = self.ends[state] = tuple(out[::-1])
        self.held += MOVE
        return got

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out, moves, emits = 0, [], self.moves, self.emits
        for byte in piece:
            step = moves.get(move := state << 8 | byte)
            if step is None:
                state, made = self._move(state, byte)
                out += made
                moves, emits = self.moves, self.emits
            else:
                if step & 1:
                    out += emits[move]
                state = step >> 1
        out += self.ends.get(state) or self._end(state)
        return out


class Utf8Stream:
    """Incremental UTF-8: text of the bytes so far; an unfinished character waits.

    A machine whose state is the bytes of the character under way.  In each
    state a byte either goes on with the character, ends it, or cannot follow:
    then what waits becomes U+FFFD and the byte starts anew.  Bytes below 0x80
    end any character, so runs of them are passed on whole; what a run of other
    bytes does in a state is worked out byte by byte once and remembered.
    """

    MEMO = 20_000

    def __init__(self) -> None:
        self.waiting = b""
        #: What a run of bytes becomes from the first state, if it ends there too.
        self.whole: dict[str, str] = {}

    @staticmethod
    def _due(lead: int) -> tuple[int, int, int]:
        """Bytes of a character that begins with ``lead`` (0: none does), and the bounds of its second byte."""
        if 0xC2 <= lead <= 0xDF:
            return 2, 0x80, 0xBF
        if 0xE0 <= lead <= 0xEF:
            return 3, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        if 0xF0 <= lead <= 0xF4:
            return 4, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        return 0, 0, 0

    def _step(self, waiting: bytes, byte: int) -> tuple[str, bytes]:
        """Text given out on a byte of 0x80 or more, and the bytes that wait then."""
        if waiting:
            size, lo, hi = self._due(waiting[0])
            if len(waiting) > 1:
                lo, hi = 0x80, 0xBF
            if lo <= byte <= hi:
                waiting += bytes([byte])
                if len(waiting) < size:
                    return "", waiting
                point = waiting[0] & (0xFF >> (size + 1))
                for more in waiting[1:]:
                    point = point << 6 | more & 0x3F
                return chr(point), b""
            text, waiting = self._step(b"", byte)
            return "\ufffd" + text, waiting
        return ("", bytes([byte])) if self._due(byte)[0] else ("\ufffd", b"")

    def _run(self, high: str) -> str:
        out = []
        for byte in high.encode("latin-1"):
            text, self.waiting = self._step(self.waiting, byte)
            out.append(text)
        return "".join(out)

    def feed(self, more: bytes) -> str:
        data, end, whole = more.decode("latin-1"), len(more), self.whole
        before = self.close() if self.waiting and data and data[0] < "\x80" else ""

        def run(found: re.Match[str]) -> str:
            high = found[0]
            text = whole.get(high)
            if text is None or self.waiting:
                fresh, text = not self.waiting, self._run(high)
                if fresh and not self.waiting and len(high) <= 16:
                    if len(whole) >= self.MEMO:
                        whole.clear()
                    whole[high] = text
                elif self.waiting and found.end() < end:
                    text += self.close()
            return text

        return before + HIGH.sub(run, data)

    def close(self) -> str:
        rest, self.waiting = self.waiting, b""
        return "\ufffd" if rest else ""


def decode_stream(ids: Iterable[int], bytes_of: dict[int, bytes], step: int = 4096, stream: Utf8Stream | None = None) -> Iterator[str]:
    """Text of a stream of ids, given out as soon as its characters are whole."""
    stream = stream or Utf8Stream()
    for some in batched(ids, step):
        yield stream.feed(b"".join(map(bytes_of.__getitem__, some)))
    yield stream.close()


class Codec:
    """Encodes and decodes texts with one vocabulary; what it learns is bounded."""

    def __init__(self, path: str):
        self.machine = MergeTransducer(load_ranks(path))
        self.stream = Utf8Stream()
        self.idle: threading.Timer | None = None
        self.release()

    def release(self) -> None:
        """Forget all but the vocabulary."""
        self.machine._reset()
        #: Remembered pieces, in two generations: the older goes when the younger is full.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def _learn(self, pieces: Iterable[str]) -> None:
        for piece in pieces:
            got = self.old.get(piece)
            if got is None:
                got = np.array(self.machine.encode_piece(piece.encode()), "<u4").tobytes()
            self.young[piece] = got
            self.size += PIECE + 2 * len(piece) + len(got)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = pre_tokens(text)
        if self.size > PIECE_BYTES // 2:
            self.old, self.young, self.size = self.young, {}, 0
        self._learn(set(pieces).difference(self.young))
        return b"".join(map(self.young.__getitem__, pieces))

    def decode(self, ids: bytes | pa.Buffer) -> str:
        return "".join(decode_stream(np.frombuffer(ids, "<u4").tolist(), self.machine.bytes_of, stream=self.stream))


_loaded: dict[str, Codec] = {}


@contextmanager
def codec_of(path: str) -> Iterator[Codec]:
    """The worker's codec; it forgets what it learnt ``IDLE`` seconds after the last partition that used it."""
    codec = _loaded.get(path) or _loaded.setdefault(path, Codec(path))
    if codec.idle:
        codec.idle.cancel()
        codec.idle.join()
    # what is learnt has no cycles, and looking for them takes a fifth of the time
    collects = gc.isenabled()
    gc.disable()
    try:
        yield codec
    finally:
        if collects:
            gc.enable()
        codec.idle = threading.Timer(IDLE, codec.release)
        codec.idle.daemon = True
        codec.idle.start()


def encode_text(text: str, path: str) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers."""
    with codec_of(path) as codec:
        return codec.encode(text)


def _text(value: pa.Scalar) -> str:
    return value.as_buffer().to_pybytes().decode("utf-8", "replace") if value.is_valid else ""


def _mapped(rows: DataFrame, path: str, id_col: str, make: Callable[[Codec, pa.Scalar], tuple], columns: str) -> DataFrame:
    """One row per row of (id, value): id and what ``make`` gives for the value, a few MB at a time."""
    kind = rows.schema[id_col].dataType.simpleString()
    types = {"binary": pa.binary(), "string": pa.string()}
    fields = [c.strip().split() for c in columns.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec_of(path) as codec:
            for batch in batches:
                lo, size, out = 0, 0, []
                for k, value in enumerate(batch.column(1)):
                    out.append(make(codec, value))
                    size += sum(map(len, out[-1]))
                    if size > 4_000_000 or k == batch.num_rows - 1:
                        made = [pa.array(x, types[t]) for x, (_, t) in zip(zip(*out, strict=True), fields, strict=True)]
                        yield pa.record_batch([batch.column(0).slice(lo, len(out)), *made], ["id", *(name for name, _ in fields)])
                        lo, size, out = k + 1, 0, []

    return rows.mapInArrow(run, f"id {kind}, {columns}").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``ids``, little-endian unsigned 32-bit integers."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return _mapped(rows, path, id_col, lambda codec, text: (codec.encode(_text(text)),), "ids binary")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per row: id and ``text``, the decoded ``ids``."""
    rows = tokens.select(F.col(id_col), "ids")
    return _mapped(rows, path, id_col, lambda codec, ids: (codec.decode(ids.as_buffer()) if ids.is_valid else "",), "text string")


def recode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``ids``, and ``text``, those ids decoded again, in one pass."""

    def both(codec: Codec, text: pa.Scalar) -> tuple[bytes, str]:
        ids = codec.encode(_text(text))
        return ids, codec.decode(ids)

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return _mapped(rows, path, id_col, both, "ids binary, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return recode(docs, path, id_col, text_col).select(
        id_col,
        F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )
