"""Suffix order and common prefixes of a shard by external induced sorting.

The shard is pieces joined by ends; an end is a character of its own that sorts
before all bytes, ends among each other by place, so suffixes compare within
their piece and no two are equal.  Suffixes are S (smaller than the next one)
or L.  The leftmost of each run of S suffixes are sorted first: dealt to files
by their first two characters, a file at a time ordered and named by their
substrings, six characters a pass; then pairs of names are named again, and
pairs of those, until all names differ.  From them all L suffixes are induced in
rising order of first characters and then all S suffixes in falling order.
Tuples (position, common prefix with the tuple before) travel through
disk-backed queues whose priority is the first character and then the order of
arrival, which is that of the suffixes: a tuple made from another shares one
character more than the least common prefix passed since the last tuple for the
same queue.

Everything is worked on in blocks.  Beyond ``memory`` bytes the queues' tails
lie in files of the task's temporary folder, which go when the sort ends, and
so do the text and the arrays of its length, which are mapped from files; so a
shard may be many times as long as memory.  The order is exact to the ends of
the pieces; common prefixes are exact up to ``limit`` characters, more reads as
``limit``.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np

BLOCK, MEMORY = 1 << 20, 128 << 20
#: Characters: the end of the shard, which sorts first, the end of a piece, then the bytes.
END, PIECE, BYTES = 0, 1, 2
CHARS = 256 + BYTES
#: Common prefixes are 16-bit numbers.
LONGEST = 60_000


class Queues:
    """First-in first-out queues of tuples, one for each character; tails in files beyond ``memory`` bytes."""

    def __init__(self, memory: int, folder: Path):
        folder.mkdir()
        self.memory, self.folder, self.held, self.spilled = memory, folder, 0, 0
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.files: set[int] = set()

    def push(self, char: int, positions: np.ndarray, common: np.ndarray) -> None:
        if len(positions):
            self.parts.setdefault(char, []).append((positions, common))
            self.held += positions.nbytes + common.nbytes
            if self.held > self.memory:
                self._spill()

    def _spill(self) -> None:
        for char, parts in self.parts.items():
            with open(self.folder / f"{char}.at", "ab") as at, open(self.folder / f"{char}.lcp", "ab") as lcp:
                for positions, common in parts:
                    positions.tofile(at)
                    common.tofile(lcp)
                    self.spilled += len(positions)
            self.files.add(char)
        self.parts.clear()
        self.held = 0

    def _taken(self, char: int) -> list[tuple[np.ndarray, np.ndarray]]:
        parts = self.parts.pop(char, [])
        self.held -= sum(p.nbytes + c.nbytes for p, c in parts)
        return parts

    def pop(self, char: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The queue's tuples in order, in blocks; what is pushed meanwhile comes too."""
        while char in self.files or char in self.parts:
            if char in self.files:
                self.files.discard(char)
                names = [self.folder / f"{char}.{x}" for x in ("at", "lcp")]
                for name in names:
                    name.rename(f"{name}.old")
                with open(f"{names[0]}.old", "rb") as at, open(f"{names[1]}.old", "rb") as lcp:
                    while len(positions := np.fromfile(at, np.int64, block)):
                        yield positions, np.fromfile(lcp, np.uint16, block)
                for name in names:
                    Path(f"{name}.old").unlink()
            else:
                positions, common = (np.concatenate(x) for x in zip(*self._taken(char), strict=True))
                for lo in range(0, len(positions), block):
                    yield positions[lo : lo + block], common[lo : lo + block]

    def pop_backwards(self, char: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The tuples in falling order, each with what it has in common with the one that is now before it; nothing is pushed meanwhile."""
        carried = np.uint16(0)
        for positions, common in self._last_first(char, block):
            yield positions[::-1], np.append(carried, common[:0:-1])
            carried = common[0]

    def _last_first(self, char: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for positions, common in reversed(self._taken(char)):
            yield positions, common
        if char in self.files:
            self.files.discard(char)
            at, lcp = self.folder / f"{char}.at", self.folder / f"{char}.lcp"
            left = at.stat().st_size // 8
            while left:
                n = min(block, left)
                left -= n
                yield np.fromfile(at, np.int64, n, offset=8 * left), np.fromfile(lcp, np.uint16, n, offset=2 * left)
            at.unlink()
            lcp.unlink()


class Passed:
    """The least common prefix passed since the last tuple for each character."""

    def __init__(self, limit: int) -> None:
        self.limit = np.uint16(limit)
        self.since = np.zeros(CHARS, np.uint16)

    def deal(self, target: np.ndarray, common: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each wanted target: where it occurs in the block, and the common prefixes of the tuples made there."""
        if not len(target):
            return
        least = common.min()
        there = np.flatnonzero(np.bincount(target[wanted], minlength=CHARS)) if wanted.any() else np.zeros(0, np.int64)
        before = self.since
        self.since = np.minimum(before, least)
        for t in there.tolist():
            at = np.flatnonzero(wanted & (target == t))
            got = np.minimum.reduceat(common[: at[-1] + 1], np.append(0, at[:-1] + 1))
            got[0] = min(got[0], before[t])
            self.since[t] = common[at[-1] + 1 :].min() if at[-1] + 1 < len(common) else self.limit
            yield t, at, np.minimum(got, self.limit - np.uint16(1)) + np.uint16(1)


class SuffixOrder:
    """Positions in suffix order with common prefixes, of pieces with one byte (of any value) after each, at ``ends``."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, memory: int = MEMORY, block: int = BLOCK, limit: int = 64):
        if limit > LONGEST:
            raise ValueError(f"common prefixes are told up to {LONGEST} characters")
        self.folder = Path(tempfile.mkdtemp(prefix="suffixes-"))
        self.memory, self.block, self.limit, self.ends = memory, block, limit, np.asarray(ends, np.int64)
        self.n = n = len(data) + 1
        #: Text, bytes and kinds take some 4 bytes a character, names and their order 8 each for every third or so.
        self.mapped = 10 * n > memory
        self.text = text = self._array("text", np.uint16, n)
        self.raw = raw = self._array("raw", np.uint8, n + limit + 16)
        for lo in range(0, n - 1, block):
            hi = min(lo + block, n - 1)
            raw[lo:hi] = text[lo:hi] = data[lo:hi]
            text[lo:hi] += BYTES
        raw[n - 1 :] = 0
        text[self.ends] = PIECE
        text[n - 1] = END
        self.eight = np.ndarray((len(raw) - 7,), "<u8", buffer=raw.data, strides=(1,))
        # S or L: as at the next position where neighbours differ
        self.smaller = self._array("smaller", np.bool_, n)
        later = True
        for hi in range(n, 0, -block):
            lo = max(0, hi - block)
            own, after = text[lo:hi], np.append(text[lo + 1 : hi + 1], np.full(int(hi == n), CHARS, np.uint16))
            at = np.where(own != after, np.arange(hi - lo), hi - lo)
            at = np.minimum.accumulate(at[::-1])[::-1]
            self.smaller[lo:hi] = np.append(own < after, later)[at]
            later = self.smaller[lo]

    def _array(self, name: str, kind: type, n: int) -> np.ndarray:
        return np.memmap(self.folder / name, kind, "w+", shape=(n,)) if self.mapped else np.empty(n, kind)

    def close(self) -> None:
        self.text = self.raw = self.eight = self.smaller = None
        shutil.rmtree(self.folder, ignore_errors=True)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Characters that suffixes have in common within their pieces, up to ``limit``."""
        room = np.minimum(self._room(a), self._room(b))
        out, todo = np.zeros(len(a), np.int64), np.flatnonzero(room > 0)
        for step in range(0, self.limit, 8):
            diff = self.eight[a[todo] + step] ^ self.eight[b[todo] + step]
            same = diff == 0
            low = diff & (~diff + np.uint64(1))
            out[todo] += np.where(same, 8, (np.log2(low.astype(np.float64), where=~same, out=np.zeros(len(diff))) // 8)).astype(np.int64)
            todo = todo[same & (room[todo] > step + 8)]
            if not len(todo):
                break
        return np.minimum(out, room).astype(np.uint16)

    def _room(self, at: np.ndarray) -> np.ndarray:
        """Characters up to the piece's end, ``limit`` at most."""
        end = np.append(self.ends, self.n - 1)
        return np.minimum(end[np.searchsorted(end, np.minimum(at, self.n - 1))] - at, self.limit)

    def leftmost(self) -> np.ndarray:
        """The leftmost S suffixes in order."""
        found, last = [], False
        with open(self.folder / "leftmost", "wb") as f:
            for lo in range(0, self.n, self.block):
                own = self.smaller[lo : lo + self.block]
                new = np.flatnonzero(own & ~np.append(last if lo else True, own[:-1])) + lo
                last = own[-1]
                found.append(len(new))
                new.tofile(f)
        m = sum(found)
        at = np.memmap(self.folder / "leftmost", np.int64, "r", shape=(m,))
        rank = self._array("rank", np.int64, m)
        tied = self._named(at, rank)
        reach = 1
        while len(tied):  # pairs of names: each round covers twice as many
            tied = self._paired(rank, tied, reach)
            reach *= 2
        order = self._array("order", np.int64, m)
        for lo in range(0, m, self.block):
            order[rank[lo : lo + self.block]] = at[lo : lo + self.block]
        return order

    def _named(self, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Ranks the suffixes by their first substrings; returns those that tie, by rank."""
        m, most = len(at), max(self.memory // 128, 16)
        code = lambda own: self.text[own].astype(np.int64) * CHARS + self.text[np.minimum(own + 1, self.n - 1)]
        count = np.zeros(CHARS * CHARS, np.int64)
        for lo in range(0, m, self.block):
            count += np.bincount(code(at[lo : lo + self.block]), minlength=len(count))
        # files of neighbouring codes, of so many suffixes each, or of one code
        ends, files, held = np.cumsum(count), np.zeros(len(count), np.int64), 0
        for c in np.flatnonzero(count).tolist():
            if held and held + count[c] > most:
                files[c:] += 1
                held = 0
            held += int(count[c])
        n_files = int(files[-1]) + 1
        where = [self.folder / f"names-{k}" for k in range(n_files)]
        for lo in range(0, m, self.block):
            own = np.arange(lo, min(lo + self.block, m))
            of = files[code(at[own])]
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(n_files + 1))
            for k in np.unique(of).tolist():
                with open(where[k], "ab") as f:
                    own[order[cuts[k] : cuts[k + 1]]].tofile(f)
        begin, left = 0, []
        for path in where:
            if path.exists():
                own = np.fromfile(path, np.int64)
                path.unlink()
                local, tied = self._substrings(at, own)
                rank[own] = begin + local
                left.append(own[tied[np.argsort(local[tied], kind="stable")]])
                begin += len(own)
        assert begin == int(ends[-1])
        return np.concatenate(left)

    def _substrings(self, at: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks among ``own``, by substrings up to the next leftmost suffix, and which of them tie."""
        place = at[own]
        after = at[np.minimum(own + 1, len(at) - 1)]
        size = np.where(own + 1 < len(at), after - place + 1, 1)
        rank, tied = np.zeros(len(own), np.int64), np.arange(len(own))
        ended = self.text[place] <= PIECE
        if ended.any():  # ends differ by place
            tied = refine(rank, tied, np.where(ended, place, self.n).astype(np.uint64), np.ones(len(own), bool))
        for step in range(0, int(size.max()), 6):
            if not len(tied):
                break
            key, left = np.zeros(len(tied), np.uint64), size[tied] - step
            for k in range(6):
                where = np.minimum(place[tied] + step + k, self.n - 1)
                one = self.text[where].astype(np.uint64) * np.uint64(2) + self.smaller[where]
                key = key << np.uint64(10) | np.where(k < left, one + np.uint64(1), np.uint64(0))
            tied = refine(rank, tied, key, left > 6)
        count = np.bincount(rank, minlength=len(rank) + 1)
        return rank, np.flatnonzero(count[rank] > 1)

    def _paired(self, rank: np.ndarray, tied: np.ndarray, reach: int) -> np.ndarray:
        """Splits ties by the names ``reach`` further on, some at a time; returns those that still tie, by rank."""
        m, most, lo, left = len(rank), max(self.memory // 128, 16), 0, []
        while lo < len(tied):
            hi = min(lo + most, len(tied))
            while hi < len(tied) and rank[tied[hi]] == rank[tied[hi - 1]]:
                same = np.flatnonzero(rank[tied[hi : hi + most]] != rank[tied[hi - 1]])
                hi = hi + int(same[0]) if len(same) else min(hi + most, len(tied))
            own = tied[lo:hi]
            beyond = own + reach
            key = np.where(beyond < m, rank[np.minimum(beyond, m - 1)] + 1, 0).astype(np.uint64)
            local = rank[own]
            still = refine(local, np.arange(len(own)), key, np.ones(len(own), bool))
            rank[own] = local
            left.append(own[still[np.argsort(local[still], kind="stable")]])
            lo = hi
        return np.concatenate(left)

    def _seeds(self) -> Queues:
        seeds, order, last = Queues(self.memory // 4, self.folder / "seeds"), self.leftmost(), -1
        for lo in range(0, len(order), self.block):
            own = np.asarray(order[lo : lo + self.block])
            common = self.common(np.append(max(last, 0), own[:-1]), own)
            first = self.text[own]
            cuts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
            before = self.text[last] if last >= 0 else CHARS
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(own)], strict=True):
                if a or before != first[0]:
                    common[a] = 0
                seeds.push(int(first[a]), own[a:b], common[a:b])
            last = int(own[-1])
        return seeds

    def _before(self, positions: np.ndarray) -> np.ndarray:
        """First characters of the suffixes one position before; END where there is none."""
        return np.where(positions > 0, self.text[np.maximum(positions - 1, 0)], END)

    def _joined(self, last: int, positions: np.ndarray, common: np.ndarray) -> np.ndarray:
        return np.append(self.common(np.array([last]), positions[:1]), common[1:])

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of suffixes of one first character in falling order, with what each has in common with the one before it."""
        if self.n == 1:
            return
        seeds = self._seeds()
        larger, done = (Queues(self.memory // 4, self.folder / x) for x in ("larger", "done"))
        # rising: L suffixes
        for char in range(CHARS):
            passed, last = Passed(self.limit), None
            for positions, common in larger.pop(char, self.block):
                if last is None:  # nothing in common with another first character
                    common = np.append(np.uint16(0), common[1:])
                done.push(char, positions, common)
                before = self._before(positions)
                # a tuple for the same queue comes after all that are there, and the first of a round shares one character
                for t, at, shares in passed.deal(before, common, before >= char):
                    larger.push(t, positions[at] - 1, shares)
                last = int(positions[-1])
            for positions, common in seeds.pop(char, self.block):
                if last is not None:
                    common, last = self._joined(last, positions, common), None
                before = self._before(positions)
                for t, at, shares in passed.deal(before, common, before > char):
                    larger.push(t, positions[at] - 1, shares)
        # falling: S suffixes, and all in order
        smaller = Queues(self.memory // 4, self.folder / "falling")
        self.spilled = larger.spilled + done.spilled + seeds.spilled
        for char in range(CHARS - 1, -1, -1):
            passed, last = Passed(self.limit), None
            for positions, common in smaller.pop(char, self.block):
                if last is None:
                    common = np.append(np.uint16(0), common[1:])
                yield positions, common
                before = self._before(positions)
                wanted = (before <= char) & (before != END)
                for t, at, shares in passed.deal(before, common, wanted):
                    smaller.push(t, positions[at] - 1, shares)
                last = int(positions[-1])
            for positions, common in done.pop_backwards(char, self.block):
                if last is not None:
                    common, last = self._joined(last, positions, common), None
                yield positions, common
                before = self._before(positions)
                for t, at, shares in passed.deal(before, common, (before < char) & (before != END)):
                    smaller.push(t, positions[at] - 1, shares)


def refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray, further: np.ndarray) -> np.ndarray:
    """Split the ranks of ``tied`` members (all of each rank) by ``key``; returns those still tied that have ``further`` to go.

    A rank is the number of members before the first with it.
    """
    ranks = rank[tied]
    if not len(ranks):
        return tied
    if ranks.max() == ranks.min():
        order = np.argsort(key)
    elif key.max() < 1 << 32 and ranks.max() < 1 << 31:  # both fit one number
        order = np.argsort(ranks.astype(np.uint64) << np.uint64(32) | key)
    else:
        order = np.lexsort((key, ranks))
    old, sorted_key = ranks[order], key[order]
    new = np.append(True, (old[1:] != old[:-1]) | (sorted_key[1:] != sorted_key[:-1]))
    head = np.append(True, old[1:] != old[:-1])
    place = np.arange(len(order))
    within = place - np.maximum.accumulate(np.where(head, place, 0))
    start = np.maximum.accumulate(np.where(new, place, 0))
    rank[tied[order]] = old + within[start]
    group = np.cumsum(new) - 1
    again = (np.bincount(group)[group] > 1) & further[order]
    return tied[order[again]]
