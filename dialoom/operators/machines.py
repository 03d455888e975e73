"""Boundary finding that needs the state of the rows before: one pass over a file's rows.

Each machine is a function of a file's rows in order, applied to groups of one
file; look-aheads are arrays made once for the file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

HOST, UNKNOWN = "SPEAKER_00", "UNKNOWN"
Span = tuple[str, int, int, float, float]
SPANS = "file_id long, kind string, first_idx long, last_idx long, start_s double, end_s double"


def per_file(df: DataFrame, rows: Callable[[pd.DataFrame], Iterator[Span]]) -> DataFrame:
    """Spans (kind, first, last, start, end) of each file."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seg_idx", ignore_index=True)
        out = [(int(pdf.file_id.iloc[0]), *s) for s in rows(pdf)]
        return pd.DataFrame(out, columns=["file_id", "kind", "first_idx", "last_idx", "start_s", "end_s"])

    return df.groupBy("file_id").applyInPandas(run, SPANS)


def next_true(mask: np.ndarray) -> np.ndarray:
    """For each row the first later row where the mask holds, or the number of rows."""
    n = len(mask)
    at = np.where(mask, np.arange(n), n)
    return np.append(np.minimum.accumulate(at[::-1])[::-1][1:], n) if n else at


def guests(pdf: pd.DataFrame, host: str = HOST) -> np.ndarray:
    return ~pdf.speaker.isin([host, UNKNOWN]).to_numpy()


def conversation_boundaries(pdf: pd.DataFrame, host: str = HOST, quiet: float = 120, change: float = 60, tail: float = 30, least: float = 180) -> Iterator[Span]:
    """One guest at a time; closed by the host after ``quiet`` seconds, by another guest after ``change``; longer than ``least``.

    An end of 0.0 counts as no guest's end, as in the rule.
    """
    start, end, who = pdf.start_s.to_numpy(), pdf.end_s.to_numpy(), pdf.speaker.to_numpy()
    is_guest = guests(pdf, host)
    open_, found = None, []  # (guest, start, last guest end, first row, last row)
    for i in range(len(pdf)):
        if not is_guest[i]:
            if open_ and open_[2]:
                if start[i] - open_[2] > quiet:
                    found.append((*open_[:2], open_[2] + tail, *open_[3:]))
                    open_ = None
                else:
                    open_ = (*open_[:4], i)
        elif open_ is None or (who[i] != open_[0] and start[i] - open_[2] > change):
            if open_:
                found.append((*open_[:2], open_[2] + tail, *open_[3:]))
            open_ = (who[i], start[i], end[i], i, i)
        else:
            open_ = (open_[0], open_[1], end[i] if who[i] == open_[0] else open_[2], open_[3], i)
    if open_:
        found.append((open_[0], open_[1], end[open_[4]], *open_[3:]))
    for guest, s, e, first, last in found:
        if e - s > least:
            yield guest, first, last, float(s), float(e)


def merge_short_pairs(spans: list[Span], least: float = 180, near: float = 120) -> list[Span]:
    """A short span takes the next one with it if that begins soon; both are then done with."""
    out, i = [], 0
    while i < len(spans):
        a = spans[i]
        if a[4] - a[3] < least and i + 1 < len(spans) and spans[i + 1][3] - a[4] < near:
            b = spans[i + 1]
            out.append((f"{a[0]}/{b[0]}", a[1], b[2], a[3], b[4]))
            i += 2
        else:
            out.append(a)
            i += 1
    return out


def opening_call_comment(pdf: pd.DataFrame, greeting: str, goodbye: str, host: str = HOST) -> Iterator[Span]:
    """Opening to the host's first greeting; calls to a goodbye that the host's monologue follows; comments to the next greeted guest."""
    text, who = pdf.text, pdf.speaker.to_numpy()
    hi = ((pdf.speaker == host) & text.str.contains(greeting, regex=False)).to_numpy()
    is_guest = guests(pdf, host)
    bye = is_guest & text.str.contains(goodbye, regex=False).to_numpy()
    guest_next, n = next_true(is_guest), len(pdf)
    hosts = np.append(0, np.cumsum(who == host))
    state, first = "opening", 0
    for i in range(n):
        ahead = min(i + 30, n)
        alone = guest_next[i] >= ahead
        move = None
        if state == "opening" and hi[i]:
            move = "call"
        elif state == "call" and bye[i] and i > first and alone and hosts[ahead] - hosts[i + 1] > 5:
            yield "call", first, i, float(pdf.start_s[first]), float(pdf.end_s[i])
            state, first = "comment", i + 1
        elif state == "comment" and hi[i] and not alone:
            move = "call"
        if move:
            if state == "opening" and i > 0:
                yield "opening", 0, i - 1, float(pdf.start_s[0]), float(pdf.start_s[i])
            state, first = "call", i


def greeted_calls(pdf: pd.DataFrame, opening: str, greeting: str, goodbye: str, host: str = HOST) -> Iterator[Span]:
    """After the opening sign, calls from a greeting with a guest in 50 rows to a short goodbye that no guest follows in 50, or the last guest in 2000."""
    is_host = (pdf.speaker == host).to_numpy()
    text = pdf.text
    opens = np.flatnonzero(is_host & text.str.contains(opening, regex=False).to_numpy())
    hi = is_host & text.str.contains(greeting, regex=False).to_numpy()
    is_guest = guests(pdf, host)
    short_bye = is_guest & text.str.contains(goodbye, regex=False).to_numpy() & (text.str.len() < 20).to_numpy()
    nxt, n = next_true(is_guest), len(pdf)
    ends = short_bye & (nxt >= np.minimum(np.arange(n) + 50, n))
    i = (int(opens[0]) if len(opens) else 0) + 1
    while i < n:
        if hi[i] and nxt[i] < min(i + 50, n):
            begin = int(nxt[i])
            reach = min(begin + 2000, n)
            stop = np.flatnonzero(ends[begin:reach])
            last = begin + int(stop[0]) if len(stop) else begin + int(np.flatnonzero(is_guest[begin:reach])[-1])
            yield "call", i, last, float(pdf.start_s[i]), float(pdf.end_s[last])
            i = last + 1
        else:
            i += 1


def guest_run_calls(pdf: pd.DataFrame, least: float = 60, pause: float = 30, host: str = HOST) -> Iterator[Span]:
    """A guest's speech with host runs of up to ``pause`` seconds between, of ``least`` seconds in all."""
    who, start, end = pdf.speaker.to_numpy(), pdf.start_s.to_numpy(), pdf.end_s.to_numpy()
    edge = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else np.zeros(0, int)
    runs = [(who[a], a, b, (end[a : b + 1] - start[a : b + 1]).sum()) for a, b in zip(edge, [*(edge[1:] - 1), len(who) - 1], strict=True)]
    i = 0
    while i < len(runs):
        guest, first, last, total = runs[i]
        j = i + 1
        if guest in (host, UNKNOWN):
            i = j
            continue
        while j < len(runs) and (runs[j][0] == guest or (runs[j][0] == host and runs[j][3] <= pause)):
            if runs[j][0] == guest:
                last, total = runs[j][2], total + runs[j][3]
            j += 1
        if total >= least:
            yield guest, int(first), int(last), float(start[first]), float(end[last])
        i = j


def looked_ahead_guests(pdf: pd.DataFrame, hosts: tuple[str, ...] = (HOST, "SPEAKER_02"), guest_rows: int = 9, host_rows: int = 19) -> Iterator[Span]:
    """A guest's conversation ends at another guest unless it speaks in the next rows, and at a host row unless it is the next guest within some more."""
    who, n = pdf.speaker.to_numpy(), len(pdf)
    is_guest = ~np.isin(who, [*hosts, UNKNOWN])
    later = {g: next_true(who == g) for g in set(who[is_guest])}
    any_guest = next_true(is_guest)
    open_, first = None, 0

    def closed(upto: int) -> Span:
        return open_, first, upto - 1, float(pdf.start_s[first]), float(pdf.end_s[upto - 1])

    for i in range(n):
        if is_guest[i]:
            if open_ is None:
                open_, first = who[i], i
            elif who[i] != open_ and later[open_][i] > i + guest_rows:
                yield closed(i)
                open_, first = who[i], i
        elif open_ is not None and not (later[open_][i] <= i + host_rows and any_guest[i] == later[open_][i]):
            yield closed(i + 1)
            open_ = None
    if open_ is not None:
        yield closed(n)


def substantial_guest_switches(pdf: pd.DataFrame, least: int = 15, host: str = HOST) -> Iterator[Span]:
    """Guests' turns by substantial speech; another guest takes over after two host rows or ten rows' silence; a last call of two rows goes."""
    said = pdf.text.str.replace(r"[\s\W_]", "", regex=True).str.len().to_numpy() >= least
    who = pdf.speaker.to_numpy()
    calls: list[list] = []
    hosts, seen = 0, -1
    for i in range(len(pdf)):
        if who[i] == host:
            hosts += 1
        elif said[i]:
            if not calls or (who[i] != calls[-1][0] and (hosts >= 2 or i - seen >= 10)):
                if calls:
                    calls[-1][2] = seen
                calls.append([who[i], i, None])
            elif who[i] != calls[-1][0]:
                continue
            hosts, seen = 0, i
    if calls and calls[-1][2] is None:
        calls[-1][2] = len(pdf) - 1
    if len(calls) >= 2 and calls[-1][2] + 1 - calls[-1][1] <= 2:
        calls.pop()
    for guest, a, b in calls:
        yield guest, a, b, float(pdf.start_s[a]), float(pdf.end_s[b])


def capped_merge(pdf: pd.DataFrame, gap: float = 0.8, longest: int = 140) -> Iterator[Span]:
    """Runs of one role with small gaps whose text stays within ``longest`` characters."""
    rows = list(zip(np.where(pdf.speaker == HOST, "host", "guest"), pdf.start_s, pdf.end_s, pdf.text.str.len(), strict=True))
    run = None  # role, first, last, start, end, characters
    for i, (role, start, end, size) in enumerate(rows):
        if run and role == run[0] and start - run[4] <= gap and run[5] + size <= longest:
            run = (role, run[1], i, run[3], max(run[4], end), run[5] + size)
        else:
            if run:
                yield str(run[0]), run[1], run[2], float(run[3]), float(run[4])
            run = (role, i, i, start, end, size)
    if run:
        yield str(run[0]), run[1], run[2], float(run[3]), float(run[4])


def smoothed_in_place(labels: list[str], short: np.ndarray) -> list[str]:
    """A short label between two equal others becomes theirs; labels changed before count."""
    out = list(labels)
    for i in range(1, len(out) - 1):
        if short[i] and out[i - 1] == out[i + 1] != out[i]:
            out[i] = out[i - 1]
    return out


def merged_short_runs(labels: list[str], least: int = 3) -> list[str]:
    """The first run under ``least`` joins its equal neighbours, the only one, or the longer (the earlier of equals), until none is left."""
    out = list(labels)
    while True:
        edge = [0, *[i for i in range(1, len(out)) if out[i] != out[i - 1]], len(out)]
        sizes = [b - a for a, b in zip(edge, edge[1:], strict=False)]
        small = next((k for k, n in enumerate(sizes) if n < least), None)
        if small is None or len(sizes) < 2:
            return out
        near = [k for k in (small - 1, small + 1) if 0 <= k < len(sizes)]
        to = max(near, key=lambda k: (sizes[k], -k))
        out[edge[small] : edge[small + 1]] = [out[edge[to]]] * sizes[small]


def largest_remainders(length: int, weights: list[float]) -> list[int]:
    """Whole shares of ``length`` by weight; what is left over goes to the largest fractions, of equals to the later."""
    total = sum(weights)
    if not total:
        return [0] * len(weights)
    exact = [length * w / total for w in weights]
    out = [int(x) for x in exact]
    by = sorted(range(len(exact)), key=lambda i: (exact[i] - out[i], i), reverse=True)
    for i in by[: length - sum(out)]:
        out[i] += 1
    return out


def greedy_pairs(scores: list[tuple[float, str, str]]) -> dict[str, str]:
    """One-to-one by falling score; of equals in order of names."""
    out: dict[str, str] = {}
    for _, a, b in sorted(scores, key=lambda s: (-s[0], s[1], s[2])):
        if a not in out and b not in out.values():
            out[a] = b
    return out


Block = tuple[str, float, float, list]


def fold_blocks(blocks: list[Block], joins, most_samples: int | None = None) -> list[Block]:
    """Neighbouring typed blocks (type, start, end, samples) joined where ``joins(current, next)`` says so; the first type stays."""
    out: list[Block] = []
    for block in blocks:
        if out and joins(out[-1], block):
            kind, start, _, samples = out[-1]
            out[-1] = (kind, start, block[2], (samples + block[3])[:most_samples])
        else:
            out.append((block[0], block[1], block[2], block[3][:most_samples]))
    return out


def same_type(a: Block, b: Block) -> bool:
    return a[0] == b[0]


def same_or_short(a: Block, b: Block, host: float = 240, call: float = 120) -> bool:
    """Equal types, or a short one of the other type inside."""
    return a[0] == b[0] or b[2] - b[1] < (host if b[0] == "host" else call)


def opening_prior(labels: list[str], start: list[float], duration: list[float], cue: list[bool]) -> list[str]:
    """Of the first three sentences within 24 s one with a host's cue is the host's if a guest speaks 1.5 s in the next two; labels changed before count."""
    out = list(labels)
    for i in range(min(3, len(out))):
        follows = any(out[j] == "guest" and duration[j] >= 1.5 for j in range(i + 1, min(i + 3, len(out))))
        if start[i] <= 24 and cue[i] and follows:
            out[i] = "host"
    return out


def voted(base: list[str], votes: list[tuple[str, float]], least: float = 0.6) -> list[str]:
    """Labels overridden by window votes (label, share) of ``least`` or more."""
    return [v if share >= least else b for b, (v, share) in zip(base, votes, strict=True)]


def proportional_slices(text: str, shares: list[float]) -> list[str]:
    """Consecutive pieces of a text by cumulative share, rounded half to even; nothing is lost."""
    total, at, out = sum(shares) or 1.0, 0, []
    for k in range(len(shares)):
        to = len(text) if k == len(shares) - 1 else round(len(text) * sum(shares[: k + 1]) / total)
        out.append(text[at:to])
        at = to
    return out
