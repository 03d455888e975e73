"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes, A-Z lower-cased, and one end byte (0xFF, which UTF-8
never has).  A byte is eight binary decisions; each decision's node, the bits
before it, has its own context tree over the ``DEPTH`` bytes before.  Counts of
(context, byte) from the training documents give each tree node a
Krichevsky-Trofimov estimate, and the weighting of a node is half its own
estimate and half the product of its children's, so all depths are mixed by how
well they code the training bytes.  The probability of a byte is the product of
its decisions' under the trees as they stand after training.

A chunk sends each distinct string of ``DEPTH`` + 1 bytes with its training
count to the bucket of its last two context bytes, where all deeper nodes meet;
what they give for the nodes of depth one, of which there are at most 256 * 255
whatever the corpus, is summed and sent to all buckets; and
the bucket answers the chunk with the log-probability of each string it sent.
Words are counted in the same rounds for the base score.

Log-probabilities of strings travel as 32-bit floats, so a byte's code length is
good to about seven digits; sums are 64-bit.

Cases: a null or empty text is one end; a very long text is counted and scored
in one piece like others, its distinct strings travelling once; held-out
documents never train; with no training documents every probability is uniform;
strings and words that tie in number are of equal weight; ids that repeat give
one row each; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm import dealing
from dialoom.llm.session import partitions
from dialoom.llm.text import LOWER, WORD, blocks, flat, mix, spans, word_hashes

#: Bytes of context; strings of one more fit an integer.
DEPTH = 5
STOP = 0xFF
LOG2 = np.log(2.0)
HELD_OUT = 10
#: The key of the row of totals among the sums.
TOTALS = -1
U64 = np.uint64
#: Names of words are hashes; the end of a text is a word of its own.
END_WORD = U64(0x6A09E667F3BCC909)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series after a shift of eight."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        shift += np.log(y)
        y += 1
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - 2 * 0.5723649429247001


def halves(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    return np.logaddexp(own, below) - LOG2


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of DEPTH + 1 bytes as integers, the coded byte lowest, of every document with its end; and each document's first (documents + 1).

    Before a document stand ends, so that beginnings share a context.
    """
    n, docs = len(data), len(offsets) - 1
    size = np.diff(offsets)
    room = size + DEPTH + 1
    begin = np.append(0, np.cumsum(room))
    text = np.full(begin[-1], STOP, np.uint8)
    text[np.repeat(begin[:-1] + DEPTH - offsets[:-1], size) + np.arange(n)] = LOWER[data]
    code = np.zeros(len(text), np.uint64)
    for k in range(DEPTH + 1):
        code[k:] |= text[: len(text) - k].astype(np.uint64) << U64(8 * k)
    keep = np.ones(len(text), bool)
    keep[(begin[:-1, None] + np.arange(DEPTH)).ravel()] = False
    return code[keep], offsets + np.arange(docs + 1)


def training(ids: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(str(i.as_py() if i.is_valid else "").encode()) % HELD_OUT != 0 for i in ids], bool)


class Nodes:
    """Counts of binary decisions by (context, bits before), and weighted log-probabilities from the deepest contexts up."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        """``codes``: distinct strings in order; ``counts``: of each in training."""
        seen = counts > 0
        codes, counts = codes[seen], counts[seen].astype(np.float64)
        self.keys, self.zeros, self.ones, self.weighted, self.mine = {}, {}, {}, {}, {}
        byte = codes & U64(255)
        context = codes >> U64(8)
        below_key = below = None
        for depth in range(DEPTH, -1, -1):
            own = context & U64((1 << 8 * depth) - 1)
            keys, zeros, ones = [], [], []
            for bit in range(8):
                node = (U64(1) << U64(bit)) | (byte >> U64(8 - bit))
                key = own << U64(8) | node
                one = (byte >> U64(7 - bit) & U64(1)).astype(bool)
                keys.append(key)
                zeros.append(np.where(one, 0, counts))
                ones.append(np.where(one, counts, 0))
            key, place = np.unique(np.concatenate(keys), return_inverse=True)
            z = np.bincount(place, np.concatenate(zeros), len(key))
            o = np.bincount(place, np.concatenate(ones), len(key))
            mine = log_kt(z, o)
            if below is None:
                weighted = mine
            else:
                parent = (below_key >> U64(8) & U64((1 << 8 * depth) - 1)) << U64(8) | below_key & U64(255)
                product = np.bincount(np.searchsorted(key, parent), below, len(key))
                weighted = halves(mine, product)
            self.keys[depth], self.zeros[depth], self.ones[depth], self.mine[depth], self.weighted[depth] = key, z, o, mine, weighted
            below_key, below = key, weighted

    def above(self) -> tuple[np.ndarray, ...]:
        """For nodes of depth 1: keys, counts, and the product of what lies below them here."""
        key = self.keys[2]
        parent, place = np.unique((key >> U64(8) & U64(0xFF)) << U64(8) | key & U64(255), return_inverse=True)
        return parent, *(np.bincount(place, x, len(parent)) for x in (self.zeros[2], self.ones[2], self.weighted[2]))


class Top:
    """The nodes of depth 0 and 1, from the corpus's sums for those of depth 1."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, product: np.ndarray):
        order = np.argsort(keys)
        key, z, o, product = keys[order], zeros[order], ones[order], product[order]
        mine = log_kt(z, o)
        weighted = halves(mine, product)
        self.own = {1: (key, z, o, mine, weighted)}
        root, place = np.unique(key & U64(255), return_inverse=True)
        z, o = np.bincount(place, z, len(root)), np.bincount(place, o, len(root))
        mine = log_kt(z, o)
        self.own[0] = (root, z, o, mine, halves(mine, np.bincount(place, weighted, len(root))))


def log_probabilities(codes: np.ndarray, nodes: Nodes, top: Top) -> np.ndarray:
    """Natural log of each string's last byte after the bytes before it."""
    byte, context = codes & U64(255), codes >> U64(8)
    out = np.zeros(len(codes))
    for bit in range(8):
        node = (U64(1) << U64(bit)) | (byte >> U64(8 - bit))
        one = (byte >> U64(7 - bit) & U64(1)).astype(bool)
        # from the root down, how much weight is left for deeper nodes, and what shallower ones gave
        given, left = np.zeros(len(codes)), np.ones(len(codes))
        for depth in range(DEPTH + 1):
            key = (context & U64((1 << 8 * depth) - 1)) << U64(8) | node
            if depth < 2:
                keys, z, o, mine, weighted = top.own[depth]
            else:
                keys, z, o, mine, weighted = nodes.keys[depth], nodes.zeros[depth], nodes.ones[depth], nodes.mine[depth], nodes.weighted[depth]
            if len(keys):
                near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                known = keys[near] == key
                z, o = np.where(known, z[near], 0.0), np.where(known, o[near], 0.0)
                # an unknown node knows nothing: all its weight is its own, at one half
                part = np.where(known, np.exp(np.minimum(mine[near] - LOG2 - weighted[near], 0.0)), 0.5)
            else:
                z = o = np.zeros(len(codes))
                part = np.full(len(codes), 0.5)
            if depth == DEPTH:
                part = np.ones(len(codes))
            given += left * part * (np.where(one, o, z) + 0.5) / (z + o + 1.0)
            left = left * (1 - part)
        out += np.log(given)
    return out


def counted(values: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and of each the number in training."""
    order = np.argsort(values)
    values, train = values[order], train[order]
    if not len(values):
        return values, np.zeros(0, np.int64)
    edge = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[edge], np.add.reduceat(train.astype(np.int64), edge)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in parts]).astype(np.float64), len(keys)).astype(np.int64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of each document's words and its end, and each document's first (documents + 1)."""
    data = LOWER[data]
    starts, ends, first = spans(data, offsets, WORD)
    n = len(first) - 1
    out = np.full(len(starts) + n, END_WORD)
    out[np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(first))] = word_hashes(data, starts, ends)
    return out, first + np.arange(n + 1)


def bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    """By the two bytes before the coded one."""
    return (mix(codes >> U64(8) & U64(0xFFFF)) % U64(buckets)).astype(np.int64)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    dealt, buckets = dealing.deal(docs, id_col, text_col)

    def distinct_of(table: pa.Table) -> tuple:
        raw, _, texts = dealing.chunk_of(table)
        data, offsets = flat(texts)
        train = training(raw)
        codes, tokens = [], []
        for lo, hi in blocks(offsets, 2 << 20):
            own, piece = offsets[lo : hi + 1] - offsets[lo], data[offsets[lo] : offsets[hi]]
            for make, out in ((grams, codes), (words, tokens)):
                value, first = make(piece, own)
                out.append(counted(value, np.repeat(train[lo:hi], np.diff(first))))
        return merged(codes), merged(tokens)

    def by_buckets(codes: np.ndarray, tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The buckets that a chunk has anything for, with its strings and its words there."""
        bucket, of = bucket_of(codes, buckets), (tokens % U64(buckets)).astype(np.int64)
        order, other = np.argsort(bucket, kind="stable"), np.argsort(of, kind="stable")
        bucket, of = bucket[order], of[other]
        for b in np.union1d(bucket, of).tolist():
            yield b, order[np.searchsorted(bucket, b) : np.searchsorted(bucket, b, "right")], other[np.searchsorted(of, b) : np.searchsorted(of, b, "right")]

    def ask(table: pa.Table, _: list) -> dealing.Sent:
        (codes, n), (tokens, m) = distinct_of(table)
        for b, own, mine in by_buckets(codes, tokens):
            yield b, dealing.squeezed(dealing.steps(codes[own]), n[own].astype(np.uint32), dealing.steps(tokens[mine]), m[mine].astype(np.uint32), np.array([b]))

    def opened(blobs: list) -> list:
        parts = [dealing.unsqueezed(x, np.uint64, np.uint32, np.uint64, np.uint32, np.int64) for x in blobs]
        return [[np.cumsum(p[0]), p[1], np.cumsum(p[2]), *p[3:]] for p in parts]

    def summary(table: pa.Table) -> pa.Table:
        parts = opened(list(table.column("blob")))
        keys, *sums = Nodes(*merged([(p[0], p[1]) for p in parts])).above()
        tokens, n = merged([(p[2], p[3]) for p in parts])
        rows = [np.append(keys.astype(np.int64), TOTALS), *(np.append(x, 0.0) for x in sums), np.append(np.zeros(len(keys), np.int64), n.sum()), np.append(np.zeros(len(keys), np.int64), (n > 0).sum())]
        return pa.table({c: pa.array(x) for c, x in zip(("key", "zeros", "ones", "product", "tokens", "kinds"), rows, strict=True)})

    def answer(questions: pa.Table, above: pa.Table) -> pa.Table:
        if not questions.num_rows:
            return pa.table({"chunk": pa.array([], pa.int32()), "blob": pa.array([], pa.binary())})
        rows = {c: np.array([r[c] for r in above.column("top")[0].as_py()]) for c in ("key", "zeros", "ones", "product", "tokens", "kinds")}
        node = rows["key"] != TOTALS
        top = Top(rows["key"][node].astype(np.uint64), *(rows[c][node] for c in ("zeros", "ones", "product")))
        totals = np.array([rows["tokens"].sum(), rows["kinds"].sum()], np.int64)
        own = opened(list(questions.column("blob")))
        codes, n = merged([(p[0], p[1]) for p in own])
        logs = log_probabilities(codes, Nodes(codes, n), top)
        tokens, m = merged([(p[2], p[3]) for p in own])
        # in the order of the question, which the chunk finds again
        out = [dealing.squeezed(logs[np.searchsorted(codes, p[0])].astype(np.float32), m[np.searchsorted(tokens, p[2])].astype(np.uint32), p[4], totals) for p in own]
        return pa.table({"chunk": questions.column("chunk"), "blob": pa.array(out, pa.binary())})

    def result(table: pa.Table, answers: list) -> pa.Table:
        raw, _, texts = dealing.chunk_of(table)
        data, offsets = flat(texts)
        (codes, _), (tokens, _) = distinct_of(table)
        where = {b: (own, mine) for b, own, mine in by_buckets(codes, tokens)}
        logs, seen, total, kinds = np.zeros(len(codes)), np.zeros(len(tokens)), 0, 0
        for x in answers:
            own_logs, own_seen, (b,), (total, kinds) = dealing.unsqueezed(x, np.float32, np.uint32, np.int64, np.int64)
            logs[where[int(b)][0]] = own_logs
            seen[where[int(b)][1]] = own_seen
        base_of = np.log10((seen + 0.1) / (total + 0.1 * (kinds + 1)))
        out: list[list] = [[], [], [], []]
        for lo, hi in blocks(offsets, 2 << 20):
            own, piece = offsets[lo : hi + 1] - offsets[lo], data[offsets[lo] : offsets[hi]]
            value, first = grams(piece, own)
            distinct, place = np.unique(value, return_inverse=True)
            out[0].append(np.add.reduceat(logs[np.searchsorted(codes, distinct)][place], first[:-1]) / np.log(10))
            value, first = words(piece, own)
            at = np.searchsorted(tokens, value)
            out[1].append(np.add.reduceat(base_of[at], first[:-1]))
            out[2].append(np.add.reduceat((seen[at] > 0).astype(np.int64), first[:-1]))
            out[3].append(np.diff(first))
        of, base, known, n = (np.concatenate(x) if x else np.zeros(0) for x in out)
        return pa.table({
            "id": raw, "held_out": pa.array(~training(raw)), "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array(np.full(len(n), total), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(of, pa.float64()),
        })

    # one exchange of questions, which both the sums and the answers read
    sent = dealing.send(dealt, None, ask).repartition(partitions(docs.sparkSession), "bucket")
    columns = ("zeros", "ones", "product", "tokens", "kinds")
    sums = sent.groupBy("bucket").applyInArrow(summary, "key long, zeros double, ones double, product double, tokens long, kinds long").groupBy("key").agg(*[F.sum(c).alias(c) for c in columns])
    # at most 256 * 255 nodes and the totals, whatever the corpus
    top = sums.agg(F.collect_list(F.struct("key", *columns)).alias("top"))
    tops = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), top.scalar().alias("top"))
    answers = sent.groupBy("bucket").cogroup(tops.groupBy("bucket")).applyInArrow(answer, "chunk int, blob binary")
    out = dealing.finish(dealt, answers, result, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
