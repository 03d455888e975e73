"""MinHash near-duplicates by an inverted join of signature coordinates.

A document's signature is the least of its shingles' hashes under each of
``COORDINATES`` functions.  Each coordinate with its value is a term; two
documents of similarity 0.75 agree in 48 of 64 terms on average, and in
``AGREE`` or more but for 4.4 cases in 100,000.  Documents that agree in
so many share one of the ``COORDINATES - AGREE + 1`` terms that either of them
has rarest, so only those are posted (the prefix), and terms that no other
document has are skipped.  In each term's list collisions are counted over the
signatures' coordinates, and pairs of ``AGREE`` or more are confirmed on full
shingle sets.

Equal sets are one class from the start.  Confirmation runs twice: first over
the strongest pairs that join each list's documents into trees, then over all
pairs whose documents those links have not joined.  So a group of copies takes
about as many confirmations as it has documents, while no link between
different classes is passed over for being between documents of one component.
Lists of more than ``LONG`` documents are dealt to pairs of parts.

Cases: a null or empty text has no shingles and no links; rows that share an id
count as one document, linked if any of their texts are; a null id sorts before
all others; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from dialoom.llm import dealing
from dialoom.llm.components import components
from dialoom.llm.session import cut, positional
from dialoom.llm.text import LOWER, WORD, blocks, flat, mix, spans, windows, word_hashes

SHINGLE, COORDINATES, AGREE, LONG = 5, 64, 34, 2048
PREFIX = COORDINATES - AGREE + 1
#: Shingles that a group of documents under comparison may hold, were all documents compared.
GROUP_BYTES = 64 << 20
#: 8 MB of bits.
SIEVE_BITS = 1 << 26
U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(77))
TIMES = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * U64(2) + U64(1)
PLUS = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of each (wanted) document."""
    for lo, hi in blocks(offsets):
        if wanted is not None and not wanted[lo:hi].any():
            continue
        piece, own = LOWER[data[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, first = spans(piece, own, WORD)
        hashes = word_hashes(piece, starts, ends)
        grams = windows(hashes, SHINGLE)
        for k in range(hi - lo):
            if wanted is not None and not wanted[lo + k]:
                continue
            a, b = first[k], first[k + 1]
            if b - a >= SHINGLE:
                yield lo + k, np.unique(grams[a : b - SHINGLE + 1])
            elif b > a:
                yield lo + k, windows(hashes[a:b], int(b - a)) ^ U64(b - a)
            else:
                yield lo + k, np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    step = max(1, (1 << 20) // COORDINATES)
    parts = [((shingles[lo : lo + step, None] ^ PLUS) * TIMES).min(0) for lo in range(0, len(shingles), step)]
    return (np.minimum.reduce(parts) >> U64(32)).astype(np.uint32)


def terms_of(signatures: np.ndarray) -> np.ndarray:
    return mix(signatures.astype(np.uint64) | np.arange(COORDINATES, dtype=np.uint64) << U64(32))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, one, two, sigs = [], [], [], []
        for _, s in shingle_sets(*flat(batch.column(2))):
            n.append(len(s))
            one.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
            two.append(int(mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
            sigs.append(signature(s).tobytes() if len(s) else None)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sigs, pa.binary())], ["chunk", "id", "n", "one", "two", "sig"])


def _term_counts(table: pa.Table, _: list, buckets: int) -> dealing.Sent:
    terms = terms_of(_signatures(table)).ravel()
    distinct, n = np.unique(terms, return_counts=True)
    order, present, cuts = dealing.by_bucket(distinct, buckets)
    for b, lo, hi in zip(present, cuts, cuts[1:], strict=False):
        own = order[lo:hi]
        yield b, dealing.pack(distinct[own], n[own].astype(np.uint32))


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in table.column("sig")), np.uint32).reshape(-1, COORDINATES)


def _common_terms(blobs: list) -> Iterator[bytes | None]:
    """To each chunk: its terms that two documents or more have, and how many have them."""
    parts = [dealing.unpack(x, np.uint64, np.uint32) for x in blobs]
    terms, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)
    for own, _ in parts:
        n = total[np.searchsorted(terms, own)]
        yield dealing.pack(own[n > 1], n[n > 1]) if (n > 1).any() else None


def _postings(table: pa.Table, answers: list, buckets: int) -> dealing.Sent:
    """Each document under its prefix's terms that others have too."""
    if not answers:
        return
    got = [dealing.unpack(x, np.uint64, np.int64) for x in answers]
    known, often = np.concatenate([p[0] for p in got]), np.concatenate([p[1] for p in got])
    order = np.argsort(known)
    known, often = known[order], often[order]
    sigs = _signatures(table)
    terms = terms_of(sigs)
    near = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    count = np.where(known[near] == terms, often[near], 1)
    rank = np.lexsort((terms, count), axis=1)[:, :PREFIX]
    rows = np.repeat(np.arange(len(terms)), rank.shape[1])
    picked = terms[rows, rank.ravel()]
    n = count[rows, rank.ravel()]
    keep = n > 1
    rows, picked, n = rows[keep], picked[keep], n[keep]
    ids = table.column("id").combine_chunks().fill_null(dealing.NO_ID).to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0, np.int64)
    joined = table.column("component").combine_chunks().fill_null(dealing.NO_ID).to_numpy(zero_copy_only=False)
    sizes = table.column("n").combine_chunks().to_numpy()
    # long lists go in parts, and each pair of parts is a list
    parts = -(-n // LONG)
    part = (mix(ids[rows].astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
    copies = np.repeat(np.arange(len(rows)), parts)
    other = np.arange(len(copies)) - np.repeat(np.cumsum(parts) - parts, parts)
    low, high = np.minimum(part[copies], other), np.maximum(part[copies], other)
    lists = np.where(parts[copies] > 1, mix(picked[copies] + mix((low << 32 | high).astype(np.uint64))), picked[copies])
    rows = rows[copies]
    order, present, cuts = dealing.by_bucket(lists, buckets)
    small = sigs.astype(np.uint16)  # of equal coordinates these are equal too
    chunk = table.column("chunk")[0].as_py()
    for b, lo, hi in zip(present, cuts, cuts[1:], strict=False):
        own = order[lo:hi]
        # a document's signature once for each bucket
        docs, place = np.unique(rows[own], return_inverse=True)
        yield b, dealing.pack(lists[own], place.astype(np.uint32), ids[docs], joined[docs], sizes[docs], small[docs], np.array([chunk]))


def _pairs(lists: np.ndarray, docs: np.ndarray, ids: np.ndarray, joined: np.ndarray, sizes: np.ndarray, sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of documents that share a list and agree in AGREE terms, of different components and sizes that allow it."""
    order = np.argsort(lists, kind="stable")
    lists, docs = lists[order], docs[order]
    begin = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
    size = np.diff(np.append(begin, len(lists)))
    found: list[np.ndarray] = []
    agreed: list[np.ndarray] = []

    def test(a: np.ndarray, b: np.ndarray) -> None:
        near = (joined[a] != joined[b]) & (ids[a] != ids[b]) & (4 * np.minimum(sizes[a], sizes[b]) >= 3 * np.maximum(sizes[a], sizes[b]))
        a, b = a[near], b[near]
        for lo in range(0, len(a), 1 << 16):
            x, y = a[lo : lo + (1 << 16)], b[lo : lo + (1 << 16)]
            same = (sigs[x] == sigs[y]).sum(1, dtype=np.int32)
            hit = same >= AGREE
            x, y = x[hit], y[hit]
            found.append(np.minimum(x, y) * len(ids) + np.maximum(x, y))
            agreed.append(same[hit])

    for n in np.unique(size[size > 1]).tolist():
        of = begin[size == n]
        if n <= 64:
            i, j = np.triu_indices(n, 1)
            step = max(1, (1 << 19) // len(i))
            for lo in range(0, len(of), step):
                own = docs[of[lo : lo + step, None] + np.arange(n)]
                test(own[:, i].ravel(), own[:, j].ravel())
        else:
            for start in of.tolist():
                own = docs[start : start + n]
                step = max(1, (1 << 19) // n)
                for lo in range(0, n, step):
                    i = np.arange(lo, min(n, lo + step))
                    a, b = np.repeat(i, n), np.tile(np.arange(n), len(i))
                    later = b > a
                    test(own[a[later]], own[b[later]])
    if not found:
        return (np.zeros(0, np.int64),) * 3
    code, first = np.unique(np.concatenate(found), return_index=True)
    return code // len(ids), code % len(ids), np.concatenate(agreed)[first]


def forest(a: np.ndarray, b: np.ndarray, strength: np.ndarray, n: int) -> np.ndarray:
    """Edges of trees that join what the edges join, the strongest first; by Boruvka's rounds."""
    order = np.argsort(-strength, kind="stable")
    label, chosen = np.arange(n), []
    left = order
    while True:
        left = left[label[a[left]] != label[b[left]]]
        if not len(left):
            return np.unique(np.concatenate(chosen)) if chosen else left
        best = np.full(n, len(left))
        at = np.arange(len(left))
        np.minimum.at(best, label[a[left]], at)
        np.minimum.at(best, label[b[left]], at)
        picked = left[np.unique(best[best < len(left)])]
        chosen.append(picked)
        while True:  # labels of picked edges to the least of each tree
            x, y = label[a[picked]], label[b[picked]]
            low = np.minimum(x, y)
            to = np.arange(n)
            np.minimum.at(to, x, low)
            np.minimum.at(to, y, low)
            if (to == np.arange(n)).all():
                break
            label = to[label]


def _candidates(blobs: list, trees: bool) -> Iterator[bytes | None]:
    """To each chunk: pairs (own id, other id, other's chunk) to confirm."""
    parts = [dealing.unpack(x, np.uint64, np.uint32, np.int64, np.int64, np.int64, np.uint16, np.int64) for x in blobs]
    shift = np.append(0, np.cumsum([len(p[2]) for p in parts]))
    lists = np.concatenate([p[0] for p in parts])
    docs = np.concatenate([p[1].astype(np.int64) + s for p, s in zip(parts, shift, strict=False)])
    ids, joined, sizes = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4))
    sigs = np.concatenate([p[5].reshape(-1, COORDINATES) for p in parts])
    chunks = np.repeat([int(p[6][0]) for p in parts], np.diff(shift))
    a, b, strength = _pairs(lists, docs, ids, joined, sizes, sigs)
    if trees and len(a):
        keep = forest(a, b, strength, len(ids))
        a, b = a[keep], b[keep]
    # the document with more pairs travels, the other waits where it is filed
    degree = np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
    swap = degree[a] < degree[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    for k in range(len(parts)):
        own = np.flatnonzero((a >= shift[k]) & (a < shift[k + 1]))
        waits = np.unique(b[(b >= shift[k]) & (b < shift[k + 1])])
        yield dealing.pack(ids[a[own]], ids[b[own]], ids[waits]) if len(own) or len(waits) else None


def _with_pairs(table: pa.Table) -> pa.Table:
    """A chunk's own documents that its answers name."""
    got = [dealing.unpack(x, np.int64, np.int64, np.int64) for x in table.column("blob")]
    return pa.table({"id": pa.array(np.unique(np.concatenate([x for p in got for x in (p[0], p[2])])), pa.int64())})


def _sifted(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` whose id may be among ``ids``: a Bloom filter of ``SIEVE_BITS``, which bounds what is broadcast.

    What it lets through in error is not asked for later; as it fills, more rows pass.
    """
    at = F.pmod(F.xxhash64("id"), F.lit(SIEVE_BITS))
    word, bit = F.shiftright(at, 6), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {SIEVE_BITS}) % 64 as int))")
    words = ids.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    return rows.join(F.broadcast(words), word == F.col("__word")).filter(F.col("__bits").bitwiseAND(bit) != 0).select(*rows.columns)


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % U64(groups)).astype(np.int64)


def _travel(table: pa.Table, answers: list, groups: int) -> dealing.Sent:
    """The shingles of documents with pairs to the groups where they are compared, one blob for each group."""
    if not answers or not table.num_rows:
        return
    got = [dealing.unpack(x, np.int64, np.int64, np.int64) for x in answers]
    pairs = np.unique(np.stack([np.concatenate([p[k] for p in got]) for k in (0, 1)], 1), axis=0)
    waits = np.unique(np.concatenate([p[2] for p in got]))
    # what goes where: (group, id)
    a = np.unique(np.stack([group_of(pairs[:, 1], groups), pairs[:, 0]], 1), axis=0)
    stay = np.stack([group_of(waits, groups), waits], 1)
    goes = np.unique(np.concatenate([a, stay]), axis=0)
    _, ids, texts = dealing.chunk_of(table)
    sets: dict[int, list[np.ndarray]] = {}
    for k, s in shingle_sets(*flat(texts), np.isin(ids, goes[:, 1])):
        sets.setdefault(int(ids[k]), []).append(s)
    for group in np.unique(goes[:, 0]).tolist():
        own = [(i, s) for i in goes[goes[:, 0] == group, 1].tolist() for s in sets.get(i, ())]
        mine = pairs[group_of(pairs[:, 1], groups) == group]
        yield group, dealing.pack(np.array([i for i, _ in own], np.int64), np.array([len(s) for _, s in own], np.int64), np.concatenate([s for _, s in own]) if own else np.zeros(0, np.uint64), mine[:, 0], mine[:, 1])


def _confirm(table: pa.Table) -> pa.Table:
    """Pairs of a group whose full sets are as similar as asked."""
    sets: dict[int, list[np.ndarray]] = {}
    pairs: set[tuple[int, int]] = set()
    for blob in table.column("blob"):
        ids, sizes, hashes, a, b = dealing.unpack(blob, np.int64, np.int64, np.uint64, np.int64, np.int64)
        for i, s in zip(ids.tolist(), np.split(hashes, np.cumsum(sizes)[:-1]) if len(ids) else (), strict=True):
            sets.setdefault(i, []).append(s)
        pairs.update(zip(a.tolist(), b.tolist(), strict=True))
    linked = []
    for a, b in pairs:
        if any((both := int(dealing.found(x, y).sum())) and 100 * both >= 75 * (len(x) + len(y) - both) for x in sets.get(a, ()) for y in sets.get(b, ())):
            linked.append((a, b))
    return pa.table({"a": pa.array([a for a, _ in linked], pa.int64()), "b": pa.array([b for _, b in linked], pa.int64())})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (least linked id) and kept (whether it is that one)."""
    buckets = dealing.pieces(docs, text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(dealing.NO_ID))).alias("id"), F.col(text_col).alias("text"))
    chunk = F.pmod(F.xxhash64("id"), F.lit(dealing.CHUNKS * buckets)).cast("int")
    signed = cut(rows.select(chunk.alias("chunk"), "id", "text").mapInArrow(_sign, "chunk int, id long, n long, one long, two long, sig binary"))
    some, by = signed.filter("n > 0"), ["n", "one", "two"]
    classes = some.groupBy(*by).agg(F.min("id").alias("id"), F.min_by("chunk", "id").alias("chunk"), F.min_by("sig", "id").alias("sig"))
    classes = cut(classes.select("chunk", "id", *by, "sig"))
    members = some.select("id", *by).join(classes.select(F.col("id").alias("b"), *by), by).select(F.col("id").alias("a"), "b")
    groups = 1 + int(classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) * 8 // GROUP_BYTES
    counted = cut(dealing.settle(dealing.send(classes, None, lambda t, _: _term_counts(t, _, buckets)), _common_terms))

    def links(reps: DataFrame, trees: bool) -> DataFrame:
        posted = dealing.send(reps, counted, lambda t, a: _postings(t, a, buckets))
        pairs = cut(dealing.settle(posted, lambda blobs: _candidates(blobs, trees)))
        needed = _sifted(rows, pairs.groupBy("chunk").applyInArrow(_with_pairs, "id long"))
        travelled = dealing.send(dealing.deal(needed, "id", "text", by=("id",), n=buckets)[0], pairs, lambda t, a: _travel(t, a, groups))
        return travelled.groupBy("bucket").applyInArrow(_confirm, "a long, b long").distinct()

    strong = cut(links(classes.withColumn("component", F.col("id")), True).unionByName(members))
    joined = components(strong)
    reps = classes.join(joined, classes["id"] == joined["node"], "left").select(*classes.columns, F.coalesce("component", "id").alias("component"))
    joined = components(strong.unionByName(links(cut(reps), False)))
    least = F.coalesce("component", "id")
    return signed.join(joined, signed["id"] == joined["node"], "left").select(
        F.when(F.col("id") != int(dealing.NO_ID), F.col("id")).alias(id_col), F.col("n").alias("n_shingles"),
        F.when(least != int(dealing.NO_ID), least).alias("component_id"), (F.col("id") == least).alias("kept"),
    )


#: Numbers from here on stand for rows that have no number of their own.
NUMBERED = 1 << 62


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """``docs`` with ``node``, and whether some nodes are not ids.

    A node is the id where that is a whole number with one text, else a number of
    62 bits from id and text: the texts of a repeated or null id, and of ids of
    other types, are documents of their own.  Rows that repeat an id and a text
    have one node.
    """
    made = F.xxhash64(id_col, text_col).bitwiseAND(F.lit(NUMBERED - 1)) + F.lit(NUMBERED)
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        return docs.withColumn("node", made), True
    body = F.xxhash64(text_col)
    several = cut(docs.groupBy(F.col(id_col).alias("of")).agg(F.min(body).alias("least"), F.max(body).alias("most")).filter("of is null or least <> most").select("of"))
    if several.isEmpty():
        return docs.withColumn("node", F.col(id_col).cast("long")), False
    # null ids need no partner
    found = docs.join(several.filter("of is not null"), F.col(id_col) == F.col("of"), "left")
    return found.withColumn("node", F.when(F.col(id_col).isNull() | F.col("of").isNotNull(), made).otherwise(F.col(id_col).cast("long"))).drop("of"), True


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group with its columns, whatever these are called: the one of least id (null is the least), of one id's texts that of least hash."""
    rows, (own, text) = positional(docs, id_col, text_col)
    rows, apart = numbered(rows, own, text)
    found = near_duplicates(rows.select("node", text), "node", text)
    if apart:
        told = rows.select("node", F.col(own).alias("id"), F.xxhash64(text).alias("body")).distinct()
        groups = cut(found.select("node", "component_id").distinct().join(told, "node"))
        first = groups.groupBy("component_id").agg(F.min(F.struct("id", "body", "node")).alias("first")).select(F.col("first.node").alias("node"))
        gone = groups.join(first, "node", "left_anti").select(F.col("node").alias("gone"))
    else:
        gone = found.filter("not kept").select(F.col("node").alias("gone")).distinct()
    return rows.join(gone, F.col("node") == F.col("gone"), "left_anti").drop("node").toDF(*docs.columns)
