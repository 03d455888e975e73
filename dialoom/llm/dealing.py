"""Rounds between chunks of documents and buckets of hashes.

Documents are dealt once by a hash into chunks of about ``CHUNK_BYTES`` of text
or less, counted first, so that chunks do not grow with the corpus.  In a round
each chunk sends every bucket that it has anything for one packed array,
already combined, so that however often one value occurs, a bucket gets it once
from each chunk; the bucket settles the value over all chunks and answers each
chunk with one packed array.  There are half as many buckets as chunks.  The
dealt documents are the same exchange in every round, which Spark reuses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.session import partitions

#: Chunks for each bucket: more even partitions, smaller groups.
CHUNKS = 2
CHUNK_BYTES, LEAST_BYTES = 16 << 20, 1 << 20
NO_ID = np.iinfo(np.int64).min


def pieces(docs: DataFrame, text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> int:
    """The number of buckets, and half that of chunks: one for each partition if there is a MB for it, more as the bytes ask for."""
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    return max(1, min(partitions(docs.sparkSession), -(-total // LEAST_BYTES)), -(-total // (CHUNKS * chunk_bytes)))


def deal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("id", "text"), n: int | None = None) -> tuple[DataFrame, int]:
    """``chunk``, ``id`` (bigint) and ``text``, dealt by chunk, and the number of buckets; ``by``: what decides the chunk."""
    n = n or pieces(docs, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = rows.select(F.pmod(F.xxhash64(*by), F.lit(CHUNKS * n)).cast("int").alias("chunk"), "id", "text")
    return dealt.repartition(partitions(docs.sparkSession), "chunk"), n


def chunk_of(table: pa.Table) -> tuple[pa.Array, np.ndarray, pa.ChunkedArray]:
    """A chunk's ids as they are, as numbers, and its texts, by id and text, so that every round sees one order."""
    if table.num_rows:
        table = table.sort_by([("id", "ascending"), ("text", "ascending")])
    ids = table.column("id").combine_chunks()
    if isinstance(ids, pa.ChunkedArray):
        ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.array([], pa.int64())
    return ids, ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), table.column("text")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit lengths in one value."""
    return b"".join([np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes(), *(a.tobytes() for a in arrays)])


def unpack(blob: pa.BinaryScalar, *kinds: type | str) -> list[np.ndarray]:
    data = blob.as_buffer()
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(data, np.int64, n, 8), 8 + 8 * n, []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def squeezed(*arrays: np.ndarray) -> bytes:
    """As ``pack``, compressed; the bytes of each array's values lie by significance, so sorted values do best as differences."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T) for a in map(np.ascontiguousarray, arrays)]
    raw = pack(*planes)
    return np.array([len(raw)], np.int64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(blob: pa.BinaryScalar, *kinds: type | str) -> list[np.ndarray]:
    data = blob.as_buffer()
    raw = pa.decompress(data.slice(8), int(np.frombuffer(data, np.int64, 1)[0]), codec="zstd")
    out = unpack(pa.scalar(raw, pa.binary()) if isinstance(raw, bytes) else pa.scalar(raw.to_pybytes(), pa.binary()), *[np.uint8] * len(kinds))
    return [np.ascontiguousarray(x.reshape(np.dtype(k).itemsize, -1).T).view(k).ravel() for x, k in zip(out, kinds, strict=True)]


Sent = Iterator[tuple[int, bytes]]


def send(dealt: DataFrame, answers: DataFrame | None, emit: Callable[[pa.Table, list], Sent]) -> DataFrame:
    """What each chunk sends: ``emit`` gets its table and the answers of the round before, and yields (bucket, blob)."""
    schema = "bucket int, chunk int, blob binary"

    def table(chunk: int, sent: Sent) -> pa.Table:
        rows = list(sent)
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()), "chunk": pa.array([chunk] * len(rows), pa.int32()), "blob": pa.array([x for _, x in rows], pa.binary())})

    if answers is None:
        return dealt.groupBy("chunk").applyInArrow(lambda key, t: table(key[0].as_py(), emit(t, [])), schema)
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda key, t, a: table(key[0].as_py(), emit(t, list(a.column("blob"))) if t.num_rows else iter(())), schema
    )


def settle(sent: DataFrame, decide: Callable[[list], Iterator[bytes | None]]) -> DataFrame:
    """Answers (``chunk``, ``blob``): ``decide`` gets a bucket's blobs and yields an answer, or None, to each."""

    def run(table: pa.Table) -> pa.Table:
        chunks, blobs = table.column("chunk").to_pylist(), list(table.column("blob"))
        rows = [(c, x) for c, x in zip(chunks, decide(blobs), strict=True) if x is not None]
        return pa.table({"chunk": pa.array([c for c, _ in rows], pa.int32()), "blob": pa.array([x for _, x in rows], pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, "chunk int, blob binary")


def finish(dealt: DataFrame, answers: DataFrame | list[DataFrame], result: Callable[..., pa.Table], schema: str) -> DataFrame:
    """``result`` of each chunk's table and its answers, of one round or of several."""
    rounds = answers if isinstance(answers, list) else [answers]
    every = rounds[0].withColumn("round", F.lit(0))
    for k, one in enumerate(rounds[1:], 1):
        every = every.unionByName(one.withColumn("round", F.lit(k)))

    n = len(rounds)

    def run(table: pa.Table, got: pa.Table) -> pa.Table:
        of, blobs = got.column("round").to_pylist(), list(got.column("blob"))
        return result(table, *([x for r, x in zip(of, blobs, strict=True) if r == k] for k in range(n)))

    return dealt.groupBy("chunk").cogroup(every.groupBy("chunk")).applyInArrow(run, schema)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, list[int], list[int]]:
    """An order of the keys by bucket, then key; the buckets that there are, and their bounds in it (one more)."""
    order = np.argsort(keys, kind="stable")
    bucket = (keys[order] % np.uint64(buckets)).astype(np.int64)
    again = np.argsort(bucket, kind="stable")
    bucket = bucket[again]
    edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    return order[again], bucket[edge].tolist(), [*edge.tolist(), len(bucket)]


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of sorted values, the first from 0."""
    return np.diff(values, prepend=values.dtype.type(0))


def shared(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and whether each is of two documents or more."""
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if not len(edge):
        return keys, np.zeros(0, bool)
    return keys[edge], np.minimum.reduceat(docs, edge) != np.maximum.reduceat(docs, edge)


def send_names(names: np.ndarray, many: np.ndarray, buckets: int) -> Sent:
    """Distinct names, in order, and whether two documents here have each."""
    order, present, cuts = by_bucket(names, buckets)
    for b, lo, hi in zip(present, cuts, cuts[1:], strict=False):
        own = order[lo:hi]
        yield b, squeezed(steps(names[own]), np.packbits(many[own]), np.array([b]))


def shared_names(blobs: list) -> Iterator[bytes | None]:
    """To each chunk: which of its names another document has, in its chunk or elsewhere, a bit for each."""
    parts = [unsqueezed(x, np.uint64, np.uint8, np.int64) for x in blobs]
    parts = [(np.cumsum(own, dtype=np.uint64), np.unpackbits(many, count=len(own)) > 0, b) for own, many, b in parts]
    distinct, count = np.unique(np.concatenate([own for own, _, _ in parts]), return_counts=True)
    often = distinct[count > 1]
    for own, many, b in parts:
        hit = many | found(own, often)
        yield squeezed(np.packbits(hit), b) if hit.any() else None


def answered(names: np.ndarray, answers: list, buckets: int) -> np.ndarray:
    """Of the distinct names that were sent, those that the answers say are shared, in order."""
    order, present, cuts = by_bucket(names, buckets)
    where, out = {b: order[lo:hi] for b, lo, hi in zip(present, cuts, cuts[1:], strict=False)}, []
    for x in answers:
        bits, (b,) = unsqueezed(x, np.uint8, np.int64)
        own = where[int(b)]
        out.append(names[own[np.unpackbits(bits, count=len(own)) > 0]])
    return np.sort(np.concatenate(out)) if out else names[:0]


def found(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each key is in the sorted ``among``."""
    if not len(among):
        return np.zeros(len(keys), bool)
    return among[np.minimum(np.searchsorted(among, keys), len(among) - 1)] == keys
