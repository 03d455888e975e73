"""Benchmark decontamination with a positional inverted index.

The index is built once, over all training tokens, and serves any query.  A
block of documents numbers its words through; its postings, for each term the
positions where it occurs, are dealt by term to ``buckets`` of terms, one packed
row for each block and bucket, so that a frequent term is split by blocks and a
bucket's size follows from the number of buckets.  One more row holds a block's
documents.  The rows are written as they are made; a search shuffles them once,
by bucket.

A query is a table of terms.  Test terms meet the index by bucket, and only
their postings go on.  Counted over all blocks they tell each window's rarest
term; windows go to the blocks that hold it, and there the rarest term's
postings, adjusted by the term's offset, are intersected with those of the next
rarest terms.  Exact phrases come back as word spans; proximity queries as the
documents that hold all terms within so many words.

Words: A-Z lower-cased, runs of ASCII letters and digits and of all bytes above
0x7F.  Windows: ``width`` consecutive words of an item, or all of its words if
it has fewer; items without words have no windows.  Equal windows of several
items travel once.

Cases: a null or empty text has no words and is clean; a very long text is a
block of its own; terms that tie in rarity are taken by their hash; repeated
document ids give one row each, repeated items and item ids count once; extra
columns are not read; with no items every document is clean, with no documents
there are no rows.  A null item id reads as ``null``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm import dealing
from dialoom.llm.session import cut, positional, store
from dialoom.llm.text import ALNUM, LOWER, blocks, flat, spans, word_hashes

WIDTH, BLOCK_BYTES = 10, 2 << 20
#: Bytes of text whose postings share a bucket, about, and the bucket of rows that hold a block's documents.
BUCKET_BYTES, DOCUMENTS = 64 << 20, -1
U64 = np.uint64


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each document's first word (documents + 1)."""
    data = LOWER[data]
    starts, ends, first = spans(data, offsets, ALNUM)
    return word_hashes(data, starts, ends), first


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all words: rows of ``bucket``, ``block``, ``buckets`` and ``blob``; for a block's documents also ``ids``.

    Blocks are numbered by partition, so ``docs`` should be read from files,
    which give the same partitions again.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for lo, hi in blocks(offsets, BLOCK_BYTES):
                own = offsets[lo : hi + 1]
                hashes, first = words_of(data[own[0] : own[-1]], own - own[0])
                rows = [(DOCUMENTS, dealing.squeezed(np.diff(first).astype(np.uint32)), batch.column(0).slice(lo, hi - lo).to_pylist())]
                bucket = (hashes % U64(buckets)).astype(np.int64)
                order = np.lexsort((hashes, bucket)) if buckets > 1 else np.argsort(hashes, kind="stable")
                hashes, at, bucket = hashes[order], order.astype(np.uint32), bucket[order]
                edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() if len(bucket) else []
                for a, b in zip(edge, [*edge[1:], len(bucket)], strict=False):
                    term = np.flatnonzero(np.append(True, hashes[a + 1 : b] != hashes[a : b - 1])) + a
                    count = np.diff(np.append(term, b))
                    # positions of a term rise: their differences are small
                    step = np.diff(at[a:b], prepend=np.uint32(0))
                    step[term - a] = at[term]
                    rows.append((int(bucket[a]), dealing.squeezed(dealing.steps(hashes[term]), count.astype(np.uint32), step), None))
                n = len(rows)
                yield pa.record_batch([
                    pa.array([b for b, _, _ in rows], pa.int32()), pa.array([number] * n, pa.int64()), pa.array([buckets] * n, pa.int32()),
                    pa.array([x for _, x, _ in rows], pa.binary()), pa.array([i for _, _, i in rows], pa.list_(batch.schema.field(0).type)),
                ], ["bucket", "block", "buckets", "blob", "ids"])
                number += 1

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"bucket int, block long, buckets int, blob binary, ids array<{kind}>")


def opened(blob: pa.BinaryScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, the bounds of their postings, and the postings."""
    steps, count, step = dealing.unsqueezed(blob, np.uint64, np.uint32, np.uint32)
    terms, bounds = np.cumsum(steps, dtype=np.uint64), np.append(0, np.cumsum(count.astype(np.int64)))
    every = np.cumsum(step.astype(np.int64))
    before = np.append(0, every)[bounds[:-1]]
    return terms, bounds, every - np.repeat(before, count)


def postings(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``block``, ``term``, ``n`` and ``at`` (packed positions) of the distinct ``terms`` (column term) that a block holds."""

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        want = np.sort(asked.column("term").combine_chunks().to_numpy().view(np.uint64)) if asked.num_rows else np.zeros(0, np.uint64)
        block, term, count, at = [], [], [], []
        for b, blob in zip(own.column("block").to_pylist() if len(want) else (), own.column("blob"), strict=False):
            terms, bounds, place = opened(blob)
            for k in np.flatnonzero(dealing.found(terms, want)).tolist():
                block.append(b)
                term.append(int(terms[k].view(np.int64)))
                count.append(int(bounds[k + 1] - bounds[k]))
                at.append(place[bounds[k] : bounds[k + 1]].astype(np.uint32).tobytes())
        return pa.table({"block": pa.array(block, pa.int64()), "term": pa.array(term, pa.int64()), "n": pa.array(count, pa.int64()), "at": pa.array(at, pa.binary())})

    # a bucket's blocks are dealt in parts, each of which gets the bucket's few test terms
    parts = 16
    kept = index.filter(F.col("bucket") != DOCUMENTS).select("bucket", "block", "blob", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"))
    buckets = F.coalesce(index.agg(F.max("buckets")).scalar(), F.lit(1))
    # the index deals terms by their unsigned hash
    bucket = F.expr("pmod(pmod(shiftrightunsigned(term, 1), m) * 2 + (term & 1), m)")
    asked = terms.select("term").distinct().withColumn("m", buckets.cast("long")).select(bucket.cast("int").alias("bucket"), "term", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    return kept.groupBy("bucket", "part").cogroup(asked.groupBy("bucket", "part")).applyInArrow(run, "block long, term long, n long, at binary")


def windows_of(items: DataFrame, width: int = WIDTH, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The distinct windows: ``terms`` and ``items``, the ids (as text) of the items that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = words_of(*flat(batch.column(1)))
            item, terms = [], []
            for k, name in enumerate(batch.column(0).to_pylist()):
                own = signed(hashes[first[k] : first[k + 1]])
                n = min(width, len(own))
                for at in range(len(own) - n + 1 if n else 0):
                    item.append(name)
                    terms.append(own[at : at + n])
            yield pa.record_batch([pa.array(item, pa.string()), pa.array(terms, pa.list_(pa.int64()))], ["item", "terms"])

    rows = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), F.col(text_col)).distinct()
    return rows.mapInArrow(run, "item string, terms array<bigint>").groupBy("terms").agg(F.collect_set("item").alias("items"))


class Block:
    """The postings of a block that a search reads."""

    def __init__(self, first: np.ndarray, terms: np.ndarray, lists: list[np.ndarray]):
        order = np.argsort(terms)
        self.first, self.terms = first, terms[order]
        lists = [lists[k] for k in order.tolist()]
        self.offsets = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64)
        self.postings = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
        #: (term number, position) of every posting, in order: one list to look up all terms' postings in
        self.keys = np.repeat(np.arange(len(self.terms)), np.diff(self.offsets)) << 32 | self.postings

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """Term numbers, or -1."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        want = term << 32 | position
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return (self.keys[at] == want) & (position >= 0)

    def phrases(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window number and first word of each occurrence, within one document."""
        terms, width = self.numbers(windows), windows.shape[1]
        of = np.flatnonzero((terms >= 0).all(1))
        if not len(of):
            return of, of
        terms = terms[of]
        sizes = self.offsets[terms + 1] - self.offsets[terms]
        order = np.argsort(sizes, 1, kind="stable")
        rows = np.arange(len(of))
        rarest = order[:, 0]
        count = sizes[rows, rarest]
        begin = self.offsets[terms[rows, rarest]]
        row = np.repeat(rows, count)
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = self.postings[np.repeat(begin, count) + place] - rarest[row]
        keep = start >= 0
        row, start = row[keep], start[keep]
        for k in range(1, width):
            if not len(row):
                break
            offset = order[row, k]
            keep = self.has(terms[row, offset], start + offset)
            row, start = row[keep], start[keep]
        keep = self.document(start) == self.document(start + width - 1)
        return of[row[keep]], start[keep]

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, "right") - 1

    def near(self, terms: np.ndarray, within: int) -> np.ndarray:
        """Documents that hold all of the terms in some ``within`` consecutive words."""
        numbers = np.unique(self.numbers(np.unique(terms)))
        if not len(numbers) or numbers[0] < 0:
            return np.zeros(0, np.int64)
        sizes = np.diff(self.offsets)[numbers]
        lists = [self.postings[self.offsets[n] : self.offsets[n + 1]] for n in numbers[np.argsort(sizes)]]
        # a window may begin at any of the terms; it must reach one of each list in the same document
        begin = np.unique(np.concatenate(lists))
        end = np.minimum(begin + within, self.first[self.document(begin) + 1]) if len(begin) else begin
        for own in lists:
            at = np.searchsorted(own, begin)
            good = (at < len(own)) & (own[np.minimum(at, len(own) - 1)] < end)
            begin, end = begin[good], end[good]
        return np.unique(self.document(begin))


def routed(found: DataFrame, queries: DataFrame) -> DataFrame:
    """``block`` and the queries (columns terms, names) that go there: those whose rarest term it holds, if every term occurs somewhere."""
    counts = found.groupBy("term").agg(F.sum("n").alias("n"))
    one = queries.withColumn("query", F.xxhash64("terms"))
    rarest = one.select("query", F.explode(F.array_distinct("terms")).alias("term")).join(counts, "term", "left").groupBy("query").agg(
        F.count_if(F.col("n").isNull()).alias("missing"), F.min(F.struct("n", "term")).alias("least")
    ).filter("missing = 0").select("query", F.col("least.term").alias("term"))
    return one.join(rarest, "query").join(found.select("block", "term"), "term").select("block", "terms", "names")


def _grouped(index: DataFrame, found: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """By block: its documents and the postings it holds; and the queries that go there."""
    kind = index.schema["ids"].dataType.simpleString()
    documents = index.filter(F.col("bucket") == DOCUMENTS).select("block", F.lit(None).cast("long").alias("term"), F.col("blob").alias("at"), "ids")
    return documents.unionByName(found.select("block", "term", "at", F.lit(None).cast(kind).alias("ids"))), routed(found, queries)


def _open(own: pa.Table) -> tuple[pa.Array, Block]:
    term, ids, first, terms, lists = own.column("term").to_pylist(), None, None, [], []
    for k, at in enumerate(own.column("at")):
        if term[k] is None:
            ids, first = own.column("ids")[k].values, np.append(0, np.cumsum(dealing.unsqueezed(at, np.uint32)[0].astype(np.int64)))
        else:
            terms.append(term[k])
            lists.append(np.frombuffer(at.as_buffer(), np.uint32))
    return ids, Block(first, np.array(terms, np.int64), lists)


def search_phrases(index: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per indexed document: id, n_words, ``spans`` (first word, end) hit, and the ``names`` of the windows that occur."""
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        ids, block = _open(own)
        n, total = len(ids), int(block.first[-1])
        cover, found = np.zeros(total + 1, np.int32), [set() for _ in range(n)]
        terms, names = asked.column("terms").to_pylist(), asked.column("names").to_pylist()
        for length in {len(t) for t in terms}:
            of = [k for k, t in enumerate(terms) if len(t) == length]
            which, start = block.phrases(np.array([terms[k] for k in of], np.int64))
            np.add.at(cover, start, 1)
            np.add.at(cover, start + length, -1)
            for d, w in zip(block.document(start).tolist(), which.tolist(), strict=True):
                found[d].update(names[of[w]])
        hit = np.zeros(total + 2, bool)
        hit[1:-1] = np.cumsum(cover[:-1]) > 0
        edge = np.zeros(total + 1, bool)
        edge[block.first] = True
        begin = np.flatnonzero(hit[1:-1] & (edge[:-1] | ~hit[:-2]))
        end = np.flatnonzero(hit[1:-1] & (edge[1:] | ~hit[2:])) + 1
        of = block.document(begin)
        shift = block.first[of]
        both = pa.StructArray.from_arrays([pa.array(begin - shift, pa.int64()), pa.array(end - shift, pa.int64())], ["start", "end"])
        cuts = pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32())
        return pa.table({"id": ids, "n_words": pa.array(np.diff(block.first), pa.int64()), "spans": pa.ListArray.from_arrays(cuts, both), "names": pa.array([sorted(x) for x in found], pa.list_(pa.string()))})

    found = cut(postings(index, windows.select(F.explode("terms").alias("term"))))
    own, asked = _grouped(index, found, windows.select("terms", F.col("items").alias("names")))
    return own.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(run, f"id {kind}, n_words long, spans array<struct<start:bigint,end:bigint>>, names array<string>")


def search_near(index: DataFrame, queries: DataFrame, within: int, query_col: str = "query", text_col: str = "text") -> DataFrame:
    """``query`` (as text) and ``id`` of each document that holds all words of the query's text within so many consecutive words."""
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = words_of(*flat(batch.column(1)))
            every = [np.unique(signed(hashes[first[k] : first[k + 1]])) for k in range(batch.num_rows)]
            yield pa.record_batch([batch.column(0), pa.array(every, pa.list_(pa.int64()))], ["name", "terms"])

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        ids, block = _open(own)
        name, where = [], []
        for terms, names in zip(asked.column("terms").to_pylist(), asked.column("names").to_pylist(), strict=True):
            for d in block.near(np.array(terms, np.int64), within).tolist():
                name += names
                where += [d] * len(names)
        return pa.table({"query": pa.array(name, pa.string()), "id": ids.take(pa.array(where, pa.int64()))})

    rows = queries.select(F.col(query_col).cast("string"), F.col(text_col)).mapInArrow(words, "name string, terms array<bigint>").filter(F.size("terms") > 0)
    asked = rows.groupBy("terms").agg(F.collect_set("name").alias("names"))
    found = cut(postings(index, asked.select(F.explode("terms").alias("term"))))
    own, sent = _grouped(index, found, asked)
    return own.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, f"query string, id {kind}")


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: id, ``body`` (hash of the text), n_words, n_hit, ``spans`` hit, ``items`` (sorted as strings)."""
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("body")).alias("key"), F.col(text_col).alias("text"))
    found = search_phrases(store(build_index(keyed, "key", "text"), "postings"), cut(windows_of(items, width, item_col, item_text)))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(F.col("id.id").alias(id_col), F.col("id.body").alias("body"), "n_words", n_hit.alias("n_hit"), "spans", F.sort_array("names").alias("items"))


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a hit, with their columns, whatever these are called."""
    rows, (own, text) = positional(docs, id_col, text_col)
    found = decontaminate(rows, items, width, own, text).filter("n_hit > 0").select(F.col(own).alias("id"), "body").distinct()
    return rows.join(found, F.col(own).eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("body")), "left_anti").toDF(*docs.columns)
