"""Spelling variants: words one edit apart, grouped under the far commoner form.

One insertion, deletion or replacement leaves one half of a word intact.  The
dictionary is therefore listed twice, by its words forwards and by its words
reversed, so words that share the first half and words that share the second
lie together.  A block (m, lo, hi, rest) holds the words of m and of m + 1 code
points that agree everywhere but between lo and hi (hi + 1 for the longer);
the two lists are the blocks (m, m // 2, m) and (m, 0, m // 2).  Blocks of over
``LARGEST`` words are subdivided: halving lo..hi gives two blocks whose words
share more, until one position is left open, where a block has no more words
than the alphabet allows.  Blocks are dealt by range, scanned in order, and
each pair in one is verified on the open positions.  Of an insertion among
equal letters the last possible place counts, so every pair is met in exactly
one block and neighbours are summed without comparing lists of pairs.

Pairs never leave a task: each word sends, for each of its blocks, how many near
words it has there and the commonest.  Counting occurrences, sizes of blocks and
neighbours is combined before each shuffle; the words of large blocks meet the
blocks' sizes under (block, salt).  Chains of forms are followed by doubling,
since a form is ten times as common as its word.

Cases: a null text has no words; a null id counts as an empty string in the
hash; rows that repeat an id are counted each; a run of any length is a word;
forms that tie in number are told apart by code points; words without near
words have null ``form`` and are their own ``root``; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.session import cut, partitions

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run of a document in so many loses a letter, by its hash.
ONE_IN = 31
LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10
#: Words from which a block is subdivided, and keys that the words of one block meet its size under.
LARGEST, SALTS = 256, 16
#: Rows of a block compared with all of it at a time, so a task holds ROWS x block x open positions bytes.
ROWS = 64
#: Comes after every word of a block.
NONE = np.iinfo(np.int64).max
FOUND = "word string, n long, n_near long, form_n long, form string"


def dropped(run: Column, id_: Column) -> Column:
    """``run``, without one of its letters if its hash with the document's id says so."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(ONE_IN)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def dictionary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``, how often it occurs, for words long and frequent enough."""
    runs = F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(f"[{LETTERS}]{{{least_letters},}}"), F.lit(0))
    words = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run")).select(dropped(F.col("run"), F.col("id")).alias("word"))
    return words.filter(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _block(word: str, m: str, lo: str, hi: str) -> Column:
    """The key of the block (m, lo, hi) that ``word`` lies in: all but its open positions."""
    rest = f"concat(substring({word}, 1, {lo}), '\\n', substring({word}, length({word}) - ({m} - {hi}) + 1, {m} - {hi}))"
    return F.expr(f"concat_ws('\\n', {m}, {lo}, {hi}, {rest})")


def _listed(words: DataFrame) -> DataFrame:
    """The forward and the reversed list: each word under both halves, as the shorter and as the longer of a pair."""
    sides = words.withColumn("size", F.length("word")).withColumn("m", F.explode(F.expr("filter(array(size, size - 1), x -> x > 0)")))
    halves = F.explode(F.expr("filter(array(struct(m div 2 as lo, m as hi), struct(0 as lo, m div 2 as hi)), x -> x.hi > x.lo)"))
    return sides.withColumn("open", halves).selectExpr("word", "n", "m", "int(open.lo) lo", "int(open.hi) hi").withColumn("block", _block("word", "m", "lo", "hi"))


def _blocks(words: DataFrame, largest: int) -> DataFrame:
    """The lists, with blocks of over ``largest`` words subdivided."""
    now, settled = cut(_listed(words)), []
    while True:
        salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")
        big = now.filter("hi - lo > 1").groupBy("block").agg(F.count("*").alias("size")).filter(F.col("size") > largest).select("block", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        marked = cut(now.withColumn("salt", salt).join(big.withColumn("big", F.lit(True)), ["block", "salt"], "left").drop("salt"))
        settled.append(marked.filter("big is null").drop("big"))
        large = marked.filter("big")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, settled)
        halves = F.explode(F.expr("array(struct(lo as lo, (lo + hi) div 2 as hi), struct((lo + hi) div 2 as lo, hi as hi))"))
        now = large.withColumn("open", halves).selectExpr("word", "n", "m", "int(open.lo) lo", "int(open.hi) hi").withColumn("block", _block("word", "m", "lo", "hi"))


def _open(words: list[str], lo: int, width: int) -> np.ndarray:
    """The open code points of words of one length, a row for each."""
    text = "".join(w[lo : lo + width] for w in words)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(words), width)


def _prefer(near: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of each row's columns are near, and the least of their places in ``order`` (``NONE`` without any)."""
    return near.sum(1), np.where(near, order[None, :], NONE).min(1, initial=NONE)


def _verified(words: list[str], n: list[int], m: int, lo: int, hi: int) -> Iterator[tuple[str, int, int, int, str]]:
    """word, n, near words in this block, and the commonest of them with its number."""
    width, size = hi - lo, np.fromiter(map(len, words), np.int64, len(words))
    place = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    order = np.empty(len(words), np.int64)
    order[place] = np.arange(len(words))
    short, long = np.flatnonzero(size == m), np.flatnonzero(size > m)
    a = _open([words[i] for i in short], lo, width)
    b = _open([words[i] for i in long], lo, width + 1)
    count, best = np.zeros(len(words), np.int64), np.full(len(words), NONE, np.int64)

    def add(rows: np.ndarray, near: np.ndarray, columns: np.ndarray) -> None:
        k, first = _prefer(near, order[columns])
        count[rows] += k
        best[rows] = np.minimum(best[rows], first)

    for at in range(0, len(short), ROWS):
        some, rows = a[at : at + ROWS], short[at : at + ROWS]
        equal = some[:, None, :] == a[None, :, :]
        add(rows, equal.sum(2) == width - 1, short)
        if len(long):
            # equal letters from the left, and from the right one place further on in the longer word
            left = np.cumprod(some[:, None, :] == b[None, :, :-1], axis=2, dtype=np.int32).sum(2)
            right = np.cumprod((some[:, None, :] == b[None, :, 1:])[:, :, ::-1], axis=2, dtype=np.int32).sum(2)
            near = (left + right >= width) & ((left < width) | (hi == m))
            add(rows, near, long)
            add(long, near.T, rows)
    for i in np.flatnonzero(count):
        form = place[best[i]]
        yield words[i], n[i], int(count[i]), n[form], words[form]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a sorted partition, one after the other; a block may span batches."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
    block, words, n, out = None, [], [], []

    def done() -> None:
        if len(words) > 1:
            m, lo, hi = map(int, block.split("\n", 3)[:3])
            out.extend(_verified(words, n, m, lo, hi))

    def sent() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 5
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        keys, given, number = (batch.column(c).to_pylist() for c in ("block", "word", "n"))
        for k, w, c in zip(keys, given, number, strict=True):
            if k != block:
                done()
                block, words, n = k, [], []
            words.append(w)
            n.append(c)
        if len(out) >= 10_000:
            yield sent()
    done()
    yield sent()


def near_words(words: DataFrame, largest: int = LARGEST) -> DataFrame:
    """``word``, ``n``, ``n_near``, and the commonest near word with its number, for words that have one."""
    blocks = _blocks(words, largest)
    # a block of one word has no pair
    parts = partitions(words.sparkSession)
    scanned = blocks.select("block", "word", "n").repartitionByRange(parts, "block").sortWithinPartitions("block", "word").mapInArrow(_scan, FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return scanned.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")).selectExpr("word", "n", "n_near", "-best.less as form_n", "best.form as form")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least: int = LEAST_COUNT, times: int = TIMES, largest: int = LARGEST) -> DataFrame:
    """One row for each word: form, root, n, n_near, form_n."""
    words = cut(dictionary(docs, id_col, text_col, least_letters, least))
    near = cut(near_words(words, largest))
    forms = near.filter(F.col("form_n") >= times * F.col("n")).select("word", "form", "form_n")
    # n grows at least ``times``-fold at each step, so doubling ends after few rounds
    chain = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = chain.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = cut(chain.join(further, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        chain = step.drop("moved")
        if step.filter("moved").isEmpty():
            break
    return (
        words.join(near.select("word", "n_near"), "word", "left").join(forms, "word", "left").join(chain, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
