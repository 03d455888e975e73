"""Uniform shuffle into shards of exact size by a hypergeometric matrix.

Rows are dealt to source buckets by a hash.  Given the buckets' row counts and
the shards' sizes, the matrix of how many rows go from each bucket to each
shard is drawn from its exact law: what a uniform permutation of all rows
would give.  Rows are permuted within their bucket, cut there by the matrix'
row, exchanged, and permuted again within their shard.  Every permutation of
rows over (shard, slot) is equally likely, up to the quality of the hash.

Law ``rows``: shard sizes differ by one at most.  Equal rows may part; where
they lie is decided by their order alone, and any order of equal rows gives
the same result.

Cases: a null text has no bytes, so size 16 and crc32 0; an empty text likewise;
a very long text is a row like others, of which only size and crc32 travel; a
null id is an id like others; rows that tie in all that decides are equal, so
their order is no matter; an empty table gives no rows; clashing or extra
columns are not read.  The matrix has buckets x shards cells, neither of which
is rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.llm.session import partitions

#: Sub-buckets of a shard for the second permutation, for each shuffle partition.
FINE = 2
#: numpy's exact draw takes populations of less than so many.
NUMPY = 10**9
#: Standard deviations to either side of the mode beyond which the law has under 1e-60 of its weight.
REACH = 18


def inverted(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """A draw by inversion: weights from the mode outwards by the exact ratio of neighbours, so no factorials are needed."""
    total, lo, hi = good + bad, max(0, drawn - bad), min(good, drawn)
    if lo == hi:
        return lo
    mode = min(max((good + 1) * (drawn + 1) // (total + 2), lo), hi)
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / (total - 1))) ** 0.5
    reach = int(REACH * spread) + 200
    above, below = np.arange(mode, min(hi, mode + reach), dtype=np.float64), np.arange(mode, max(lo, mode - reach), -1, dtype=np.float64)
    up = np.cumprod((good - above) * (drawn - above) / ((above + 1) * (bad - drawn + above + 1)))
    down = np.cumprod(below * (bad - drawn + below) / ((good - below + 1) * (drawn - below + 1)))
    weights = np.cumsum(np.concatenate([down[::-1], [1.0], up]))
    return mode - len(down) + int(np.searchsorted(weights, rng.random() * weights[-1], "right"))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Successes in ``drawn`` draws without return from ``good`` + ``bad``, exactly, whatever their number."""
    return int(rng.hypergeometric(good, bad, drawn)) if good + bad < NUMPY else inverted(rng, good, bad, drawn)


def communication_matrix(rows: dict[int, int], sizes: list[int], seed: int) -> dict[int, list[int]]:
    """How many rows go from each bucket to each shard; both margins exact."""
    rng, left, out = np.random.Generator(np.random.PCG64(seed)), list(sizes), {}
    for bucket in sorted(rows):
        need, total, line = rows[bucket], sum(left), []
        for s in range(len(left)):
            total -= left[s]
            k = hypergeometric(rng, left[s], total, need)
            line.append(k)
            left[s] -= k
            need -= k
        out[bucket] = line
    return out


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 20240229, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard (null: the law is by rows)."""
    spark = docs.sparkSession
    buckets = 4 * partitions(spark)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text_col, "UTF-8")), F.lit(0)).cast("long").alias("crc"),
    ).withColumns({
        "bucket": F.pmod(F.xxhash64(F.lit(seed), "id", "size", "crc"), F.lit(buckets)).cast("int"),
        "h1": F.xxhash64(F.lit(seed + 1), "id", "size", "crc"),
        "h2": F.xxhash64(F.lit(seed + 2), "id", "size", "crc"),
    })
    # one small row for each bucket, of which there is a fixed number
    counts = {r[0]: r[1] for r in rows.groupBy("bucket").count().collect()}
    total = sum(counts.values())
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix(counts, sizes, seed)
    edges = []
    for bucket, line in matrix.items():
        at, cuts = 0, []
        for k in line:
            at += k
            cuts.append(at)
        edges.append((bucket, cuts))
    cuts = spark.createDataFrame(edges, "bucket int, cuts array<bigint>")
    place = F.row_number().over(W.partitionBy("bucket").orderBy("h1", "id", "crc", "size")) - 1
    # buckets x shards numbers: neither grows with the rows
    dealt = rows.withColumn("place", place).join(F.broadcast(cuts), "bucket").select(
        "id", "size", "crc", "h2", F.size(F.filter("cuts", lambda c: c <= F.col("place"))).alias("shard")
    )
    fine = FINE * partitions(spark)
    dealt = dealt.withColumn("fine", F.expr(f"cast(pmod(shiftrightunsigned(h2, 1), {fine}) as int)"))
    before = W.partitionBy("shard").orderBy("fine").rowsBetween(W.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "fine").count().select("shard", "fine", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inner = F.row_number().over(W.partitionBy("shard", "fine").orderBy("h2", "id", "crc", "size")) - 1
    return dealt.withColumn("inner", inner).join(starts, ["shard", "fine"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), (F.col("start") + F.col("inner")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
