"""Document fingerprints by consistent weighted sampling, and likeness of documents by them.

A document is its words (runs of ``[^\\x20\\x09-\\x0D]``) weighted by how often
they occur.  For sample k a word w has the gamma variates r and c, of shape 2,
and the uniform b, all from hashes of (w, k).  With weight S, t = floor(ln S / r
+ b) and a = c / exp(r (t - b + 1)); the word of least a is the sample, together
with its t.  Two documents agree in a sample with probability sum min(S, S') /
sum max(S, S'), the generalised Jaccard similarity, so the share of the samples
they agree in estimates it, with a standard error of at most 1 / (2
sqrt(samples)).  The least a itself stands for (word, t), of which it is a
function; a fingerprint holds 16 bits of each sample, so unequal samples look
equal once in 65,536.

``edit_audit`` fingerprints each text and an edited form of it: the last quarter
of its code points gives way to the first as many of the next document.  Words
that have the same weight in both forms are sampled once for both.

Documents are put in order by ids and hashes alone.  Texts are shuffled once;
each then sends its predecessor the quarter that it asks for, and all that
follows keeps that partitioning.  Work on a text stays in its row.

Cases: a null text is an empty one; texts without words have equal fingerprints
and likeness 1 to each other, 0 to others (but for chance); rows that repeat an
id and a text are one document in the order, and give a row each; documents that
repeat an id alone follow each other by a hash of their texts; null ids come
first; a document alone is its own next; very long texts are sampled whole; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.llm.session import cut, partitions

SAMPLES = 48
#: The 16 bits that stand for each sample of a text without words.
NO_WORDS = 0
SPACES = r"[\x20\x09-\x0D]+"
KEY = ["k1", "k2"]
#: Sides of a word: the same weight in both forms, or a weight of the text's or of the edited text's own.
BOTH, TEXT, EDITED = 0, 1, 2


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text``, and two hashes of both as a key that is never null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "id").alias("k2"))


def _links(documents: DataFrame) -> DataFrame:
    """For each document its key, its copies, a quarter of its size, and the key of the next."""
    spark = documents.sparkSession
    small = documents.groupBy(*KEY).agg(F.first("id").alias("id"), F.first(F.length("text")).alias("n_chars"), F.count("*").alias("copies"))
    ordered = cut(small.repartitionByRange(partitions(spark), "id", *KEY).withColumn("part", F.spark_partition_id()))
    # one number for each partition
    sizes = {r.part: r["count"] for r in ordered.groupBy("part").count().collect()}
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    start = F.get(F.lit(starts or [0]).cast("array<bigint>"), F.col("part"))
    ranked = ordered.select(*KEY, "copies", F.floor(F.col("n_chars") / 4).cast("int").alias("quarter"), (start + F.row_number().over(W.partitionBy("part").orderBy("id", *KEY)) - 1).alias("rank"))
    following = ranked.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.pmod(F.col("rank") - 1, F.lit(max(total, 1))).alias("rank"))
    return cut(ranked.join(following, "rank").drop("rank"))


def weighted_terms(forms: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``term`` (a hash of the word), ``n`` and ``side`` of each weight that a word has in ``text`` and ``edited``.

    ``forms`` is partitioned by ``by``, so counting needs no shuffle.
    """
    form = F.explode(F.array(F.struct("text", F.lit(1).alias("own")), F.struct(F.col("edited").alias("text"), F.lit(0).alias("own")))).alias("form")
    words = forms.select(*by, form).select(*by, "form.own", F.explode(F.split("form.text", SPACES)).alias("word")).filter("word <> ''")
    counts = words.select(*by, F.xxhash64("word").alias("term"), "own").groupBy(*by, "term").agg(F.sum("own").alias("t"), F.sum(1 - F.col("own")).alias("e"))
    weight = lambda c, side: F.struct(F.col(c).alias("n"), F.lit(side).alias("side"))
    weights = (
        F.when(F.col("t") == F.col("e"), F.array(weight("t", BOTH))).when(F.col("e") == 0, F.array(weight("t", TEXT)))
        .when(F.col("t") == 0, F.array(weight("e", EDITED))).otherwise(F.array(weight("t", TEXT), weight("e", EDITED)))
    )
    return counts.select(*by, "term", F.explode(weights).alias("w")).select(*by, "term", "w.n", "w.side")


def _least(k: int) -> Column:
    """ln a of the term for sample ``k``."""
    one, two, bits = F.xxhash64("term", F.lit(2 * k)), F.xxhash64("term", F.lit(2 * k + 1)), 25
    piece = lambda h, at: (F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << bits) - 1)) + 0.5) / float(1 << bits)
    r = -F.ln(piece(one, 0) * piece(one, bits))
    ln_c = F.ln(-F.ln(piece(two, 0) * piece(two, bits)))
    b = (F.shiftrightunsigned(one, 2 * bits) * 16384 + F.shiftrightunsigned(two, 2 * bits)) / float(1 << 28)
    return ln_c - r * (F.floor(F.col("ln_n") / r + b) - b + 1)


def signatures(terms: DataFrame, by: list[str], samples: int = SAMPLES) -> DataFrame:
    """``by``, ``fingerprint`` (of the text) and ``edited_fingerprint``: four digits for the least value of each sample."""
    weighed = terms.withColumn("ln_n", F.ln("n"))
    # ``least`` leaves nulls out, which stand for sides that a document lacks
    least = weighed.groupBy(*by, "side").agg(*[F.min(_least(k)).alias(f"m{k}") for k in range(samples)])
    sides = least.select(*by, F.struct("side", F.array(*[f"m{k}" for k in range(samples)]).alias("m")).alias("s")).groupBy(*by).agg(F.collect_list("s").alias("sides"))
    none = F.array_repeat(F.lit(None).cast("double"), samples)
    of = lambda side: F.coalesce(F.get(F.filter("sides", lambda s: s.side == side), F.lit(0)).m, none)
    found = sides.select(*by, of(BOTH).alias("both"), of(TEXT).alias("text"), of(EDITED).alias("edited"))
    digits = lambda m: F.lpad(F.hex(F.when(m.isNull(), F.lit(NO_WORDS)).otherwise(F.xxhash64(m)).bitwiseAND(F.lit(0xFFFF))), 4, "0")
    merged = lambda own: F.lower(F.array_join(F.zip_with("both", own, lambda a, b: digits(F.least(a, b))), ""))
    return found.select(*by, merged("text").alias("fingerprint"), merged("edited").alias("edited_fingerprint"))


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """The share of the samples of two fingerprints that agree."""
    at = lambda c, k: F.substring(c, 4 * k + 1, F.lit(4))
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: at(F.col(a), k) == at(F.col(b), k))) / F.lit(float(samples))


def edit_audit(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: fingerprints of text and edited text, likeness to the edited text and to the next document."""
    documents = _documents(docs, id_col, text_col)
    links = _links(documents)
    # id and text as one value: whatever is read of it later, all uses share one shuffle
    texts = documents.groupBy(*KEY).agg(F.first(F.struct("id", "text")).alias("doc"))
    asked = links.select(F.col("next1").alias("k1"), F.col("next2").alias("k2"), F.col("k1").alias("to1"), F.col("k2").alias("to2"), "quarter")
    heads = texts.join(asked, KEY).select(F.col("to1").alias("k1"), F.col("to2").alias("k2"), F.expr("substring(doc.text, 1, quarter)").alias("head"))
    joined = texts.join(links.select(*KEY, "quarter"), KEY).join(heads, KEY)
    forms = joined.select(*KEY, F.col("doc.id").alias("id"), F.col("doc.text").alias("text"), F.concat(F.expr("substring(doc.text, 1, length(doc.text) - quarter)"), "head").alias("edited"))
    told = forms.select(*KEY, "id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    none = F.lit(NO_WORDS.to_bytes(2, "big").hex() * samples)
    signed = told.join(signatures(weighted_terms(forms, KEY), KEY, samples), KEY, "left")
    signed = cut(signed.select(*[c for c in told.columns], *[F.coalesce(c, none).alias(c) for c in ("fingerprint", "edited_fingerprint")]))
    following = signed.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.col("fingerprint").alias("next_fingerprint"))
    met = links.select(*KEY, "next1", "next2", "copies").join(following, ["next1", "next2"]).select(*KEY, "copies", "next_fingerprint")
    return signed.join(met, KEY).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint", samples).alias("near_edited"), likeness("fingerprint", "next_fingerprint", samples).alias("near_next"),
    )
