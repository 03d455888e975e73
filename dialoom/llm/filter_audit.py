"""How filters interact: every order of five filters replayed on every document.

Each document gets one flag for each filter (true where the document fails it).
Its flags are crossed with the 120 orders of the filters, a broadcast table of
that fixed size; the five steps of an order are exploded, the first failure in
the order is found, and counts are summed under conditions.  Sums are combined
before the shuffle, so what travels is parts x 600 rows a task, however hot a
part is.

Filters (``flags``), over words that are runs of ``[^\\x20\\x09-\\x0D]``:
A under 100 words; B under 80 distinct words in 100; C over 10 capitals A-Z in
100 code points; D a symbol of ``[#$%&*|]``; E the text is that of a smaller id
anywhere in the table.

For E the smallest id of each text is found under the SHA-256 of the text: least
ids of (text, salt) are combined to least ids of texts and joined back under
(text, salt), so a text that a third of all rows hold meets them in ``SALTS``
places.

Cases: a null text is an empty one, so it fails A, and E if a smaller id has an
empty or null text; a null id is neither smaller nor larger than any; rows that
repeat an id and a text do not fail E for each other; a null part is the part
''; a document without labels, or with null ones, is neither good nor toxic, and
of several label rows one that says so is enough; texts of any length are
counted whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FILTERS = ("A", "B", "C", "D", "E")
SPACES = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SALTS = 64


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id``, ``part`` and a boolean for each of FILTERS, true where the document fails it."""
    said = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("words", _words(F.col("text")))
    n, size = F.size("words").cast("long"), F.length("text").cast("long")
    tested = said.select(
        "id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"),
        (n < 100).alias("A"), (100 * F.size(F.array_distinct("words")) < 80 * n).alias("B"),
        (100 * (size - F.length(F.translate("text", CAPITALS, ""))) > 10 * size).alias("C"), F.col("text").rlike("[#$%&*|]").alias("D"),
    )
    spread = tested.groupBy("digest", "salt").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    first = spread.groupBy("digest").agg(F.min("least").alias("least"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).filter("n > 1")
    found = tested.join(first.select("digest", "least", F.explode("salts").alias("salt")), ["digest", "salt"], "left")
    return found.select("id", "part", "A", "B", "C", "D", F.coalesce(F.col("id") > F.col("least"), F.lit(False)).alias("E"))


def labelled(flagged: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``flagged`` with booleans ``good`` and ``toxic`` from the labels of its ids."""
    says = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_of")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    # rows without an id match nothing; they are dealt out by their flags' hash, and not all to one task
    loose = flagged.columns
    salt = F.when(F.col("id").isNull(), F.monotonically_increasing_id()).otherwise(-1)
    joined = flagged.withColumn("apart", salt).join(says.withColumn("same", F.lit(-1).cast("long")), (F.col("id") == F.col("label_of")) & (F.col("apart") == F.col("same")), "left")
    return joined.select(*loose, F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def audit(flagged: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """Counts for each part, order of ``filters`` and step.

    ``flagged`` has ``part``, booleans ``good`` and ``toxic``, and one boolean for
    each filter; filters' names are single letters, at most six of them.
    """
    if len(filters) > 6 or any(len(f) != 1 for f in filters):
        raise ValueError("at most six filters, named by single letters")
    bit = {f: 1 << k for k, f in enumerate(filters)}
    orders = flagged.sparkSession.createDataFrame([("".join(p), [bit[f] for f in p]) for p in permutations(filters)], "filter_order string, bits array<int>")
    mask = reduce(lambda a, b: a + b, [F.when(F.col(f), bit[f]).otherwise(0) for f in filters])
    crossed = flagged.select("part", "good", "toxic", mask.alias("mask")).crossJoin(F.broadcast(orders))
    first = F.lit(len(filters) + 1)
    for k in reversed(range(len(filters))):
        first = F.when(F.col("mask").bitwiseAND(F.get("bits", F.lit(k))) != 0, k + 1).otherwise(first)
    steps = crossed.select("part", "good", "toxic", "mask", "filter_order", first.alias("first"), F.posexplode("bits").alias("pos", "bit")).withColumn("step", F.col("pos") + 1)
    here = F.col("first") == F.col("step")
    counted = steps.groupBy("part", "filter_order", "step").agg(
        F.count_if(F.col("first") > F.col("step")).alias("kept"), F.count_if(here).alias("removed"),
        F.count_if((F.col("mask").bitwiseAND(F.col("bit")) != 0) & (F.col("first") < F.col("step"))).alias("redundant"),
        F.count_if(F.col("mask") == F.col("bit")).alias("unique_fails"),
        F.count_if(here & F.col("good")).alias("good_lost"), F.count_if(here & F.col("toxic")).alias("toxic_lost"),
    )
    return counted.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", F.expr("substring(filter_order, step, 1)"))))
