"""Cross-site boilerplate lines by the spread of their sites.

A line's key is its text without white space at the ends; lines with nothing
else have no key and always stay.  A line spreads over the distinct sites
(here: sources) whose documents hold it.  HyperLogLog sketches of the sites are
merged for each line hash; lines whose estimate lies near the threshold get an
exact count of distinct sites, others keep the sketch's verdict.  A line that
spreads over ``min_sites`` or more is boilerplate and goes from every document
but the first (smallest id) that holds it, where it stays once.  With
``keep_copies`` a document whose set of lines spreads, as a whole, over
``min_sites`` sites keeps its lines: it is a copy, which near-duplicate removal
after this one is for, and which this one would leave empty.

Sketches are merged in partial aggregates, so a line that a third of all
documents holds is one sketch a task.  Lines are carried as a 64-bit hash and
length.

Cases: a null text has no lines and stays null; a null site counts as no site;
a very long text has its lines counted one by one like others; of documents
that tie for the first, by id, the one with the smaller hash of its text counts;
documents that repeat an id are told apart by that hash, and rows equal in both
share their fate; extra columns pass through unchanged; an empty table gives no
rows.  The lines' hashes are written once, to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.session import cut, positional

MIN_SITES = 10
#: Registers of a sketch, as a power of two, and the estimates that are settled exactly,
#: as parts of the threshold: over 20 standard errors (1.04 / 2**6) to either side.
LG_K, NEAR = 12, (0.5, 1.6)


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """id, site, position and key hash of each line with a key."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("body"), F.col(site_col).alias("site"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line")).select(
        "id", "body", "site", "pos", line_key(F.col("line")).alias("key")
    ).filter("key <> ''").select("id", "body", "site", "pos", F.xxhash64("key").alias("line"), F.length("key").alias("size"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Keys (hash and length) of ``lines`` that spread over ``min_sites`` sites, with the first document and position of each."""
    first = F.min(F.struct("id", "body", "pos")).alias("first")
    spread = lines.groupBy("line", "size").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"), first)
    spread = cut(spread.filter(F.col("sites") >= NEAR[0] * min_sites))
    sure, near = spread.filter(F.col("sites") > NEAR[1] * min_sites), spread.filter(F.col("sites") <= NEAR[1] * min_sites)
    exact = (
        lines.join(near.select("line", "size"), ["line", "size"], "left_semi")
        .filter("site is not null").groupBy("line", "size").agg(F.countDistinct("site").alias("exact")).filter(F.col("exact") >= min_sites)
    )
    return sure.select("line", "size", "first").unionByName(near.join(exact, ["line", "size"]).select("line", "size", "first"))


def _copies(lines: DataFrame, stock: DataFrame, min_sites: int) -> DataFrame:
    """``id`` and ``body`` of documents whose set of lines is on ``min_sites`` sites; no line of such a set is on fewer."""
    sets = (
        lines.join(stock.select("line", "size", F.lit(True).alias("wide")), ["line", "size"], "left").groupBy("id", "body")
        .agg(F.bool_and(F.coalesce("wide", F.lit(False))).alias("whole"), F.collect_set("site").alias("sites"), F.xxhash64(F.sort_array(F.collect_set(F.struct("line", "size")))).alias("set"))
        .filter("whole").drop("whole")
    )
    spread = sets.select("set", F.explode("sites").alias("site")).groupBy("set").agg(F.countDistinct("site").alias("n")).filter(F.col("n") >= min_sites)
    return sets.join(spread, "set", "left_semi").select("id", "body")


def _cut(docs: DataFrame, min_sites: int, id_col: str, text_col: str, site_col: str, keep_copies: bool) -> tuple[DataFrame, Column, Column, Column]:
    """``docs`` with the removed positions, the text left, the numbers of lines and of removed ones."""
    lines = cut(_lines(docs, id_col, text_col, site_col))
    stock = boilerplate(lines, min_sites)
    if keep_copies:
        stock = cut(stock)
    hit = ~F.struct("id", "body", "pos").eqNullSafe(F.col("first"))
    gone = lines.join(stock, ["line", "size"]).filter(hit).groupBy("id", "body").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    if keep_copies:
        copies = _copies(lines, stock, min_sites).select(F.col("id").alias("c"), F.col("body").alias("d"))
        gone = gone.join(copies, F.col("id").eqNullSafe(F.col("c")) & (F.col("body") == F.col("d")), "left_anti")
    gone = gone.select(F.col("id").alias("__id"), F.col("body").alias("__body"), F.col("gone").alias("__gone"))
    joined = docs.join(gone, docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__body")), "left")
    parts, none = F.split(docs[text_col], "\n"), F.col("__gone").isNull()
    # lines between two removed ones stay as they are: as many slices as removed lines, and one
    ends = F.concat("__gone", F.array(F.size(parts)))
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get("__gone", i - 1) + 1)
    kept = F.array_join(F.flatten(F.transform(ends, lambda end, i: F.slice(parts, begin(i) + 1, end - begin(i)))), "\n")
    n_lines = F.when(docs[text_col].isNull(), 0).otherwise(F.size(parts)).cast("long")
    return joined, F.when(none, docs[text_col]).otherwise(kept), n_lines, F.when(none, 0).otherwise(F.size("__gone")).cast("long")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", keep_copies: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines cut from the text, and ``n_lines``, ``n_removed``, which take the place of columns so named."""
    rows, (own, body, site) = positional(docs, id_col, text_col, site_col)
    joined, text, n_lines, n_removed = _cut(rows, min_sites, own, body, site, keep_copies)
    stay = [(new, old) for new, old in zip(rows.columns, docs.columns, strict=True) if old not in ("n_lines", "n_removed")]
    return joined.select(*[text if new == body else F.col(new) for new, _ in stay], n_lines, n_removed).toDF(*[old for _, old in stay], "n_lines", "n_removed")


def clean(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", size_col: str = "n_chars", keep_copies: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines cut from the text; ``size_col``, if there is one, follows a text that was cut."""
    rows, (own, body, site) = positional(docs, id_col, text_col, site_col)
    joined, text, _, n_removed = _cut(rows, min_sites, own, body, site, keep_copies)
    follow = {body: text}
    if size_col in docs.columns:
        size = f"c{docs.columns.index(size_col)}"
        follow[size] = F.when(n_removed > 0, F.length(text).cast(rows.schema[size].dataType)).otherwise(F.col(size))
    return joined.select(*[follow.get(c, F.col(c)) for c in rows.columns]).toDF(*docs.columns)
