"""Quality rules: base rules, then robust multivariate outliers.

Five transformed statistics of a document form a vector.  For each language and
source the minimum-covariance-determinant estimate is found by C-steps from two
deterministic starts (medians with absolute deviations; all rows), each step
keeping the ``SUBSET`` of rows nearest by Mahalanobis distance; the start with
the smaller determinant wins, one reweighting follows, and documents further
than ``CUT`` are rejected.  Groups under ``LEAST_ROWS`` rows take the estimate
of their language, and languages as small that of all rows; these estimates are
of all rows of the language or the table, those of large groups included, and
are made only where a small group needs them.

The nearest rows are found from counts of distances in bins of 1/64 of a
logarithm, so every row counts, the threshold is the same on any machine, and a
group with a third of all rows is aggregated in parts like any other.

Cases: a null or empty text has no words and fails the base rules; a very long
text is counted whole; rows that tie in distance are in or out of a subset
together, since their bin is; a null language or source is a group of its own; ids that repeat give one row each,
judged alike if their texts are; extra columns pass ``keep`` unchanged; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.llm.session import cut, positional

#: Vector: log words, log mean word length, symbols a character, repeated lines, words in repeated windows.
DIMS = 5
#: The least standard deviation taken for each; below it differences are no sign of quality.
FLOORS = (0.25, 0.05, 0.01, 0.08, 0.06)
SUBSET, STEPS, LEAST_ROWS = 0.75, 4, 50
#: Of a chi-square law with five degrees: consistency of a 75 % subset and of the 97.5 % reweighting, and its 97.5 % point.
CONSISTENT, REWEIGHTED, POINT_975 = 1.41, 1.06, 12.83
#: Distance from which a document is rejected.
CUT = 7.0
#: Models of so many groups are sent to all tasks: some 300 bytes each.
FEW_GROUPS = 50_000
SPACE = r"\x20\x09-\x0D"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, of an array of words."""

    def positions(hashes: Column) -> Column:
        return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def doubled(s: Column) -> Column:
        pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct(F.flatten(F.array_compact(pairs))), lambda i: F.array(i, i + 1, i + 2)))))

    hashes = F.zip_with(F.zip_with(F.slice(words, 1, F.size(words) - 2), F.slice(words, 2, F.size(words) - 2), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.slice(words, 3, F.size(words) - 2), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    counted = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(positions(h), doubled)).otherwise(0))
    return F.when(F.size(words) < 4, 0).otherwise(counted)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with word and line statistics of the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    measured = let(words, lambda w: F.struct(
        F.size(w).alias("n_words"), F.aggregate(w, F.lit(0), lambda n, x: n + F.length(x)).alias("word_chars"), repeated_words(w).alias("n_repeat_words"),
    ))
    counted = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return docs.withColumn("__m", F.struct(measured.alias("w"), counted.alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("s")))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: id, statistics, base_failed, kept, and ``distance``."""
    got = statistics(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source")))
    m = F.col("__m")
    rows = got.select(
        "id", F.xxhash64("text").alias("body"), "lang", "source",
        m["w"]["n_words"].cast("long").alias("n_words"), m["w"]["word_chars"].cast("long").alias("word_chars"), m["s"].cast("long").alias("n_symbols"),
        m["l"]["n_dup_lines"].cast("long").alias("n_dup_lines"), m["w"]["n_repeat_words"].cast("long").alias("n_repeat_words"), m["l"]["n_lines"].alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    fit = ~F.col("base_failed")
    vector = [F.log1p("n_words"), F.log(F.col("word_chars") / F.col("n_words")), F.col("n_symbols") / F.col("word_chars"), F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), F.col("n_repeat_words") / F.col("n_words")]
    rows = cut(rows.withColumns({f"x{k}": F.when(fit, v) for k, v in enumerate(vector)}))
    keyed = _keys(rows)
    judged = mahalanobis(keyed)
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= CUT)).alias("kept"), "distance", "body",
    )


def _keys(rows: DataFrame) -> DataFrame:
    """Adds ``key``, the estimate a row is judged by: of its language and source, or its language, or all rows, whichever has rows enough; and ``fits``, the estimates the row is part of."""
    fit = rows.filter(~F.col("base_failed"))
    own, of_lang, of_all = F.xxhash64(F.lit(2), "lang", "source"), F.xxhash64(F.lit(1), "lang"), F.lit(0).cast("long")
    by_lang = W.partitionBy("lang")
    n = fit.groupBy("lang", "source").count().withColumns({"in_lang": F.sum("count").over(by_lang), "least": F.min("count").over(by_lang)})
    n = n.withColumn("key", F.when(F.col("count") >= LEAST_ROWS, own).when(F.col("in_lang") >= LEAST_ROWS, of_lang).otherwise(of_all))
    n = n.join(F.broadcast(n.agg((F.min("in_lang") < LEAST_ROWS).alias("rare"))), how="cross")
    fits = F.array_compact(F.array(
        F.when(F.col("count") >= LEAST_ROWS, own), F.when((F.col("least") < LEAST_ROWS) & (F.col("in_lang") >= LEAST_ROWS), of_lang), F.when(F.col("rare"), of_all),
    ))
    n = n.select(F.col("lang").alias("l"), F.col("source").alias("s"), "key", fits.alias("fits"))
    return cut(rows.join(n, rows["lang"].eqNullSafe(n["l"]) & rows["source"].eqNullSafe(n["s"]), "left").drop("l", "s"))


X, PAIRS = [f"x{k}" for k in range(DIMS)], [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m_{x}") for x in X], *[F.avg(F.col(X[i]) * F.col(X[j])).alias(f"p_{i}{j}") for i, j in PAIRS])


def _factor(moments: DataFrame, by: list[str], scale: float) -> DataFrame:
    """Means, the Cholesky factor of the scaled covariance with floors, and its log determinant."""
    df = moments.withColumns({f"c_{i}{j}": scale * (F.col(f"p_{i}{j}") - F.col(f"m_{X[i]}") * F.col(f"m_{X[j]}")) + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in PAIRS})
    for i, j in PAIRS:  # row by row; each needs only entries before it
        rest = F.col(f"c_{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
        df = df.withColumn(f"l_{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 100))) if i == j else rest / F.col(f"l_{j}{j}"))
    det = sum((F.log(F.col(f"l_{i}{i}")) for i in range(DIMS)), F.lit(0.0))
    return df.select(*by, *[F.col(f"m_{x}") for x in X], *[F.col(f"l_{i}{j}") for i, j in PAIRS], det.alias("logdet"))


def _small(groups: DataFrame) -> DataFrame:
    """One row for each group, broadcast if they are counted and few."""
    return F.broadcast(groups) if groups.count() <= FEW_GROUPS else groups


def _squared(rows: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance ``d2`` from the factor's columns in the row."""
    for i in range(DIMS):
        y = F.col(X[i]) - F.col(f"m_{X[i]}")
        for k in range(i):
            y = y - F.col(f"l_{i}{k}") * F.col(f"y_{k}")
        rows = rows.withColumn(f"y_{i}", y / F.col(f"l_{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(DIMS)), F.lit(0.0)))


def _nearest(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows within the bin of distance that completes the subset."""
    rows = rows.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-9) * 64).cast("int"))
    upto = W.partitionBy(*by).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = rows.groupBy(*by, "bin").count().withColumns({"before": F.coalesce(F.sum("count").over(upto), F.lit(0)), "all": F.sum("count").over(W.partitionBy(*by))})
    last = bins.filter(F.col("before") < SUBSET * F.col("all")).groupBy(*by).agg(F.max("bin").alias("last"))
    return rows.join(_small(cut(last)), by).filter("bin <= last")


def _medians(fit: DataFrame) -> DataFrame:
    """The first start: medians, and a diagonal of absolute deviations, by counts of binned values."""
    def middle(long: DataFrame) -> DataFrame:
        upto = W.partitionBy("key", "dim").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
        bins = long.groupBy("key", "dim", "bin").count().withColumns({"before": F.coalesce(F.sum("count").over(upto), F.lit(0)), "all": F.sum("count").over(W.partitionBy("key", "dim"))})
        return bins.filter(F.col("before") * 2 < F.col("all")).groupBy("key", "dim").agg((F.max("bin") / 512).alias("mid"))

    long = fit.select("key", F.posexplode(F.array(*X)).alias("dim", "x"))
    mid = middle(long.withColumn("bin", F.floor(F.col("x") * 512)))
    away = long.join(mid, ["key", "dim"]).withColumn("bin", F.floor(F.abs(F.col("x") - F.col("mid")) * 512))
    both = mid.join(middle(away.select("key", "dim", "bin")).withColumnRenamed("mid", "mad"), ["key", "dim"]).groupBy("key").agg(
        *[F.max(F.when(F.col("dim") == k, F.col("mid"))).alias(f"m_{x}") for k, x in enumerate(X)],
        *[F.max(F.when(F.col("dim") == k, F.greatest(F.col("mad") * 1.4826, F.lit(FLOORS[k])))).alias(f"l_{k}{k}") for k in range(DIMS)],
    )
    return both.select("key", F.lit(0).alias("start"), *[F.col(f"m_{x}") for x in X], *[F.col(f"l_{i}{j}") if i == j else F.lit(0.0).alias(f"l_{i}{j}") for i, j in PAIRS], F.lit(0.0).alias("logdet"))


def mahalanobis(rows: DataFrame) -> DataFrame:
    """Adds ``distance`` by the minimum-covariance-determinant estimate of each row's key, which all rows with that key among their ``fits`` make."""
    fit = rows.filter("not base_failed").select(F.explode("fits").alias("key"), *X)
    by = ["key", "start"]
    model = cut(_medians(fit).unionByName(_factor(_moments(fit.withColumn("start", F.lit(1)), by), by, 1.0)))
    both = fit.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    for _ in range(STEPS):
        near = _nearest(_squared(both.join(_small(model), by)).select(*by, *X, "d2"), by)
        model = cut(_factor(_moments(near, by), by, CONSISTENT))
    best = model.withColumn("rank", F.row_number().over(W.partitionBy("key").orderBy("logdet", "start"))).filter("rank = 1").drop("rank", "start")
    inner = _squared(fit.join(_small(best), "key")).filter(F.col("d2") <= POINT_975).select("key", *X)
    model = cut(_factor(_moments(inner, ["key"]), ["key"], REWEIGHTED))
    return _squared(rows.join(_small(model), "key", "left")).withColumn("distance", F.sqrt("d2"))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that pass, with their columns, whatever these are called."""
    rows, (own, text, lang, source) = positional(docs, id_col, text_col, lang_col, source_col)
    verdict = quality(rows, own, text, lang, source).filter("kept").select(F.col(own).alias("id"), "body").distinct()
    return rows.join(verdict, F.col(own).eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("body")), "left_semi").toDF(*docs.columns)
