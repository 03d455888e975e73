"""Steps from vectors and votes to speakers: predictions, gates, splits and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import vectors as v

#: Fixed values of the steps: few segments and the similarity that makes them the host's; the margin of two clusters; early seconds.
FEW, BANK_SIMILARITY, HOST_MARGIN, EARLY = 6, 0.45, 0.02, 45.0
#: Of windows: sentences, class ratio and silhouette from which votes apply; the share of a vote that decides, and the margin of one window.
LEAST_SENTENCES, MOST_OF_ONE, MOST_SILHOUETTE, DECIDES, ONE_WINDOW = 20, 0.88, 0.38, 0.6, 0.06
#: Of mixed sentences: seconds, runs, windows; of a run: windows, seconds, margin; and the length of texts against what is expected.
MIXED_SECONDS, MOST_RUNS, MIXED_WINDOWS, RUN_WINDOWS, RUN_SECONDS, RUN_MARGIN, TEXT_BOUNDS = 3.0, 3, 4, 2, 1.2, 0.05, (0.5, 1.5)
OVERLAP_SCALE, OVERLAP_CAP = 0.78, 0.84


def few_segments(vectors: DataFrame, bank: Column) -> DataFrame:
    """``part``, ``speaker`` and ``similarity`` of parts with too few vectors to cluster: all of one speaker, by their mean."""
    few = vectors.groupBy("part").count().filter(F.col("count") < FEW).select("part")
    mean = v.centroids(vectors.join(few, "part", "left_semi"), ["part"], "x").withColumn("__bank", bank).withColumn("similarity", v.cosine(F.col("centroid"), F.col("__bank")))
    return mean.select("part", "similarity", F.when(F.col("similarity") >= BANK_SIMILARITY, "host").otherwise("guest").alias("speaker"))


def base_prediction(assigned: Column, host: Column, guest: Column) -> tuple[Column, Column]:
    """The speaker that is assigned, else the nearer one, and a logistic confidence of the margin."""
    speaker = F.coalesce(assigned, F.when(host >= guest, "host").otherwise("guest"))
    return speaker, 1 / (1 + F.exp(-20.0 * (F.abs(host - guest) - 0.02)))


def host_cluster(members: DataFrame) -> DataFrame:
    """``part`` and ``host``, the cluster (0 or 1) that is the host's.

    ``members``: part, label, original, start, similarity (of the cluster to the host bank).  Original labels decide, then
    a clear margin of similarity, then who speaks more early on, then similarity.
    """
    zero, early = F.col("label") == 0, F.col("start") <= F.min("start").over(W.partitionBy("part")) + EARLY
    says = F.col("original").isin("host", "guest")
    direct = says & (zero == (F.col("original") == "host"))
    by = members.withColumns({"__d": direct.cast("int"), "__f": (says & ~direct).cast("int"), "__e": F.when(early, F.when(zero, 1).otherwise(-1)).otherwise(0)}).groupBy("part").agg(
        F.sum("__d").alias("d"), F.sum("__f").alias("f"), F.sum("__e").alias("e"), F.max(F.when(zero, F.col("similarity"))).alias("a"), F.max(F.when(~zero, F.col("similarity"))).alias("b"))
    nearer = F.when(F.col("a") >= F.col("b"), 0).otherwise(1)
    return by.select("part", F.when(F.col("d") != F.col("f"), F.when(F.col("d") > F.col("f"), 0).otherwise(1)).when(F.abs(F.col("a") - F.col("b")) >= HOST_MARGIN, nearer).when(F.col("e") != 0, F.when(F.col("e") > 0, 0).otherwise(1)).otherwise(nearer).alias("host"))


def votes(windows: DataFrame, threshold: Column) -> DataFrame:
    """Of each sentence: windows, the ``dominant`` speaker (null at a tie), its ratio, mean similarity and its distance to ``threshold``.

    ``windows``: part, sentence, similarity; a window is the host's from the threshold on.
    """
    rows = windows.withColumn("__host", (F.col("similarity") >= threshold).cast("int"))
    by = rows.groupBy("part", "sentence").agg(F.count("*").alias("windows"), F.sum("__host").alias("h"), F.avg("similarity").alias("mean"))
    other = F.col("windows") - F.col("h")
    dominant = F.when(F.col("h") > other, "host").when(F.col("h") < other, "guest")
    return by.select("part", "sentence", "windows", dominant.alias("dominant"), (F.greatest("h", other) / F.col("windows")).alias("ratio"), "mean", F.abs(F.col("mean") - threshold).alias("distance"))


def votes_apply(n: Column, host: Column, silhouette: Column) -> Column:
    """Whether a part's speakers are so uneven that windows may override them."""
    return (n >= LEAST_SENTENCES) & (F.greatest(host, n - host) / F.greatest(n, F.lit(1)) >= MOST_OF_ONE) & (silhouette.isNull() | (silhouette <= MOST_SILHOUETTE))


def overridden(speaker: Column, confidence: Column, apply: Column, windows: Column, dominant: Column, ratio: Column, distance: Column) -> tuple[Column, Column]:
    """Speaker and confidence after a sentence's vote."""
    strong = ((windows >= 2) & (ratio >= DECIDES)) | ((windows == 1) & (distance >= ONE_WINDOW))
    takes = apply & dominant.isNotNull() & F.coalesce(strong, F.lit(False))
    new = F.least(F.lit(0.96), F.greatest(F.lit(0.58), 0.45 + 0.35 * ratio + 0.6 * distance))
    return F.when(takes, dominant).otherwise(speaker), F.when(takes, new).otherwise(confidence)


def overlap_confidence(confidence: Column, overlaps: Column) -> Column:
    return F.when(overlaps, F.least(confidence * OVERLAP_SCALE, F.lit(OVERLAP_CAP))).otherwise(confidence)


def may_split(seconds: Column, runs: Column) -> Column:
    """Whether a sentence of ``runs`` (speaker, windows, seconds, margin) is of two speakers beyond doubt."""
    kinds = F.size(F.array_distinct(F.transform(runs, lambda r: r["speaker"])))
    total = F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["windows"])
    each = F.forall(runs, lambda r: (r["windows"] >= RUN_WINDOWS) & (r["seconds"] >= RUN_SECONDS) & (r["margin"] >= RUN_MARGIN))
    return (seconds >= MIXED_SECONDS) & F.size(runs).between(2, MOST_RUNS) & (kinds >= 2) & (total >= MIXED_WINDOWS) & each


def slices(text: Column, seconds: Column) -> Column:
    """The text cut in proportion to the runs' seconds, by rounded running sums, half to even."""
    s, n = F.trim(text), F.size(seconds)
    whole = F.aggregate(seconds, F.lit(0.0), lambda a, x: a + F.greatest(x, F.lit(0.0)))
    weights = F.transform(seconds, lambda x: F.when(whole > 0, F.greatest(x, F.lit(0.0)) / whole).otherwise(1 / n))
    upto = F.transform(F.sequence(F.lit(1), n), lambda k: F.when(k == n, F.length(s)).otherwise(F.bround(F.aggregate(F.slice(weights, F.lit(1), k), F.lit(0.0), lambda a, x: a + x) * F.length(s)).cast("int")))
    return F.transform(upto, lambda end, k: F.trim(F.substring(s, F.coalesce(F.get(upto, k - 1), F.lit(0)) + 1, end - F.coalesce(F.get(upto, k - 1), F.lit(0)))))


def run_texts(raw: Column, cut: Column) -> Column:
    """Each run's own text where its length is near what the cut expects, else the cut."""
    near = lambda own, want: (F.length(own) >= TEXT_BOUNDS[0] * F.length(want)) & (F.length(own) <= TEXT_BOUNDS[1] * F.length(want))
    return F.zip_with(raw, cut, lambda own, want: F.when(F.coalesce(near(own, want), F.lit(False)) & (own != ""), own).otherwise(want))


def run_at(runs: Column, at: Column) -> Column:
    """The run (start, end) that holds a time, of the last one its end too; else the one whose bound is nearest."""
    last = F.size(runs) - 1
    holds = F.transform(runs, lambda r, k: F.when((at >= r["start"]) & ((at < r["end"]) | ((k == last) & (at == r["end"]))), k))
    gaps = F.transform(runs, lambda r, k: F.struct(F.least(F.abs(at - r["start"]), F.abs(at - r["end"])).alias("gap"), k.alias("k")))
    return F.coalesce(F.array_min(F.array_compact(holds)), F.array_min(gaps)["k"], F.lit(0))


def uncached(wanted: DataFrame, cache: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows to measure: those whose content key, a hash of their sorted fields as JSON, is not in ``cache`` (column key)."""
    text = F.to_json(F.struct(*[F.col(c) for c in sorted(key)]))
    return wanted.withColumn("key", F.sha1(F.encode(text, "UTF-8"))).join(cache.select("key"), "key", "left_anti")


def label_mismatches(rows: DataFrame, least: int = 3, seconds: float = 1.0) -> DataFrame:
    """Sentences nearer to the other role's centroid, of sections with enough of both roles.

    ``rows``: part, sentence, role, seconds, x.
    """
    roles = v.centroids(rows, ["part", "role"], "x").join(rows.groupBy("part", "role").count(), ["part", "role"]).filter(F.col("count") >= least)
    both = roles.groupBy("part").agg(F.max(F.when(F.col("role") == "host", F.col("centroid"))).alias("h"), F.max(F.when(F.col("role") == "guest", F.col("centroid"))).alias("g")).filter("h is not null and g is not null")
    near = rows.join(both, "part").withColumn("nearer", F.when(v.euclidean(F.col("x"), F.col("h")) < v.euclidean(F.col("x"), F.col("g")), "host").otherwise("guest"))
    return near.filter((F.col("nearer") != F.col("role")) & (F.col("seconds") >= seconds)).select("part", "sentence", "role", "nearer")
