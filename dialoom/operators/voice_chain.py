"""From windows of speech to speakers: similarities split in two, votes of sentences, and the chain of corrections after them.

Everything is windows over a file's rows in order and joins on the sentence; no
file is gathered.  Speakers are ``host`` and ``guest`` throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed values of the method: windows, the split in two, votes, and corrections.
WINDOW, HOP, LEAST_WINDOW = 0.5, 0.5, 0.2
LEAST_WINDOWS, LEAST_GAP = 8, 0.08
LEAST_SENTENCES, MOST_OF_ONE, MOST_SILHOUETTE = 20, 0.88, 0.38
DECIDES, ONE_WINDOW = 0.6, 0.06
OVERLAP_SCALE, OVERLAP_CAP = 0.78, 0.84
OPENING_SECONDS, OPENING_SENTENCES, FOLLOW_SECONDS = 24.0, 3, 1.5
EDGE_SECONDS, EDGE_CONFIDENCE, EDGE_LETTERS = 1.2, 0.62, 8
#: Signs that do not count as letters of a text.
SIGNS = " \t\r\n,，。.!！？?、:：;；\"'“”‘’（）()-[]【】"

FILE = ["file_id"]


def windows(sentences: DataFrame) -> DataFrame:
    """file_id, seg_idx, ``k``, ``left_s``, ``right_s`` of the half-second windows of each sentence.

    A sentence of up to half a second is one window, one under 0.2 s has none, and
    a rest under 0.2 s is left out.
    """
    seconds = F.col("end_s") - F.col("start_s")
    last = F.greatest(F.lit(0), F.ceil((seconds - 1e-9) / HOP).cast("int") - 1)
    at = F.col("start_s") + HOP * F.col("k")
    cut = sentences.filter(seconds >= LEAST_WINDOW).withColumn("k", F.explode(F.sequence(F.lit(0), last)))
    return cut.select("file_id", "seg_idx", "k", at.alias("left_s"), F.least(at + WINDOW, F.col("end_s")).alias("right_s")).filter(F.col("right_s") - F.col("left_s") >= LEAST_WINDOW)


def two_means(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by``, ``n``, ``low`` and ``high``: the means of the exact split of ``value`` in two by least squares.

    Sums of the values and of their squares run over the ordered values, so the
    cost of every cut is known at its row; of equal costs the first cut counts.
    Groups of one row have no split and are left out.
    """
    # about the group's mean, so that squares stay small
    whole = W.partitionBy(*by)
    x = rows.select(*by, F.col(value).cast("double").alias("v")).withColumns({"n": F.count("*").over(whole), "mid": F.avg("v").over(whole)}).withColumn("v", F.col("v") - F.col("mid"))
    up_to = whole.orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    x = x.withColumns({"s": F.sum("v").over(up_to), "q": F.sum(F.col("v") * F.col("v")).over(up_to), "k": F.row_number().over(whole.orderBy("v")), "all_s": F.sum("v").over(whole), "all_q": F.sum(F.col("v") * F.col("v")).over(whole)})
    rest, n_rest = F.col("all_s") - F.col("s"), F.col("n") - F.col("k")
    cost = F.col("q") - F.col("s") * F.col("s") / F.col("k") + F.col("all_q") - F.col("q") - rest * rest / n_rest
    cuts = x.filter(n_rest > 0).select(*by, "n", "k", cost.alias("cost"), (F.col("mid") + F.col("s") / F.col("k")).alias("low"), (F.col("mid") + rest / n_rest).alias("high"))
    best = cuts.groupBy(*by).agg(F.first("n").alias("n"), F.min_by(F.struct("low", "high"), F.struct("cost", "k")).alias("m"))
    return best.select(*by, "n", "m.low", "m.high")


def votes(measured: DataFrame) -> DataFrame:
    """file_id, seg_idx and the vote of each sentence that has windows, in files whose windows part.

    ``measured``: file_id, seg_idx, similarity (of a window to the host).  A file
    needs 8 windows and means 0.08 apart; a window is the host's from the middle
    of the means on, and so is a sentence half of whose windows are.
    """
    parts = two_means(measured, FILE, "similarity").filter((F.col("n") >= LEAST_WINDOWS) & (F.col("high") - F.col("low") >= LEAST_GAP)).select("file_id", ((F.col("low") + F.col("high")) / 2).alias("threshold"))
    rows = measured.join(parts, "file_id").withColumn("host", (F.col("similarity") >= F.col("threshold")).cast("int"))
    by = rows.groupBy("file_id", "seg_idx").agg(F.count("*").alias("n_windows"), F.sum("host").alias("h"), F.avg("similarity").alias("mean"), F.first("threshold").alias("threshold"))
    other = F.col("n_windows") - F.col("h")
    return by.select(
        "file_id", "seg_idx", "n_windows", F.when(F.col("h") >= other, "host").otherwise("guest").alias("dominant"),
        (F.greatest("h", other) / F.col("n_windows")).alias("ratio"), F.abs(F.col("mean") - F.col("threshold")).alias("distance"),
    )


def refined(predictions: DataFrame, found: DataFrame, silhouettes: DataFrame) -> DataFrame:
    """``predictions`` with speakers and confidences that votes override, and ``n_windows``, ``changed``.

    predictions: file_id, seg_idx, speaker, confidence; found: of ``votes``;
    silhouettes: file_id, silhouette.  Only files of 20 sentences or more are
    changed, of which one speaker has 0.88 or more and the clusters are no clearer
    than 0.38.
    """
    file = W.partitionBy("file_id")
    host, n = F.count_if(F.col("speaker") == "host").over(file), F.count("*").over(file)
    x = predictions.withColumn("uneven", (n >= LEAST_SENTENCES) & (F.greatest(host, n - host) / n >= MOST_OF_ONE)).join(silhouettes, "file_id", "left").join(found, ["file_id", "seg_idx"], "left")
    unclear = F.col("silhouette").isNull() | (F.col("silhouette") <= MOST_SILHOUETTE)
    strong = ((F.col("n_windows") >= 2) & (F.col("ratio") >= DECIDES)) | ((F.col("n_windows") == 1) & (F.col("distance") >= ONE_WINDOW))
    takes = F.col("uneven") & unclear & F.coalesce(strong, F.lit(False))
    new = F.least(F.lit(0.96), F.greatest(F.lit(0.58), 0.45 + 0.35 * F.col("ratio") + 0.6 * F.col("distance")))
    changed = takes & ((F.col("dominant") != F.col("speaker")) | (F.abs(F.col("confidence") - new) > 1e-9))
    return x.select(
        *[c for c in predictions.columns if c not in ("speaker", "confidence")], F.when(takes, F.col("dominant")).otherwise(F.col("speaker")).alias("speaker"),
        F.when(takes, new).otherwise(F.col("confidence")).alias("confidence"), F.coalesce("n_windows", F.lit(0)).alias("n_windows"), changed.alias("changed"),
    )


def letters(text: Column) -> Column:
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), SIGNS, "")


def postprocessed(predictions: DataFrame, cue: Column) -> DataFrame:
    """``predictions`` after the chain: overlaps lower confidence, short weak sentences between two others join
    them, an opening cue is the host's, and the first and last sentence follow the two beside them.

    predictions: file_id, seg_idx, start_s, end_s, text, speaker, confidence,
    ``usable`` and ``overlaps``; ``cue``: whether a sentence is a host's prompt.

    Smoothing goes from left to right and counts labels changed before.  With two
    labels a run of sentences that may change takes the label before it: where a
    sentence differs from it, it is changed, and where it does not, it need not be.
    """
    w = W.partitionBy("file_id").orderBy("seg_idx")
    seconds = F.col("end_s") - F.col("start_s")
    lowered = F.when(F.col("overlaps"), F.least(F.col("confidence") * OVERLAP_SCALE, F.lit(OVERLAP_CAP))).otherwise(F.col("confidence"))
    x = predictions.withColumn("confidence", lowered).withColumns({"n": F.count("*").over(W.partitionBy("file_id")), "place": F.row_number().over(w), "following": F.lead("speaker").over(w)})
    inner = (F.col("place") > 1) & (F.col("place") < F.col("n"))
    may = inner & (seconds <= 1.0) & (~F.col("usable") | (F.col("confidence") < 0.55)) & (F.col("following") != F.col("speaker"))
    x = x.withColumn("kept", F.when(~may, F.col("speaker"))).withColumn("smooth", F.last("kept", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    x = x.withColumn("confidence", F.when(F.col("smooth") != F.col("speaker"), F.greatest("confidence", F.lit(0.58))).otherwise(F.col("confidence"))).withColumn("speaker", F.col("smooth"))
    follows = lambda k: F.coalesce((F.lead("speaker", k).over(w) == "guest") & (F.lead(seconds, k).over(w) >= FOLLOW_SECONDS), F.lit(False))
    opens = (F.col("place") <= OPENING_SENTENCES) & (F.col("start_s") - F.first("start_s").over(w.rowsBetween(W.unboundedPreceding, 0)) <= OPENING_SECONDS) & cue & (follows(1) | follows(2))
    x = x.withColumn("prior", opens & (F.col("speaker") != "host"))
    x = x.withColumns({"speaker": F.when(F.col("prior"), "host").otherwise(F.col("speaker")), "confidence": F.when(F.col("prior"), F.greatest(F.lit(0.66), F.least("confidence", F.lit(0.78)))).otherwise(F.col("confidence"))})
    size = F.length(letters(F.col("text")))
    loose = (size > 0) & ~((seconds > EDGE_SECONDS) & (F.col("confidence") > EDGE_CONFIDENCE)) & ((size <= EDGE_LETTERS) | (F.col("confidence") <= EDGE_CONFIDENCE) | ~F.col("usable"))

    def edge(rows: DataFrame, place: Column, first: Column, second: Column) -> DataFrame:
        turns = place & (first == second) & (first != F.col("speaker")) & loose
        made = rows.withColumn("turns", F.coalesce(turns, F.lit(False))).withColumn("to", first)
        return made.withColumns({"speaker": F.when(F.col("turns"), F.col("to")).otherwise(F.col("speaker")), "confidence": F.when(F.col("turns"), F.greatest("confidence", F.lit(0.6))).otherwise(F.col("confidence"))})

    # the last sentence sees what became of the first
    x = edge(x, (F.col("place") == 1) & (F.col("n") >= 2), F.lead("speaker", 1).over(w), F.lead("speaker", 2).over(w))
    x = edge(x, (F.col("place") == F.col("n")) & (F.col("n") >= 2), F.lag("speaker", 1).over(w), F.lag("speaker", 2).over(w))
    return x.select(*predictions.columns)
