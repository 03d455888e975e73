"""From vectors and votes to speakers, with what changed and what is suspect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import vectors as v
from dialoom.operators import voices as ops
from dialoom.plans.base import query
from dialoom.sources.tables import SEGMENTS_SQL, segments, table

E_SQL = """WITH e AS (SELECT vec_id, vec_id % 20 AS part, label, CASE WHEN (label + vec_id % 3) % 2 = 0 THEN 'host' ELSE 'guest' END AS original, (vec_id % 7)::DOUBLE AS sec, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
l AS (SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e), m AS (SELECT label, i, avg(v) AS v FROM l GROUP BY 1, 2), c AS (SELECT label, list(v ORDER BY i) AS c FROM m GROUP BY 1),
s AS (SELECT e.*, list_cosine_similarity(x, (SELECT c FROM c WHERE label = 0)) AS h, list_cosine_similarity(x, (SELECT c FROM c WHERE label = 1)) AS g FROM e)
"""


def _e(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("vec_id")
    e = table(spark, d, "embeddings").select(i, (i % 20).alias("part"), "label", F.when((F.col("label") + i % 3) % 2 == 0, "host").otherwise("guest").alias("original"), (i % 7).cast("double").alias("sec"), F.col("embedding").cast("array<double>").alias("x"))
    two = v.centroids(e.filter("label < 2"), ["label"], "x")
    near = e.withColumns({c: two.filter(F.col("label") == k).select("centroid").scalar() for k, c in enumerate(("c0", "c1"))})
    return near.withColumns({"h": v.cosine(F.col("x"), F.col("c0")), "g": v.cosine(F.col("x"), F.col("c1"))}).drop("c0", "c1")


def _r(c, n: int = 4):
    return F.floor(c * 10**n + 0.5) / 10**n


@query(E_SQL + """, k AS (SELECT vec_id % 110 AS part, x FROM e), n AS (SELECT part FROM k GROUP BY part HAVING count(*) < 6), q AS (SELECT part, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM k WHERE part IN (SELECT part FROM n)),
z AS (SELECT part, list(v ORDER BY i) AS c FROM (SELECT part, i, avg(v) AS v FROM q GROUP BY 1, 2) GROUP BY part), y AS (SELECT part, list_cosine_similarity(z.c, (SELECT c FROM c WHERE label = 0)) AS s FROM z)
SELECT part, floor(s * 1e4 + 0.5) / 1e4 AS similarity, CASE WHEN s >= 0.45 THEN 'host' ELSE 'guest' END AS speaker FROM y""")
def few_segment_parts(spark: SparkSession, d: str) -> DataFrame:
    e = _e(spark, d)
    bank = v.centroids(e.filter("label = 0"), ["label"], "x").select("centroid").scalar()
    out = ops.few_segments(e.select((F.col("vec_id") % 110).alias("part"), "x"), bank)
    return out.withColumn("similarity", _r(F.col("similarity")))


@query(E_SQL + """SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN original WHEN h >= g THEN 'host' ELSE 'guest' END AS speaker, floor(CASE WHEN vec_id % 5 = 0 THEN least(0.78 / (1 + exp(-20 * (abs(h - g) - 0.02))), 0.84) ELSE 1 / (1 + exp(-20 * (abs(h - g) - 0.02))) END * 1e4 + 0.5) / 1e4 AS confidence FROM s""")
def base_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Assigned or nearer speakers; confidence falls where speech overlaps."""
    i = F.col("vec_id")
    speaker, confidence = ops.base_prediction(F.when(i % 4 == 0, F.col("original")), F.col("h"), F.col("g"))
    return _e(spark, d).select("vec_id", speaker.alias("speaker"), _r(ops.overlap_confidence(confidence, i % 5 == 0)).alias("confidence"))


@query(E_SQL + """, t AS (SELECT part, label % 2 AS label, CASE WHEN part % 3 = 0 THEN original WHEN part % 3 = 1 THEN NULL ELSE CASE WHEN vec_id // 20 % 2 = 0 THEN 'host' ELSE 'guest' END END AS o, vec_id * 1.0 AS start, CASE WHEN part % 2 = 0 THEN 0.5 + (label % 2) * 0.1 ELSE 0.5 + (label % 2) * 0.01 END AS similarity FROM e),
b AS (SELECT part, count(*) FILTER (WHERE (label = 0 AND o = 'host') OR (label = 1 AND o = 'guest')) AS d, count(*) FILTER (WHERE (label = 1 AND o = 'host') OR (label = 0 AND o = 'guest')) AS f,
sum(CASE WHEN start <= m + 45 THEN CASE WHEN label = 0 THEN 1 ELSE -1 END ELSE 0 END) AS e, max(CASE WHEN label = 0 THEN similarity END) AS a, max(CASE WHEN label = 1 THEN similarity END) AS b FROM (SELECT *, min(start) OVER (PARTITION BY part) AS m FROM t) GROUP BY part)
SELECT part, CASE WHEN d <> f THEN CASE WHEN d > f THEN 0 ELSE 1 END WHEN abs(a - b) >= 0.02 THEN CASE WHEN a >= b THEN 0 ELSE 1 END WHEN e <> 0 THEN CASE WHEN e > 0 THEN 0 ELSE 1 END WHEN a >= b THEN 0 ELSE 1 END AS host FROM b""")
def host_cluster(spark: SparkSession, d: str) -> DataFrame:
    i, part, label = F.col("vec_id"), F.col("part"), F.col("label") % 2
    o = F.when(part % 3 == 0, F.col("original")).when(part % 3 == 2, F.when(F.floor(i / 20) % 2 == 0, "host").otherwise("guest"))
    t = _e(spark, d).select("part", label.alias("label"), o.alias("original"), (i * 1.0).alias("start"), (0.5 + label * F.when(part % 2 == 0, 0.1).otherwise(0.01)).alias("similarity"))
    return ops.host_cluster(t)


VOTE_SQL = E_SQL + """, w AS (SELECT part, vec_id // 60 AS sentence, h AS similarity FROM s), u AS (SELECT part, sentence, count(*) AS windows, sum(CASE WHEN similarity >= 0.1 THEN 1 ELSE 0 END) AS hh, avg(similarity) AS mean FROM w GROUP BY 1, 2),
q AS (SELECT part, sentence, windows, CASE WHEN hh > windows - hh THEN 'host' WHEN hh < windows - hh THEN 'guest' END AS dominant, greatest(hh, windows - hh) / windows AS ratio, mean, abs(mean - 0.1) AS distance FROM u)
"""


def _votes(spark: SparkSession, d: str) -> DataFrame:
    return ops.votes(_e(spark, d).select("part", F.floor(F.col("vec_id") / 60).alias("sentence"), F.col("h").alias("similarity")), F.lit(0.1))


@query(VOTE_SQL + "SELECT part, sentence, windows, dominant, floor(ratio * 1e4 + 0.5) / 1e4 AS ratio, floor(mean * 1e4 + 0.5) / 1e4 AS mean, floor(distance * 1e4 + 0.5) / 1e4 AS distance FROM q")
def sentence_votes(spark: SparkSession, d: str) -> DataFrame:
    return _votes(spark, d).withColumns({c: _r(F.col(c)) for c in ("ratio", "mean", "distance")})


@query(VOTE_SQL + """SELECT part, sentence, CASE WHEN takes THEN dominant ELSE 'host' END AS speaker, floor(CASE WHEN takes THEN least(0.96, greatest(0.58, 0.45 + 0.35 * ratio + 0.6 * distance)) ELSE 0.5 END * 1e4 + 0.5) / 1e4 AS confidence
FROM (SELECT *, part % 4 <> 0 AND dominant IS NOT NULL AND ((windows >= 2 AND ratio >= 0.6) OR (windows = 1 AND distance >= 0.06)) AS takes FROM q)""")
def vote_overrides(spark: SparkSession, d: str) -> DataFrame:
    """Votes against a part that is the host's alone: 24 of 25 sentences, and a silhouette that every fourth part has too high."""
    apply = ops.votes_apply(F.lit(25), F.lit(24), F.when(F.col("part") % 4 == 0, 0.5).when(F.col("part") % 4 == 1, 0.3))
    speaker, confidence = ops.overridden(F.lit("host"), F.lit(0.5), apply, *[F.col(c) for c in ("windows", "dominant", "ratio", "distance")])
    return _votes(spark, d).select("part", "sentence", speaker.alias("speaker"), _r(confidence).alias("confidence"))


RUNS_SQL = SEGMENTS_SQL + """, b AS (SELECT file_id, seg_idx // 3 AS sentence, seg_idx % 3 AS k, start_s, end_s, end_s - start_s AS seconds, speaker, event_id % 5 AS windows, event_id % 4 * 0.03 AS margin FROM seg WHERE file_id % 2 = 0)
"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    b = segments(spark, d).filter("file_id % 2 = 0")
    run = F.struct(F.col("seg_idx"), F.col("speaker"), (F.col("event_id") % 5).alias("windows"), (F.col("end_s") - F.col("start_s")).alias("seconds"), (F.col("event_id") % 4 * 0.03).alias("margin"), F.col("start_s").alias("start"), F.col("end_s").alias("end"))
    return b.groupBy("file_id", F.floor(F.col("seg_idx") / 3).alias("sentence")).agg(F.sort_array(F.collect_list(run)).alias("runs"), F.max("end_s").alias("b"), F.min("start_s").alias("a"))


@query(RUNS_SQL + """SELECT file_id, sentence, max(end_s) - min(start_s) >= 3 AND count(*) BETWEEN 2 AND 3 AND count(DISTINCT speaker) >= 2 AND sum(windows) >= 4 AND bool_and(windows >= 2 AND seconds >= 1.2 AND margin >= 0.05) AS splits FROM b GROUP BY 1, 2""")
def mixed_sentences(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).select("file_id", "sentence", ops.may_split(F.col("b") - F.col("a"), F.col("runs")).alias("splits"))


@query(RUNS_SQL + """, w AS (SELECT *, sum(seconds) OVER p AS whole, count(*) OVER p AS n, sum(seconds) OVER (PARTITION BY file_id, sentence ORDER BY k) AS run FROM b WINDOW p AS (PARTITION BY file_id, sentence)),
u AS (SELECT *, 'abcdefghijklmnopqrstuvwxyz' AS t, CASE WHEN k = n - 1 THEN 26 ELSE CAST(round_even(CASE WHEN whole > 0 THEN run / whole ELSE (k + 1) / n END * 26, 0) AS INT) END AS upto FROM w),
v AS (SELECT *, substr(t, coalesce(lag(upto) OVER (PARTITION BY file_id, sentence ORDER BY k), 0) + 1, upto - coalesce(lag(upto) OVER (PARTITION BY file_id, sentence ORDER BY k), 0)) AS cut, CASE WHEN k = 1 THEN '1234567' ELSE '' END AS raw FROM u)
SELECT file_id, sentence, string_agg(CASE WHEN raw <> '' AND length(raw) BETWEEN 0.5 * length(cut) AND 1.5 * length(cut) THEN raw ELSE cut END, '|' ORDER BY k) AS texts FROM v GROUP BY 1, 2""")
def run_texts(spark: SparkSession, d: str) -> DataFrame:
    """A sentence's text cut by its runs' times; a run's own text where its length is as expected."""
    cut = ops.slices(F.lit("abcdefghijklmnopqrstuvwxyz"), F.transform("runs", lambda r: r["seconds"]))
    raw = F.transform("runs", lambda r, k: F.when(k == 1, "1234567").otherwise(""))
    return _runs(spark, d).select("file_id", "sentence", F.array_join(ops.run_texts(raw, cut), "|").alias("texts"))


@query(RUNS_SQL + """, p AS (SELECT file_id, sentence, min(start_s) + sentence % 7 * 2.5 - 2 AS t0, max(k) AS last FROM b GROUP BY 1, 2),
h AS (SELECT b.file_id, b.sentence, k, t0, t0 >= start_s AND (t0 < end_s OR (k = last AND t0 = end_s)) AS holds, least(abs(t0 - start_s), abs(t0 - end_s)) AS gap, greatest(start_s, t0) AS c1, least(end_s, t0 + 5) AS c2 FROM b JOIN p USING (file_id, sentence))
SELECT file_id, sentence, coalesce(min(CASE WHEN holds THEN k END), arg_min(k, (gap, k))) AS run, coalesce(sum(CASE WHEN c2 > c1 THEN (c1 + c2) / 2 END), 0) AS midpoints FROM h GROUP BY 1, 2""")
def located_runs(spark: SparkSession, d: str) -> DataFrame:
    """The run at a time, the nearest where none is; and the middles of runs clipped to five seconds from there."""
    at = F.col("a") + F.col("sentence") % 7 * 2.5 - 2
    clip = F.transform("runs", lambda r: F.when(F.least(r["end"], at + 5) > F.greatest(r["start"], at), (F.greatest(r["start"], at) + F.least(r["end"], at + 5)) / 2).otherwise(0.0))
    return _runs(spark, d).select("file_id", "sentence", ops.run_at(F.col("runs"), at).cast("long").alias("run"), F.aggregate(clip, F.lit(0.0), lambda s, x: s + x).alias("midpoints"))


@query(E_SQL + """, z AS (SELECT vec_id, part, original, CASE WHEN h >= g THEN 'host' ELSE 'guest' END AS now FROM s)
SELECT part, original AS before, now AS after, count(*) AS n, string_agg(vec_id, ',' ORDER BY vec_id) FILTER (WHERE original <> now) AS changes FROM z GROUP BY 1, 2, 3""")
def speaker_changes(spark: SparkSession, d: str) -> DataFrame:
    """Speakers before and after, and the sentences that changed."""
    now = F.when(F.col("h") >= F.col("g"), "host").otherwise("guest")
    changed = F.when(F.col("original") != F.col("after"), F.col("vec_id"))
    by = _e(spark, d).withColumn("after", now).groupBy("part", F.col("original").alias("before"), "after").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(changed)).alias("c"))
    return by.select("part", "before", "after", "n", F.when(F.size("c") > 0, F.array_join("c", ",")).alias("changes"))


@query("""WITH k AS (SELECT *, sha1('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '"}') AS key FROM documents) SELECT doc_id, key FROM k WHERE doc_id % 3 <> 0""")
def unmeasured(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose content is not in the cache of measurements."""
    docs = table(spark, d, "documents").select("source", "lang", "doc_id")
    cache = docs.filter("doc_id % 3 = 0").select(F.sha1(F.encode(F.to_json(F.struct("doc_id", "lang", "source")), "UTF-8")).alias("key"))
    return ops.uncached(docs, cache, ("source", "doc_id", "lang")).select("doc_id", "key")


@query(E_SQL + """, q AS (SELECT part, original, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e), n AS (SELECT part, original, count(*) AS n FROM e GROUP BY 1, 2), z AS (SELECT part, original, list(v ORDER BY i) AS c FROM (SELECT part, original, i, avg(v) AS v FROM q GROUP BY 1, 2, 3) GROUP BY 1, 2),
y AS (SELECT z.* FROM z JOIN n USING (part, original) WHERE n >= 3), b AS (SELECT a.part, a.c AS h, o.c AS g FROM y a JOIN y o ON a.part = o.part AND a.original = 'host' AND o.original = 'guest')
SELECT part, vec_id AS sentence, original AS role, CASE WHEN list_distance(x, h) < list_distance(x, g) THEN 'host' ELSE 'guest' END AS nearer FROM e JOIN b USING (part) WHERE sec >= 1 AND original <> CASE WHEN list_distance(x, h) < list_distance(x, g) THEN 'host' ELSE 'guest' END""")
def label_mismatches(spark: SparkSession, d: str) -> DataFrame:
    return ops.label_mismatches(_e(spark, d).select("part", F.col("vec_id").alias("sentence"), F.col("original").alias("role"), F.col("sec").alias("seconds"), "x"))


@query(E_SQL + """SELECT part, floor(avg(CASE WHEN original = 'guest' THEN 1 - h END) * 1e4 + 0.5) / 1e4 AS guest, floor(avg(CASE WHEN original = 'host' AND part % 5 <> 0 THEN 1 - h END) * 1e4 + 0.5) / 1e4 AS host FROM s GROUP BY part
HAVING coalesce(avg(CASE WHEN original = 'guest' THEN 1 - h END) - avg(CASE WHEN original = 'host' AND part % 5 <> 0 THEN 1 - h END) <= 0.001, true)""")
def suspect_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls in which guests are no further from the host's voice than hosts are, or where that cannot be told."""
    far = 1 - F.col("h")
    by = _e(spark, d).groupBy("part").agg(F.avg(F.when(F.col("original") == "guest", far)).alias("g"), F.avg(F.when((F.col("original") == "host") & (F.col("part") % 5 != 0), far)).alias("o"))
    return by.filter(F.coalesce(F.col("g") - F.col("o") <= 0.001, F.lit(True))).select("part", _r(F.col("g")).alias("guest"), _r(F.col("o")).alias("host"))


@query(E_SQL + """, w AS (SELECT part, vec_id // 60 AS sentence, vec_id, h, row_number() OVER (PARTITION BY part, vec_id // 60 ORDER BY vec_id) - 1 AS k FROM s)
SELECT part, sentence, k * 0.5 AS w_start, floor(h * 1e4 + 0.5) / 1e4 AS similarity FROM w""")
def window_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Half-second windows of each sentence with their similarity to the host."""
    s = F.floor(F.col("vec_id") / 60)
    k = F.row_number().over(W.partitionBy("part", "sentence").orderBy("vec_id")) - 1
    return _e(spark, d).withColumn("sentence", s).select("part", "sentence", (k * 0.5).alias("w_start"), _r(F.col("h")).alias("similarity"))
