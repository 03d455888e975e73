"""The whole chain from half-second windows to corrected speakers; the SQL smooths by one recursive step a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import vectors as v
from dialoom.operators import voice_chain as ops
from dialoom.plans.base import query
from dialoom.plans.machines_sql import RECURSIVE
from dialoom.sources.tables import segments, table


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    """Segments with a first guess; files of even number are all but one the host's."""
    e = F.col("event_id")
    guess = F.expr("case when file_id % 2 = 0 then if(event_id % 23 = 0, 'guest', 'host') when speaker = 'SPEAKER_00' then 'host' else 'guest' end")
    overlaps = F.coalesce(F.lag("end_s").over(W.partitionBy("file_id").orderBy("seg_idx")) > F.col("start_s"), F.lit(False))
    seconds = F.when(e % 4 == 0, 0.9).otherwise(F.col("end_s") - F.col("start_s"))
    return segments(spark, d).withColumn("overlaps", overlaps).select(
        "file_id", "seg_idx", "event_id", "start_s", (F.col("start_s") + seconds).alias("end_s"), F.when(e % 5 == 0, F.substring("text", 1, 6)).otherwise(F.col("text")).alias("text"),
        guess.alias("speaker"), (0.4 + e % 60 / 100).alias("confidence"), (e % 9 != 0).alias("usable"), "overlaps")


def _measured(spark: SparkSession, d: str) -> DataFrame:
    """Each window's similarity to the host's centroid; windows take their vectors from the table by number."""
    e = table(spark, d, "embeddings")
    host = v.centroids(e.filter("label = 0"), ["label"], "embedding").select("centroid").scalar()
    near = e.withColumn("host", host).select("vec_id", v.cosine(F.col("embedding"), F.col("host")).alias("similarity"))
    n = e.agg(F.count("*")).scalar()
    rows = ops.windows(_sentences(spark, d)).join(_sentences(spark, d).select("file_id", "seg_idx", "event_id"), ["file_id", "seg_idx"])
    return rows.withColumn("vec_id", (F.col("event_id") * 31 + F.col("k")) % n).join(near, "vec_id").select("file_id", "seg_idx", "k", "similarity")


SENTENCES_SQL = RECURSIVE + """, s AS (SELECT file_id, seg_idx, event_id, start_s, start_s + CASE WHEN event_id % 4 = 0 THEN 0.9 ELSE end_s - start_s END AS end_s, CASE WHEN event_id % 5 = 0 THEN left(text, 6) ELSE text END AS text,
  CASE WHEN file_id % 2 = 0 THEN CASE WHEN event_id % 23 = 0 THEN 'guest' ELSE 'host' END WHEN speaker = 'SPEAKER_00' THEN 'host' ELSE 'guest' END AS speaker, 0.4 + event_id % 60 / 100.0::DOUBLE AS confidence, event_id % 9 <> 0 AS usable,
  coalesce(lag(end_s) OVER (PARTITION BY file_id ORDER BY seg_idx) > start_s, false) AS lapped FROM seg),
cl AS (SELECT unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(CAST(embedding AS DOUBLE[]), 1) AS i FROM embeddings WHERE label = 0), c AS (SELECT list(v ORDER BY i) AS c FROM (SELECT i, avg(v) AS v FROM cl GROUP BY i)),
near AS (SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), c.c) AS similarity FROM embeddings, c),
wk AS (SELECT *, unnest(range(greatest(1, CAST(ceil((end_s - start_s - 1e-9) / 0.5) AS BIGINT)))) AS k FROM s WHERE end_s - start_s >= 0.2),
w AS (SELECT wk.file_id, wk.seg_idx, k, near.similarity FROM wk JOIN near ON near.vec_id = (wk.event_id * 31 + k) % (SELECT count(*) FROM embeddings) WHERE least(start_s + 0.5 * k + 0.5, end_s) - (start_s + 0.5 * k) >= 0.2),
x AS (SELECT file_id, similarity AS v, row_number() OVER (PARTITION BY file_id ORDER BY similarity) AS k, count(*) OVER (PARTITION BY file_id) AS n FROM w),
p AS (SELECT *, var_pop(v) OVER up * k AS lo, var_pop(v) OVER dn * (n - k) AS hi, avg(v) OVER up AS low, avg(v) OVER dn AS high FROM x WINDOW up AS (PARTITION BY file_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), dn AS (PARTITION BY file_id ORDER BY v ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
means AS (SELECT file_id, any_value(n) AS n, arg_min(low, lo + hi) AS low, arg_min(high, lo + hi) AS high FROM p WHERE k < n GROUP BY file_id)
"""


@query(SENTENCES_SQL + "SELECT file_id, n, floor(low * 1e6 + 0.5) / 1e6 AS low, floor(high * 1e6 + 0.5) / 1e6 AS high FROM means")
def window_similarity_means(spark: SparkSession, d: str) -> DataFrame:
    """The two means that each file's window similarities fall into."""
    r = lambda c: (F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c)
    return ops.two_means(_measured(spark, d), ["file_id"], "similarity").select("file_id", "n", r("low"), r("high"))


@query(SENTENCES_SQL + """, t AS (SELECT file_id, (low + high) / 2 AS t FROM means WHERE n >= 8 AND high - low >= 0.08),
vo AS (SELECT w.file_id, w.seg_idx, count(*) AS nw, count(*) FILTER (WHERE similarity >= t) AS h, abs(avg(similarity) - any_value(t)) AS distance FROM w JOIN t USING (file_id) GROUP BY 1, 2),
u AS (SELECT s.*, nw, CASE WHEN h >= nw - h THEN 'host' ELSE 'guest' END AS dominant, greatest(h, nw - h) / nw AS ratio, distance, count(*) OVER f AS n, count(*) FILTER (WHERE speaker = 'host') OVER f AS hosts, CASE WHEN file_id % 5 = 4 THEN 0.5 END AS silhouette FROM s LEFT JOIN vo USING (file_id, seg_idx) WINDOW f AS (PARTITION BY file_id)),
g AS (SELECT *, n >= 20 AND greatest(hosts, n - hosts) / n >= 0.88 AND coalesce(silhouette <= 0.38, true) AND coalesce((nw >= 2 AND ratio >= 0.6) OR (nw = 1 AND distance >= 0.06), false) AS takes FROM u),
r AS (SELECT file_id, seg_idx, n, start_s, end_s, text, usable, lapped, coalesce(nw, 0) AS n_windows, CASE WHEN takes THEN dominant ELSE speaker END AS speaker, CASE WHEN takes THEN least(0.96, greatest(0.58, 0.45 + 0.35 * ratio + 0.6 * distance)) ELSE confidence END AS conf FROM g),
a AS (SELECT *, CASE WHEN lapped THEN least(conf * 0.78, 0.84) ELSE conf END AS c1, lead(speaker) OVER (PARTITION BY file_id ORDER BY seg_idx) AS following FROM r),
m AS (SELECT file_id, seg_idx, speaker AS label, c1 AS c2 FROM a WHERE seg_idx = 0
  UNION ALL SELECT a.file_id, a.seg_idx, CASE WHEN f THEN before ELSE speaker END, CASE WHEN f THEN greatest(c1, 0.58) ELSE c1 END FROM (SELECT a.*, m.label AS before, a.seg_idx < a.n - 1 AND a.end_s - a.start_s <= 1.0 AND (NOT usable OR c1 < 0.55) AND m.label = following AND m.label <> a.speaker AS f FROM m JOIN a ON a.file_id = m.file_id AND a.seg_idx = m.seg_idx + 1) a),
b AS (SELECT a.*, m.label, m.c2, lead(m.label, 1) OVER o AS l1, lead(m.label, 2) OVER o AS l2, lead(a.end_s - a.start_s, 1) OVER o AS d1, lead(a.end_s - a.start_s, 2) OVER o AS d2, min(a.start_s) OVER (PARTITION BY a.file_id) AS t0 FROM a JOIN m USING (file_id, seg_idx) WINDOW o AS (PARTITION BY a.file_id ORDER BY a.seg_idx)),
q AS (SELECT *, label = 'guest' AND seg_idx < 3 AND start_s - t0 <= 24 AND contains(text, 'e') AND (coalesce(l1 = 'guest' AND d1 >= 1.5, false) OR coalesce(l2 = 'guest' AND d2 >= 1.5, false)) AS prior FROM b),
y AS (SELECT *, CASE WHEN prior THEN 'host' ELSE label END AS l3, CASE WHEN prior THEN greatest(0.66, least(c2, 0.78)) ELSE c2 END AS c3, length(regexp_replace(lower(text), '[ ,.!?:;"()\\[\\]''-]', '', 'g')) AS size FROM q),
e1 AS (SELECT *, size > 0 AND NOT (end_s - start_s > 1.2 AND c3 > 0.62) AND (size <= 8 OR c3 <= 0.62 OR NOT usable) AS loose, lead(l3, 1) OVER o AS n1, lead(l3, 2) OVER o AS n2 FROM y WINDOW o AS (PARTITION BY file_id ORDER BY seg_idx)),
e2 AS (SELECT *, CASE WHEN seg_idx = 0 AND n1 = n2 AND n1 <> l3 AND loose THEN n1 ELSE l3 END AS l4, CASE WHEN seg_idx = 0 AND n1 = n2 AND n1 <> l3 AND loose THEN greatest(c3, 0.6) ELSE c3 END AS c4 FROM e1),
e3 AS (SELECT *, lag(l4, 1) OVER o AS b1, lag(l4, 2) OVER o AS b2 FROM e2 WINDOW o AS (PARTITION BY file_id ORDER BY seg_idx)),
z AS (SELECT *, coalesce(seg_idx = n - 1 AND b1 = b2 AND b1 <> l4 AND size > 0 AND NOT (end_s - start_s > 1.2 AND c4 > 0.62) AND (size <= 8 OR c4 <= 0.62 OR NOT usable), false) AS turns FROM e3)
SELECT file_id, seg_idx, n_windows, CASE WHEN turns THEN b1 ELSE l4 END AS speaker, floor(CASE WHEN turns THEN greatest(c4, 0.6) ELSE c4 END * 1e6 + 0.5) / 1e6 AS confidence FROM z""")
def voice_chain(spark: SparkSession, d: str) -> DataFrame:
    """Windows, means, votes and corrections in one go; a text with an e is a prompt here."""
    sentences = _sentences(spark, d)
    silhouettes = sentences.select("file_id").distinct().withColumn("silhouette", F.expr("case when file_id % 5 = 4 then double(0.5) end"))
    refined = ops.refined(sentences, ops.votes(_measured(spark, d)), silhouettes)
    done = ops.postprocessed(refined, F.contains("text", F.lit("e")))
    return done.select("file_id", "seg_idx", F.col("n_windows").cast("long").alias("n_windows"), "speaker", (F.floor(F.col("confidence") * 1e6 + 0.5) / 1e6).alias("confidence"))
