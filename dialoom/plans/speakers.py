"""Vectors: similarities, centroids, clusters and votes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import vectors as v
from dialoom.operators import speakers as ops
from dialoom.plans.base import query
from dialoom.sources.tables import table

CENTROID_SQL = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), l AS (SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e),
m AS (SELECT label, i, avg(v) AS v FROM l GROUP BY 1, 2), c AS (SELECT label, list(v ORDER BY i) AS c FROM m GROUP BY 1)
"""


@query(CENTROID_SQL + "SELECT vec_id, label, floor(list_cosine_similarity(x, c) * 1e4 + 0.5) / 1e4 AS similarity FROM e JOIN c USING (label)")
def cosine_to_centroid(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    c = v.centroids(e, ["label"], "embedding")
    return e.join(c, "label").select("vec_id", "label", (F.floor(v.cosine(F.col("embedding"), F.col("centroid")) * 1e4 + 0.5) / 1e4).alias("similarity"))


@query(CENTROID_SQL + "SELECT vec_id, label, nearest FROM (SELECT e.vec_id, e.label, c.label AS nearest, row_number() OVER (PARTITION BY e.vec_id ORDER BY list_cosine_similarity(x, c) DESC, c.label) AS r FROM e CROSS JOIN c WHERE c.label IN (0, 1)) WHERE r = 1")
def nearest_role(spark: SparkSession, d: str) -> DataFrame:
    """The nearer of two centroids, which are one row."""
    e = table(spark, d, "embeddings")
    two = v.centroids(e.filter(F.col("label").isin(0, 1)), ["label"], "embedding")
    x = e.withColumns({c: two.filter(F.col("label") == k).select("centroid").scalar() for k, c in enumerate("ab")})
    return x.select("vec_id", "label", F.when(v.cosine(F.col("embedding"), F.col("b")) > v.cosine(F.col("embedding"), F.col("a")), 1).otherwise(0).alias("nearest"))


@query(CENTROID_SQL + "SELECT label, count(*) AS n, floor(avg(list_distance(x, c)) * 1e4 + 0.5) / 1e4 AS spread, CASE WHEN count(*) >= 3 THEN 'usable' ELSE 'few' END AS state FROM e JOIN c USING (label) GROUP BY label")
def centroid_audit(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    x = e.join(v.centroids(e, ["label"], "embedding"), "label").withColumn("far", v.euclidean(F.col("embedding"), F.col("centroid")))
    return x.groupBy("label").agg(F.count("*").alias("n"), (F.floor(F.avg("far") * 1e4 + 0.5) / 1e4).alias("spread")).withColumn("state", F.when(F.col("n") >= 3, "usable").otherwise("few"))


@query("""WITH v AS (SELECT label, vec_id % 3 AS vote, count(*) AS n FROM embeddings GROUP BY 1, 2), r AS (SELECT *, n * 1.0 / sum(n) OVER (PARTITION BY label) AS share, row_number() OVER (PARTITION BY label ORDER BY n DESC, vote) AS k, sum(n) OVER (PARTITION BY label) AS total FROM v)
SELECT label, vote, n, total >= 20 AND share >= 0.35 AS applies FROM r WHERE k = 1""")
def window_vote(spark: SparkSession, d: str) -> DataFrame:
    """The dominant vote of each sentence, and whether it has support enough to apply."""
    n = table(spark, d, "embeddings").groupBy("label", (F.col("vec_id") % 3).alias("vote")).agg(F.count("*").alias("n"))
    w = W.partitionBy("label")
    r = n.withColumns({"total": F.sum("n").over(w), "k": F.row_number().over(w.orderBy(F.desc("n"), "vote"))}).filter("k = 1")
    return r.select("label", "vote", "n", ((F.col("total") >= 20) & (F.col("n") / F.col("total") >= 0.35)).alias("applies"))


#: Clusters by the definition of average linkage, the mean distance of all pairs, one merge a step; a cluster is named by its first member.
CLUSTER_SQL = """WITH RECURSIVE e AS (SELECT CAST(floor(vec_id / 50) AS BIGINT) AS part, vec_id, row_number() OVER (PARTITION BY floor(vec_id / 50) ORDER BY vec_id) AS i, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
far AS (SELECT a.part, a.i, b.i AS j, 1 - list_cosine_similarity(a.x, b.x) AS d FROM e a JOIN e b ON a.part = b.part AND a.i <> b.i),
size AS (SELECT part, count(*) AS n FROM e GROUP BY part),
m AS (SELECT part, n, n AS left_, range(1, n + 1) AS of FROM size
UNION ALL SELECT part, n, left_ - 1, list_transform(of, lambda c: CASE WHEN c = best[2] THEN best[1] ELSE c END) FROM (
  SELECT part, n, left_, of, arg_min([a, b], (d, a, b)) AS best FROM (SELECT m.part, m.n, m.left_, m.of, of[f.i] AS a, of[f.j] AS b, avg(f.d) AS d FROM m JOIN far f ON f.part = m.part WHERE left_ > 2 AND of[f.i] < of[f.j] GROUP BY ALL) GROUP BY part, n, left_, of)),
done AS (SELECT part, list_transform(of, lambda c: CASE WHEN c = 1 THEN 0 ELSE 1 END) AS label FROM m QUALIFY row_number() OVER (PARTITION BY part ORDER BY left_) = 1),
s AS (SELECT f.part, f.i, avg(d) FILTER (WHERE label[f.i] = label[f.j]) AS a, avg(d) FILTER (WHERE label[f.i] <> label[f.j]) AS b FROM far f JOIN done USING (part) GROUP BY 1, 2),
w AS (SELECT part, avg(CASE WHEN a IS NULL OR greatest(a, b) <= 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM s GROUP BY part)
SELECT e.part, e.vec_id, CAST(CASE WHEN silhouette IS NULL OR silhouette < 0.03 THEN 0 ELSE label[e.i] END AS BIGINT) AS cluster, floor(silhouette * 1e6 + 0.5) / 1e6 AS silhouette FROM e JOIN done ON done.part = e.part LEFT JOIN w ON w.part = e.part"""


@query(CLUSTER_SQL)
def two_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Two clusters of each part's vectors, with the silhouette; a part without a clear split is one speaker."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", ignore_index=True)
        x = np.stack(pdf.embedding)
        labels = ops.two_clusters(x)
        s = ops.silhouette(x, labels)
        if s is None or s < 0.03:
            labels = np.zeros(len(pdf), int)
        return pd.DataFrame({"part": pdf.part, "vec_id": pdf.vec_id, "cluster": labels, "silhouette": s})

    e = table(spark, d, "embeddings").withColumn("part", F.floor(F.col("vec_id") / 50))
    found = e.groupBy("part").applyInPandas(run, "part long, vec_id long, cluster long, silhouette double")
    return found.withColumn("silhouette", F.floor(F.col("silhouette") * 1e6 + 0.5) / 1e6)


@query("""WITH x AS (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS v, row_number() OVER (PARTITION BY label ORDER BY embedding[1], vec_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
p AS (SELECT *, var_pop(v) OVER up * k AS lo, var_pop(v) OVER dn * (n - k) AS hi, avg(v) OVER up AS low, avg(v) OVER dn AS high FROM x WINDOW up AS (PARTITION BY label ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), dn AS (PARTITION BY label ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
c AS (SELECT label, arg_min(k, lo + hi) AS cut, arg_min(high - low, lo + hi) AS gap FROM p WHERE k < n GROUP BY label)
SELECT x.label, x.vec_id, CAST(CASE WHEN gap >= 0.08 AND k > cut THEN 1 ELSE 0 END AS BIGINT) AS side FROM x LEFT JOIN c ON c.label = x.label""")
def two_means_by_similarity(spark: SparkSession, d: str) -> DataFrame:
    """The first components of each label's vectors split in two where the means lie apart."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", ignore_index=True)
        labels = ops.two_means(np.array([x[0] for x in pdf.embedding]))
        return pd.DataFrame({"label": pdf.label.astype("int64"), "vec_id": pdf.vec_id, "side": labels if labels is not None else np.zeros(len(pdf), int)})

    return table(spark, d, "embeddings").groupBy("label").applyInPandas(run, "label long, vec_id long, side long")


@query("""WITH u AS (SELECT label, vec_id % 4 AS part, CAST(vec_id % 9 AS DOUBLE) / 2 AS sec, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
SELECT label, part, CAST(i - 1 AS INT) AS dim, floor(sum(sec * v) / sum(sec) * 1e6 + 0.5) / 1e6 AS mean, sum(sec) AS weight FROM u WHERE sec >= 1 GROUP BY 1, 2, 3""")
def duration_weighted_means(spark: SparkSession, d: str) -> DataFrame:
    """The mean of each speaker's vectors, longer speech counting more and what is under a second not at all."""
    e, i = table(spark, d, "embeddings"), F.col("vec_id")
    rows = e.select("label", (i % 4).alias("part"), ((i % 9) / 2).alias("sec"), "embedding")
    means = v.weighted_means(rows, ["label", "part"], "embedding", "sec")
    return means.select("label", "part", F.posexplode("mean").alias("dim", "mean"), "weight").withColumn("mean", F.floor(F.col("mean") * 1e6 + 0.5) / 1e6)
