"""Registered queries over ``embeddings``: kNN, LOF, nearest centroid, silhouette."""
from __future__ import annotations

from pyspark.sql import functions as F

from zonelens.operators import neighbours as nb
from zonelens.plans.registry import register, table
from zonelens.plans.sqltext import r6

K = 20
CONTAMINATION = 0.1


def emb(spark, sf):
    return table(spark, sf, "embeddings")


def knn_table(spark, sf):
    return nb.knn(emb(spark, sf), "vec_id", "embedding", K)


def lof_scores_df(spark, sf):
    return nb.lof(knn_table(spark, sf), K).withColumnRenamed("id", "vec_id")


KNN_SQL = f"""WITH p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id AS id, b.vec_id AS nid, list_distance(a.v, b.v) AS dist FROM p a, p b WHERE a.vec_id <> b.vec_id),
knn AS (SELECT id, nid, CAST(row_number() OVER (PARTITION BY id ORDER BY dist, nid) AS INTEGER) AS rank, dist
        FROM d QUALIFY rank <= {K})"""

LOF_SQL = KNN_SQL + f""",
kd AS (SELECT id AS nid, dist AS kdist FROM knn WHERE rank = {K}),
lrd AS (SELECT knn.id, 1.0 / (avg(greatest(kd.kdist, knn.dist)) + 1e-10) AS lrd FROM knn JOIN kd USING (nid) GROUP BY knn.id),
m AS (SELECT knn.id, avg(l.lrd) AS mlrd FROM knn JOIN lrd l ON knn.nid = l.id GROUP BY knn.id),
s AS (SELECT m.id AS vec_id, -(m.mlrd / lrd.lrd) AS lof_score FROM m JOIN lrd USING (id)),
o AS (SELECT vec_id, lof_score, lof_score < (SELECT quantile_cont(lof_score, {CONTAMINATION}) FROM s) AS is_outlier
      FROM s)"""


@register("knn_join", KNN_SQL + f"\nSELECT id AS vec_id, nid AS neighbor_id, rank, {r6('dist')} AS distance FROM knn")
def knn_join(spark, sf):
    """Exact 20 nearest neighbours of every vector (self excluded), blocked."""
    return knn_table(spark, sf).select(F.col("id").alias("vec_id"), F.col("nid").alias("neighbor_id"), "rank",
                                       F.col("dist").alias("distance"))


@register("lof_scores", LOF_SQL + f"\nSELECT vec_id, {r6('lof_score')} AS lof_score FROM s")
def lof_scores(spark, sf):
    """Negative local outlier factor, k = 20."""
    return lof_scores_df(spark, sf)


@register("lof_outliers", LOF_SQL + f"\nSELECT vec_id, {r6('lof_score')} AS lof_score, is_outlier FROM o")
def lof_outliers(spark, sf):
    """H23 + B17: outlier = score below the exact 10th percentile of all scores."""
    return nb.flag_outliers(lof_scores_df(spark, sf), CONTAMINATION)


@register("lof_top", LOF_SQL + f"\nSELECT vec_id, {r6('lof_score')} AS lof_score, is_outlier FROM o "
          "WHERE is_outlier ORDER BY lof_score, vec_id LIMIT 5")
def lof_top(spark, sf):
    """the five most anomalous outliers (lowest scores)."""
    o = nb.flag_outliers(lof_scores_df(spark, sf), CONTAMINATION)
    return o.filter("is_outlier").orderBy("lof_score", "vec_id").limit(5)


UNNEST = """e AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i,
                 unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)"""


@register("assign_centroid", f"""WITH {UNNEST},
c AS (SELECT label AS cluster, i, avg(x) AS cx FROM e GROUP BY label, i),
d AS (SELECT e.vec_id, c.cluster, sum((e.x - c.cx) * (e.x - c.cx)) AS d2 FROM e JOIN c USING (i) GROUP BY e.vec_id, c.cluster),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS rk FROM d)
SELECT r.vec_id, m.label, r.cluster, {r6('sqrt(d2)')} AS distance FROM r JOIN embeddings m USING (vec_id) WHERE rk = 1""")
def assign_centroid(spark, sf):
    """Nearest of fixed centroids (the mean vector of each label)."""
    e = emb(spark, sf)
    cents = nb.group_means(e, "label", "embedding")
    return nb.nearest_centroid(e, "embedding", cents).select("vec_id", "label", "cluster", "distance")


@register("silhouette_fixed", f"""WITH {UNNEST},
nrm AS (SELECT vec_id, label, sum(x * x) AS xx FROM e GROUP BY vec_id, label),
cs AS (SELECT label AS c, count(*) AS n, sum(xx) AS yy FROM nrm GROUP BY label),
sv AS (SELECT label AS c, i, sum(x) AS s FROM e GROUP BY label, i),
dots AS (SELECT e.vec_id, sv.c, sum(e.x * sv.s) AS xs FROM e JOIN sv USING (i) GROUP BY e.vec_id, sv.c),
md AS (SELECT nrm.vec_id, nrm.label, dots.c, cs.n, nrm.xx + cs.yy / cs.n - 2 * dots.xs / cs.n AS m
       FROM nrm JOIN dots USING (vec_id) JOIN cs ON cs.c = dots.c),
ab AS (SELECT vec_id, label,
              max(CASE WHEN c = label THEN (CASE WHEN n > 1 THEN m * n / (n - 1) ELSE 0 END) END) AS a,
              max(CASE WHEN c = label THEN n END) AS nown, min(CASE WHEN c <> label THEN m END) AS b
       FROM md GROUP BY vec_id, label)
SELECT vec_id, label, {r6('a')} AS a, {r6('b')} AS b,
       {r6('CASE WHEN nown <= 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END')} AS silhouette
FROM ab""")
def silhouette_fixed(spark, sf):
    """Per-point silhouette (squared Euclidean) of the fixed label assignment."""
    return nb.silhouette(emb(spark, sf), "embedding", "label").select("vec_id", "label", "a", "b", "silhouette")
