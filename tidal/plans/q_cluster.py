"""Queries for distances, Lloyd steps and clustering metrics on `embeddings`.

Deterministic start: the K vectors with the smallest ``vec_id``. The DuckDB
twins compute every distance by brute force (points x centroids, and all
point pairs for silhouettes). The Spark side pairs points for Euclidean
silhouettes alone, block by block inside its tasks.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as VX
from ..operators import cluster as CL
from ..operators import cluster_eval as CE
from ..sources import tables as T
from .registry import query

K = 10
DIM = 64


def _rnd(df, cols, d=6):
    for c in cols:
        df = df.withColumn(c, F.round(c, d))
    return df


def _points(spark, sf):
    e = T.read_table(spark, sf, "embeddings")
    return e.select("vec_id", VX.as_double_array("embedding").alias("x"), "label")


def _assigned(spark, sf, k=K):
    p = _points(spark, sf)
    centers = CL.initial_centroids_lowest_id(p, "vec_id", "x", k)
    return p, centers, CL.assign(p, "x", centers)


def _tail(sql: str, base: str) -> str:
    """The CTEs a twin adds after ``base`` (without the leading comma)."""
    assert sql.startswith(base)
    return sql[len(base):].lstrip().lstrip(",")


SQDIST = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"

BASE = f"""WITH pts AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings),
init AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cid, x AS c
         FROM pts ORDER BY vec_id LIMIT {K}),
dist AS (SELECT vec_id, cid, {SQDIST} AS d FROM pts, init),
asg AS (SELECT pts.vec_id, x, label, a.cluster, a.sq_distance FROM pts JOIN
        (SELECT vec_id, arg_min(cid, (d, cid)) AS cluster, min(d) AS sq_distance FROM dist GROUP BY vec_id) a
        ON pts.vec_id = a.vec_id)"""

# brute-force pairwise means (own cluster excludes the point itself)
PAIRS = f"""{BASE},
pd AS (SELECT p.vec_id, q.cluster, list_sum(list_transform(range(1, len(p.x) + 1),
                lambda i: (p.x[i] - q.x[i]) * (p.x[i] - q.x[i]))) AS d2
       FROM asg p JOIN asg q ON p.vec_id <> q.vec_id),
msd AS (SELECT vec_id, cluster, avg(sqrt(d2)) AS m, avg(d2) AS m2 FROM pd GROUP BY vec_id, cluster),
ab AS (SELECT asg.vec_id, asg.cluster,
              max(CASE WHEN msd.cluster = asg.cluster THEN m END) AS a,
              min(CASE WHEN msd.cluster <> asg.cluster THEN m END) AS b,
              max(CASE WHEN msd.cluster = asg.cluster THEN m2 END) AS a2,
              min(CASE WHEN msd.cluster <> asg.cluster THEN m2 END) AS b2
       FROM asg JOIN msd ON asg.vec_id = msd.vec_id GROUP BY asg.vec_id, asg.cluster),
sil AS (SELECT vec_id, cluster, a, b, a2, b2,
               CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0.0
                    ELSE (b - a) / greatest(a, b) END AS silhouette,
               CASE WHEN a2 IS NULL OR b2 IS NULL OR greatest(a2, b2) = 0 THEN 0.0
                    ELSE (b2 - a2) / greatest(a2, b2) END AS silhouette_sq FROM ab)"""

CENTS = f"""{BASE},
dims AS (SELECT cluster, i, avg(x[i]) AS v FROM asg, range(1, {DIM} + 1) t(i) GROUP BY cluster, i),
cent AS (SELECT cluster, list(v ORDER BY i) AS c, FROM dims GROUP BY cluster),
own AS (SELECT asg.vec_id, asg.cluster, asg.x, {SQDIST} AS d2 FROM asg JOIN cent ON asg.cluster = cent.cluster)"""


@query("nearest_centroid", f"""{BASE}
SELECT vec_id, cluster, round(sqrt(sq_distance), 6) AS distance FROM asg""")
def q_nearest_centroid(spark, sf):
    """Nearest of the K start centroids and the distance to it."""
    _, _, a = _assigned(spark, sf)
    return a.select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


@query("centroid_distances", f"""{BASE}
SELECT vec_id, cid AS cluster, round(sqrt(d), 6) AS distance FROM dist""")
def q_centroid_distances(spark, sf):
    """Distance of every vector to every centroid, long form."""
    p, centers, _ = _assigned(spark, sf)
    return _rnd(CL.centroid_distances(p, "vec_id", "x", centers), ["distance"])


@query("lloyd_step", f"""{CENTS}
SELECT cluster, CAST(i - 1 AS INTEGER) AS dim, round(v, 6) AS value FROM dims""")
def q_lloyd_step(spark, sf):
    """One assign + recentre step from the K lowest-id vectors; new centroids, long form."""
    _, _, a = _assigned(spark, sf)
    m = CL.cluster_means(a, "x", "cluster", DIM)
    return _rnd(m.select("cluster", F.posexplode("centroid").alias("dim", "value")), ["value"])


@query("cluster_sizes", f"{BASE} SELECT cluster, count(*) AS count FROM asg GROUP BY cluster")
def q_cluster_sizes(spark, sf):
    """Points per assigned cluster."""
    _, _, a = _assigned(spark, sf)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("count"))


@query("cluster_centroids", f"""WITH pts AS (SELECT CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings)
SELECT label, CAST(i - 1 AS INTEGER) AS dim, round(avg(x[i]), 6) AS value
FROM pts, range(1, {DIM} + 1) t(i) GROUP BY label, i""")
def q_cluster_centroids(spark, sf):
    """Mean vector per true label."""
    m = CL.cluster_means(_points(spark, sf), "x", "label", DIM)
    return _rnd(m.select("label", F.posexplode("centroid").alias("dim", "value")), ["value"])


@query("inertia", f"{CENTS} SELECT round(sum(d2), 6) AS inertia FROM own")
def q_inertia(spark, sf):
    """Sum of squared distances to the cluster means."""
    _, _, a = _assigned(spark, sf)
    return _rnd(CE.inertia(a, "x", "cluster", DIM), ["inertia"])


@query("pairwise_silhouette", f"""{PAIRS}
SELECT vec_id, cluster, round(m, 6) AS mean_dist FROM msd""")
def q_pairwise_silhouette(spark, sf):
    """Mean Euclidean distance of every point to every cluster's members,
    itself excluded, over all pairs as in the twin."""
    _, _, a = _assigned(spark, sf)
    m = CE.mean_distances(a, "vec_id", "x", "cluster").select("vec_id", F.explode("md").alias("z"))
    return _rnd(m.select("vec_id", F.col("z.c").alias("cluster"), F.col("z.m").alias("mean_dist")).where("mean_dist is not null"),
                ["mean_dist"])


@query("pairwise_silhouette_sq", f"""{PAIRS}
SELECT vec_id, cluster, round(m2, 6) AS mean_sq_dist FROM msd""")
def q_pairwise_silhouette_sq(spark, sf):
    """Mean squared distance of every point to every cluster, exact from
    cluster sums on a table of any size (the twin pairs all points)."""
    _, _, a = _assigned(spark, sf)
    stats = CE.cluster_stats(a, "x", "cluster", DIM)
    m = CE.mean_sq_dist_to_clusters(a, "x", "cluster", stats, DIM)
    ids = F.array(*[F.lit(s["cluster"]) for s in stats])
    out = m.select("vec_id", F.explode(F.arrays_zip(ids.alias("c"), F.col("msd").alias("m"))).alias("z"))
    out = out.select("vec_id", F.col("z.c").alias("cluster"), F.col("z.m").alias("mean_sq_dist"))
    return _rnd(out.filter(F.col("mean_sq_dist").isNotNull()), ["mean_sq_dist"])


@query("silhouette", f"""{PAIRS}
SELECT vec_id, cluster, round(a, 6) AS a, round(b, 6) AS b, round(silhouette, 6) AS silhouette FROM sil""")
def q_silhouette(spark, sf):
    """Per-point Euclidean silhouette with a and b."""
    _, _, a = _assigned(spark, sf)
    s = CE.silhouette(a, "vec_id", "x", "cluster")
    return _rnd(s.select("vec_id", "cluster", "a", "b", "silhouette"), ["a", "b", "silhouette"])


@query("silhouette_sq", f"""{PAIRS}
SELECT vec_id, cluster, round(a2, 6) AS a, round(b2, 6) AS b, round(silhouette_sq, 6) AS silhouette_sq FROM sil""")
def q_silhouette_sq(spark, sf):
    """Per-point squared-distance silhouette with a and b."""
    _, _, a = _assigned(spark, sf)
    s = CE.silhouette_samples(a, "x", "cluster", DIM).withColumnRenamed("silhouette", "silhouette_sq")
    return _rnd(s.select("vec_id", "cluster", "a", "b", "silhouette_sq"), ["a", "b", "silhouette_sq"])


@query("calinski_harabasz", f"""{CENTS},
mu AS (SELECT list(v ORDER BY i) AS m FROM (SELECT i, avg(x[i]) AS v FROM asg, range(1, {DIM} + 1) t(i) GROUP BY i)),
bt AS (SELECT sum(cnt * list_sum(list_transform(range(1, {DIM} + 1), lambda i: (c[i] - m[i]) * (c[i] - m[i])))) AS B
       FROM cent JOIN (SELECT cluster, count(*) AS cnt FROM asg GROUP BY cluster) s USING (cluster), mu),
wt AS (SELECT sum(d2) AS W, count(*) AS n FROM own),
kk AS (SELECT count(DISTINCT cluster) AS k FROM asg)
SELECT round(CASE WHEN W = 0 THEN 1.0 ELSE (B / (k - 1)) / (W / (n - k)) END, 6) AS calinski_harabasz
FROM bt, wt, kk""")
def q_calinski_harabasz(spark, sf):
    """Calinski-Harabasz index of the assignment."""
    _, _, a = _assigned(spark, sf)
    return _rnd(CE.calinski_harabasz(a, "x", "cluster", DIM), ["calinski_harabasz"])


_CPAIRS = f"""{CENTS},
cp AS (SELECT a.cluster AS i, b.cluster AS j,
              sqrt(list_sum(list_transform(range(1, {DIM} + 1), lambda t: (a.c[t] - b.c[t]) * (a.c[t] - b.c[t])))) AS d
       FROM cent a JOIN cent b ON a.cluster <> b.cluster),
coh AS (SELECT cluster, count(*) AS size, avg(sqrt(d2)) AS cohesion FROM own GROUP BY cluster)"""


@query("centroid_pairs", f"{_CPAIRS} SELECT i, j, round(d, 6) AS distance FROM cp")
def q_centroid_pairs(spark, sf):
    """Distances between all pairs of distinct cluster means."""
    _, _, a = _assigned(spark, sf)
    cents = CE.centroids_from_stats(CE.cluster_stats(a, "x", "cluster", DIM))
    return _rnd(spark.createDataFrame(CE.centroid_pairs(cents), "i int, j int, distance double"),
                ["distance"])


@query("davies_bouldin", f"""{_CPAIRS},
r AS (SELECT i, max((ci.cohesion + cj.cohesion) / d) AS ri FROM cp
      JOIN coh ci ON ci.cluster = cp.i JOIN coh cj ON cj.cluster = cp.j WHERE d > 0 GROUP BY i)
SELECT round(avg(ri), 6) AS davies_bouldin FROM r""")
def q_davies_bouldin(spark, sf):
    """Davies-Bouldin index of the assignment."""
    _, _, a = _assigned(spark, sf)
    return _rnd(CE.davies_bouldin(a, "x", "cluster", DIM), ["davies_bouldin"])


@query("cluster_quality", ",\n".join([PAIRS, _tail(CENTS, BASE), _tail(_CPAIRS, CENTS), """sep AS (SELECT i AS cluster, min(d) AS separation FROM cp GROUP BY i),
sc AS (SELECT cluster, avg(silhouette) AS silhouette_avg, avg(silhouette_sq) AS silhouette_sq_avg FROM sil GROUP BY cluster)
SELECT coh.cluster, size, round(cohesion, 6) AS cohesion, round(silhouette_avg, 6) AS silhouette_avg,
       round(silhouette_sq_avg, 6) AS silhouette_sq_avg,
       round(coalesce(separation, CAST('Infinity' AS DOUBLE)), 6) AS separation
FROM coh JOIN sc USING (cluster) LEFT JOIN sep USING (cluster)"""]))
def q_cluster_quality(spark, sf):
    """Per cluster: size, cohesion, mean silhouettes, separation."""
    _, _, a = _assigned(spark, sf)
    q = CE.cluster_quality(a, "vec_id", "x", "cluster", DIM)
    return _rnd(q, ["cohesion", "silhouette_avg", "silhouette_sq_avg", "separation"])


@query("contingency", f"""{BASE}
SELECT cluster, label, count(*) AS count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY cluster), 6) AS row_share
FROM asg GROUP BY cluster, label""")
def q_contingency(spark, sf):
    """Cluster x label counts and row shares."""
    _, _, a = _assigned(spark, sf)
    return _rnd(CE.contingency(a, "cluster", "label"), ["row_share"])


EXT = f"""{BASE},
c AS (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS nij FROM asg GROUP BY cluster, label),
a AS (SELECT cluster, sum(nij) AS ai, max(nij) AS mi FROM c GROUP BY cluster),
b AS (SELECT label, sum(nij) AS bj FROM c GROUP BY label),
t AS (SELECT sum(nij) AS n, sum(nij * (nij - 1) / 2) AS sum_ij,
             sum(nij * ln(nij)) - sum(nij * (ln(ai) + ln(bj))) AS mi_num FROM c JOIN a USING (cluster) JOIN b USING (label)),
ta AS (SELECT sum(ai * (ai - 1) / 2) AS sum_a, sum(ai * ln(ai)) AS alog, sum(mi) AS sum_max,
              count(*) AS n_pred FROM a),
tb AS (SELECT sum(bj * (bj - 1) / 2) AS sum_b, sum(bj * ln(bj)) AS blog, count(*) AS n_true FROM b),
e AS (SELECT *, sum_a * sum_b / (n * (n - 1) / 2) AS expected, (sum_a + sum_b) / 2 AS mx,
             ln(n) - alog / n AS h_pred, ln(n) - blog / n AS h_true,
             greatest(0.0, mi_num / n + ln(n)) AS mi FROM t, ta, tb),
m AS (SELECT *, CASE WHEN mx = expected THEN 1.0 ELSE (sum_ij - expected) / (mx - expected) END AS adjusted_rand,
             CASE WHEN h_true > 0 THEN mi / h_true ELSE 1.0 END AS homogeneity,
             CASE WHEN h_pred > 0 THEN mi / h_pred ELSE 1.0 END AS completeness,
             CASE WHEN n_pred = 1 AND n_true = 1 THEN 1.0
                  ELSE mi / greatest((h_true + h_pred) / 2, 2.220446049250313e-16) END AS nmi,
             sum_max / n AS purity FROM e),
ext AS (SELECT adjusted_rand, nmi, homogeneity, completeness,
               CASE WHEN homogeneity + completeness > 0
                    THEN 2 * homogeneity * completeness / (homogeneity + completeness) ELSE 0.0 END AS v_measure,
               purity FROM m)"""


def _ext(spark, sf):
    _, _, a = _assigned(spark, sf)
    return CE.external_metrics(a, "cluster", "label")


def _ext_query(name, cols):
    sql = f"{EXT} SELECT {', '.join(f'round({c}, 6) AS {c}' for c in cols)} FROM ext"

    def fn(spark, sf):
        """External metric(s) from the cluster x label contingency table."""
        return _rnd(_ext(spark, sf).select(*cols), cols)
    query(name, sql)(fn)


_ext_query("adjusted_rand", ["adjusted_rand"])
_ext_query("nmi", ["nmi"])
_ext_query("homogeneity_completeness_v", ["homogeneity", "completeness", "v_measure"])
_ext_query("cluster_purity", ["purity"])


_REPORT_SQL = ",\n".join([
    PAIRS,
    _tail(CENTS, BASE),
    _tail(_CPAIRS, CENTS),
    """mu AS (SELECT list(v ORDER BY i) AS mm FROM (SELECT i, avg(x[i]) AS v FROM asg, range(1, 65) t(i) GROUP BY i)),
bt AS (SELECT sum(cnt * list_sum(list_transform(range(1, 65), lambda i: (c[i] - mm[i]) * (c[i] - mm[i])))) AS bb
       FROM cent JOIN (SELECT cluster, count(*) AS cnt FROM asg GROUP BY cluster) s USING (cluster), mu),
wt AS (SELECT sum(d2) AS ww, count(*) AS nn FROM own),
kk AS (SELECT count(DISTINCT cluster) AS k FROM asg),
rr AS (SELECT i, max((ci.cohesion + cj.cohesion) / d) AS ri FROM cp
       JOIN coh ci ON ci.cluster = cp.i JOIN coh cj ON cj.cluster = cp.j WHERE d > 0 GROUP BY i)""",
    _tail(EXT, BASE),
])


@query("cluster_eval_report", _REPORT_SQL + """
SELECT 'inertia' AS metric, round(sum(d2), 6) AS value FROM own
UNION ALL SELECT 'silhouette', round(avg(silhouette), 6) FROM sil
UNION ALL SELECT 'silhouette_sq', round(avg(silhouette_sq), 6) FROM sil
UNION ALL SELECT 'calinski_harabasz', round(CASE WHEN ww = 0 THEN 1.0 ELSE (bb / (k - 1)) / (ww / (nn - k)) END, 6)
          FROM bt, wt, kk
UNION ALL SELECT 'davies_bouldin', round(avg(ri), 6) FROM rr
UNION ALL SELECT metric, round(value, 6) FROM ext
  UNPIVOT (value FOR metric IN (adjusted_rand, nmi, homogeneity, completeness, v_measure, purity))""")
def q_cluster_eval_report(spark, sf):
    """Internal (inertia, both silhouettes, Calinski-Harabasz,
    Davies-Bouldin) and external (ARI, NMI, homogeneity, completeness,
    V-measure, purity) metrics as one tidy (metric, value) table."""
    _, _, a = _assigned(spark, sf)
    a = a.cache()
    internal = [("inertia", CE.inertia(a, "x", "cluster", DIM).first()[0]),
                ("silhouette", CE.silhouette_summary(a, "vec_id", "x", "cluster")),
                ("silhouette_sq", CE.silhouette_sq_summary(a, "x", "cluster", DIM)),
                ("calinski_harabasz", CE.calinski_harabasz(a, "x", "cluster", DIM).first()[0]),
                ("davies_bouldin", CE.davies_bouldin(a, "x", "cluster", DIM).first()[0])]
    e = CE.external_metrics(a, "cluster", "label")
    cols = ["adjusted_rand", "nmi", "homogeneity", "completeness", "v_measure", "purity"]
    ext = e.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
                                      for c in cols])))
    intern = spark.createDataFrame([(m, float(v)) for m, v in internal], "metric string, value double")
    return _rnd(intern.unionByName(ext), ["value"])


@query("kmeans_fit_embeddings")
def q_kmeans_fit_embeddings(spark, sf):
    """k-means with K = 10 (best of 10 k-means++ starts) on the embeddings,
    scored against the true labels (ARI, NMI, V-measure, purity) and by
    inertia and Euclidean silhouette."""
    p = _points(spark, sf).cache()
    fit = CL.kmeans_fit(p, "x", K)
    a = CL.assign(p, "x", fit.centers).cache()
    e = CE.external_metrics(a, "cluster", "label")
    return e.select("*", F.lit(fit.inertia).alias("inertia"),
                    F.lit(CE.silhouette_summary(a, "vec_id", "x", "cluster")).alias("silhouette"),
                    F.lit(K).alias("k"))


@query("anomaly_score", f"""{BASE},
bd AS (SELECT min(sqrt(sq_distance)) AS lo, max(sqrt(sq_distance)) AS hi FROM asg)
SELECT vec_id, cluster, round(CASE WHEN hi > lo THEN least(1.0, greatest(0.0, (sqrt(sq_distance) - lo) / (hi - lo)))
                                   ELSE 0.0 END, 6) AS anomaly_score,
       CASE WHEN hi > lo THEN least(1.0, greatest(0.0, (sqrt(sq_distance) - lo) / (hi - lo))) ELSE 0.0 END > 0.7
         AS is_anomalous
FROM asg, bd""")
def q_anomaly_score(spark, sf):
    """Min-max scaled distance to the assigned centroid and the 0.7 flag."""
    from ..functions.columns import flag_anomalous
    _, _, a = _assigned(spark, sf)
    b = a.agg(F.min("distance").alias("lo"), F.max("distance").alias("hi")).first()
    s = a.withColumn("anomaly_score", CL.anomaly_score(a, b["lo"], b["hi"]))
    return s.select("vec_id", "cluster", F.round("anomaly_score", 6).alias("anomaly_score"),
                    flag_anomalous("anomaly_score").alias("is_anomalous"))


# ---- K curve from deterministic starts (K lowest-id vectors, one assignment) ------

CURVE = f"""WITH pts AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
init AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cid, x AS c
         FROM pts ORDER BY vec_id LIMIT 10),
ks AS (SELECT CAST(k AS INTEGER) AS k FROM range(3, 11) t(k)),
dist AS (SELECT k, vec_id, cid, {SQDIST} AS d FROM pts, init, ks WHERE cid < k),
asg AS (SELECT k, vec_id, arg_min(cid, (d, cid)) AS cluster, min(d) AS sq FROM dist GROUP BY k, vec_id),
ax AS (SELECT asg.*, x FROM asg JOIN pts USING (vec_id)),
pair AS (SELECT p.k, p.vec_id, q.cluster, avg(sqrt(list_sum(list_transform(range(1, {DIM} + 1),
                lambda t: (p.x[t] - q.x[t]) * (p.x[t] - q.x[t]))))) AS m
         FROM ax p JOIN ax q ON p.k = q.k AND p.vec_id <> q.vec_id GROUP BY p.k, p.vec_id, q.cluster),
ab AS (SELECT ax.k, ax.vec_id, max(CASE WHEN pair.cluster = ax.cluster THEN m END) AS a,
              min(CASE WHEN pair.cluster <> ax.cluster THEN m END) AS b
       FROM ax JOIN pair ON ax.k = pair.k AND ax.vec_id = pair.vec_id GROUP BY ax.k, ax.vec_id),
sil AS (SELECT k, avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0.0
                           ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab GROUP BY k),
curve AS (SELECT k, sum(sq) AS inertia FROM asg GROUP BY k),
cv AS (SELECT curve.k, inertia, silhouette FROM curve JOIN sil USING (k)),
nm AS (SELECT k, inertia, silhouette, (k - 3) / 7.0 AS kn,
              CASE WHEN max(inertia) OVER () - min(inertia) OVER () > 0
                   THEN (inertia - min(inertia) OVER ()) / (max(inertia) OVER () - min(inertia) OVER ())
                   ELSE inertia - min(inertia) OVER () END AS inn FROM cv),
fl AS (SELECT arg_min(inn, k) AS f, arg_max(inn, k) AS l FROM nm),
el AS (SELECT arg_min(k, (-(abs(1.0 * (f - inn) - (l - f) * (0.0 - kn)) / sqrt(1.0 + (l - f) * (l - f))), k))
              AS elbow_k FROM nm, fl),
bs AS (SELECT arg_min(k, (-silhouette, k)) AS best_silhouette_k, max(silhouette) AS best_sil FROM cv),
es AS (SELECT silhouette AS elbow_sil FROM cv, el WHERE cv.k = el.elbow_k)"""


def _curve(spark, sf):
    """(k, inertia, silhouette) for K = 3..10, each K started from the K
    lowest-id vectors and assigned once; one pass for all K."""
    import numpy as np

    from ..operators import kmeans as KM
    init = np.array(CL.initial_centroids_lowest_id(_points(spark, sf), "vec_id", "x", 10))
    vectors, _ = KM.prepared(_points(spark, sf), "x")
    models = KM.with_inertia(vectors, [KM.Model(k, 0, init[:k]) for k in range(3, 11)], init.mean(0))
    sil = CE.curve_silhouettes(vectors, [m.centers for m in models])
    vectors.unpersist()
    rows = [(m.k, m.inertia, float(s[0])) for m, s in zip(models, sil)]
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


@query("k_curve", f"{CURVE} SELECT k, round(inertia, 6) AS inertia, round(silhouette, 6) AS silhouette FROM cv")
def q_k_curve(spark, sf):
    """Inertia and silhouette for K = 3..10 from deterministic starts."""
    return _rnd(_curve(spark, sf), ["inertia", "silhouette"])


@query("elbow_point", f"{CURVE} SELECT elbow_k FROM el")
def q_elbow_point(spark, sf):
    """K farthest from the normalised inertia chord."""
    return CL.elbow_point(_curve(spark, sf))


@query("best_silhouette_k", f"{CURVE} SELECT best_silhouette_k FROM bs")
def q_best_silhouette_k(spark, sf):
    c = _curve(spark, sf)
    return c.agg(F.min_by("k", F.struct(-F.col("silhouette"), F.col("k"))).alias("best_silhouette_k"))


@query("select_k", f"""{CURVE}
SELECT elbow_k, best_silhouette_k,
       CASE WHEN best_sil > elbow_sil + 0.05 THEN best_silhouette_k ELSE elbow_k END AS selected_k,
       CASE WHEN best_sil > elbow_sil + 0.05 THEN 'silhouette' ELSE 'elbow' END AS reason
FROM el, bs, es""")
def q_select_k(spark, sf):
    """Elbow K unless the best-silhouette K beats it by more than 0.05."""
    return CL.select_k(_curve(spark, sf))


# ---- vectors as terms / topics --------------------------------------------------------

@query("document_topics", """WITH p AS (
  SELECT vec_id, CAST(i - 1 AS INTEGER) AS component, CAST(embedding[i] AS DOUBLE) AS score
  FROM embeddings, range(1, len(embedding) + 1) t(i))
SELECT vec_id, component, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(score) DESC, component) AS rank FROM p)
WHERE rank <= 3""")
def q_document_topics(spark, sf):
    """Top 3 components by |score| per row (each vector read as a topic mix)."""
    from pyspark.sql import Window
    p = _points(spark, sf).select("vec_id", F.posexplode("x").alias("component", "score"))
    w = Window.partitionBy("vec_id").orderBy(F.abs("score").desc(), "component")
    return p.withColumn("rank", F.row_number().over(w)).filter("rank <= 3")


@query("term_similarity", f"""WITH pts AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
q AS (SELECT x AS c FROM pts ORDER BY vec_id LIMIT 1),
s AS (SELECT vec_id, list_sum(list_transform(range(1, len(x) + 1), lambda i: x[i] * c[i]))
             / (sqrt(list_sum(list_transform(x, lambda v: v * v))) * sqrt(list_sum(list_transform(c, lambda v: v * v))))
             AS cosine FROM pts, q WHERE vec_id <> (SELECT min(vec_id) FROM pts))
SELECT vec_id, round(cosine, 6) AS cosine FROM s ORDER BY cosine DESC, vec_id LIMIT 10""")
def q_term_similarity(spark, sf):
    """Cosine of the first vector against all others, 10 most similar."""
    p = _points(spark, sf)
    first = p.orderBy("vec_id").limit(1).collect()[0]
    qv = list(first["x"])
    qn = sum(v * v for v in qv) ** 0.5
    cos = VX.dot("x", qv) / (F.sqrt(VX.sq_norm("x", len(qv))) * F.lit(qn))
    s = p.filter(F.col("vec_id") != first["vec_id"]).select("vec_id", cos.alias("cosine"))
    return s.orderBy(F.col("cosine").desc(), "vec_id").limit(10).withColumn("cosine", F.round("cosine", 6))


@query("cumulative_variance", f"""WITH p AS (SELECT CAST(i - 1 AS INTEGER) AS component, CAST(embedding[i] AS DOUBLE) AS v
                                     FROM embeddings, range(1, {DIM} + 1) t(i)),
vv AS (SELECT component, var_pop(v) AS variance FROM p GROUP BY component)
SELECT component, round(variance, 9) AS variance,
       round(variance / sum(variance) OVER (), 9) AS ratio,
       round(sum(variance) OVER (ORDER BY component) / sum(variance) OVER (), 9) AS cumulative
FROM vv""")
def q_cumulative_variance(spark, sf):
    """Per-dimension population variance, its share and the running share."""
    from pyspark.sql import Window
    x = F.col("x")
    p = _points(spark, sf)
    wide = p.agg(F.array(*[F.var_pop(x[i]) for i in range(DIM)]).alias("v"))
    vv = wide.select(F.posexplode("v").alias("component", "variance"))  # DIM rows
    tot = F.sum("variance").over(Window.partitionBy())
    run = F.sum("variance").over(Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0))
    return vv.select("component", F.round("variance", 9).alias("variance"),
                     F.round(F.col("variance") / tot, 9).alias("ratio"),
                     F.round(run / tot, 9).alias("cumulative"))
