"""k-means on Spark: assignment, recentring, fitting, K search, scoring.

Centroids are fitted state bounded by K x D; they travel as literal
vectors inside the expressions, so assigning points is a per-row
projection with no join and no shuffle. Fitting advances all starts (and,
in the search, all K) together, one scan and one aggregation a pass
(see ``kmeans.py``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as VX
from ..session import ship_package
from . import kmeans as KM

K_RANGE = (3, 10)
N_INIT = 10
MAX_ITER = 300
SEED = 42
SILHOUETTE_MARGIN = 0.05
TOL = 1e-4
MINI_BATCHES = 20


def initial_centroids_lowest_id(points: DataFrame, id_col: str, feat: str, k: int) -> list:
    """Deterministic start: the feature vectors of the ``k`` smallest ids
    (top-k per partition, then merged; only k rows reach the driver)."""
    rows = points.orderBy(id_col).limit(k).select(VX.as_double_array(feat).alias("f")).collect()
    return [list(r["f"]) for r in rows]


def _batch_distances(x: pa.Array, centers: np.ndarray) -> pa.Array:
    """The squared distances of every vector to all centres, added up
    dimension by dimension as :func:`VX.distances` does; nulls for a vector
    that is null, has a null component or another length."""
    k, dim = centers.shape
    n = len(x)
    out, sized = np.zeros((n, k)), pc.fill_null(pc.equal(pc.list_value_length(x), dim), False)
    flat = x.filter(sized).flatten().cast(pa.float64())
    usable = sized.to_numpy(zero_copy_only=False).copy()
    whole = pc.is_valid(flat).to_numpy(zero_copy_only=False).reshape(-1, dim).all(1)
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)[whole]
    usable[usable] = whole
    rows = np.flatnonzero(usable)
    for at in range(0, len(rows), KM.BLOCK):
        part = np.ascontiguousarray(values[at:at + KM.BLOCK].T)
        total = np.zeros((k, part.shape[1]))
        for j in range(dim):
            apart = part[j] - centers[:, j, None]
            total += apart * apart
        out[rows[at:at + KM.BLOCK]] = total.T
    flat_out = pa.array(out.reshape(-1), mask=np.repeat(~usable, k) if not usable.all() else None)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), flat_out)


def assign(points: DataFrame, feat: str, centers: list, cluster_col: str = "cluster") -> DataFrame:
    """Nearest centroid (first on ties) + squared and plain distance to it.
    Long vectors are measured in Arrow batches: the higher-order functions take
    some 0.2 ms a row for 25 dimensions and 10 centroids."""
    d = VX.distances(feat, centers)
    if len(centers) and len(centers[0]) > VX.UNROLL_DIM:
        ship_package(points.sparkSession)
        fixed = np.array(centers, float)
        d = F.arrow_udf(lambda x: _batch_distances(x, fixed), "array<double>")(F.col(feat))
    # non-nullable id (-1 only for rows without features): joins on the id
    # then infer no IS NOT NULL filter that would re-run the distances
    return (points.withColumn("_d", d)
            .withColumn(cluster_col, F.coalesce(VX.argmin("_d"), F.lit(-1)))
            .withColumn("sq_distance", F.array_min("_d"))
            .withColumn("distance", F.sqrt("sq_distance")).drop("_d"))


def centroid_distances(points: DataFrame, id_col: str, feat: str, centers: list) -> DataFrame:
    """Long (id, cluster, distance): the full point x centroid matrix."""
    d = F.transform(VX.distances(feat, centers), lambda x: F.sqrt(x))
    return points.select(id_col, F.posexplode(d).alias("cluster", "distance"))


def cluster_means(points: DataFrame, feat: str, cluster_col: str, dim: int) -> DataFrame:
    """Mean vector and size per cluster: D partial ``avg`` aggregates."""
    x = F.col(feat)
    return points.groupBy(cluster_col).agg(
        F.array(*[F.avg(x[i]) for i in range(dim)]).alias("centroid"),
        F.count(F.lit(1)).alias("size"))


def collect_centers(means: DataFrame, k: int, cluster_col: str = "cluster") -> list:
    """K centroid vectors ordered by cluster id (bounded by K x D); an empty
    cluster keeps no row and is returned as None."""
    got = {r[cluster_col]: list(r["centroid"]) for r in means.collect()}
    return [got.get(i) for i in range(k)]


def lloyd_step(points: DataFrame, feat: str, centers: list, cluster_col: str = "cluster"):
    """One assign + recentre step; an empty cluster keeps its old centroid."""
    a = assign(points, feat, centers, cluster_col)
    means = cluster_means(a, feat, cluster_col, len(centers[0]))
    new = collect_centers(means, len(centers), cluster_col)
    new = [n if n is not None else list(o) for n, o in zip(new, centers)]
    return a, new


@dataclass
class KMeansFit:
    centers: list
    inertia: float
    k: int
    seed: int
    train_min_distance: float = 0.0
    train_max_distance: float = 0.0
    history: list = field(default_factory=list)


def _renumber(centers: np.ndarray) -> list:
    """Canonical cluster ids: ascending centroid norm, then coordinates."""
    order = sorted(range(len(centers)), key=lambda i: (float(np.linalg.norm(centers[i])),
                                                       tuple(centers[i])))
    return [centers[i].tolist() for i in order]


def _finished(vectors: DataFrame | RDD, models: list[KM.Model]) -> list[KMeansFit]:
    """Centres in canonical order with the bounds of the distances, all models
    in one pass."""
    centers = [_renumber(m.centers) for m in models]
    bounds = KM.distance_bounds(vectors, [np.array(c) for c in centers])
    return [KMeansFit(c, cost, len(c), m.seed, lo, hi) for m, c, (cost, lo, hi) in zip(models, centers, bounds)]


def _fitted(vectors: DataFrame, dim: int, ks: list[int], n_init: int, max_iter: int, seed: int, tol: float) -> dict[int, KMeansFit]:
    from pyspark import StorageLevel
    points = KM.in_matrices(vectors).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mean, variance = KM.mean_and_variance(points, dim)
        models = KM.starts(points, [(k, s) for k in ks for s in range(seed, seed + n_init)], dim)
        best = KM.best_of(KM.advance(points, models, mean, variance, max_iter, tol))
        return dict(zip(sorted(best), _finished(points, [best[k] for k in sorted(best)])))
    finally:
        points.unpersist()


def kmeans_fit(points: DataFrame, feat: str, k: int, n_init: int = N_INIT, max_iter: int = MAX_ITER,
               seed: int = SEED, tol: float = TOL) -> KMeansFit:
    """Best of ``n_init`` k-means++ starts by training cost; all starts
    advance together on one persisted frame. Stops by the reference's rule:
    summed squared centre shift at most ``tol`` x mean feature variance."""
    vectors, dim = KM.prepared(points, feat)
    try:
        return _fitted(vectors, dim, [k], n_init, max_iter, seed, tol)[k]
    finally:
        vectors.unpersist()


def kmeans_minibatch(points: DataFrame, feat: str, k: int, n_init: int = N_INIT, batches: int = MINI_BATCHES,
                     seed: int = SEED) -> KMeansFit:
    """Mini-batch k-means: one visit of all points in ``batches`` random
    parts, per-centre counts as learning rates, one aggregate a part; the
    best of ``n_init`` starts by the cost over all points. On clustered data
    its inertia stays within 10 % of ``kmeans_fit`` (see the tests) for one
    scan instead of one per pass."""
    from pyspark import StorageLevel
    KM.ship_package(points.sparkSession)
    vectors = KM.usable(points, feat).withColumn("part", F.floor(F.rand(seed) * batches).cast("int")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = vectors.first()
        dim = len(first["x"])
        mean, _ = KM.mean_and_variance(vectors, dim)
        first = KM.in_matrices(vectors.where("part = 0") if vectors.where("part = 0").limit(k).count() == k
                               else vectors).persist(StorageLevel.MEMORY_AND_DISK)
        models = KM.starts(first, [(k, s) for s in range(seed, seed + n_init)], dim)
        first.unpersist()
        best = KM.best_of(KM.advance_by_batches(vectors, models, mean, batches))[k]
        return _finished(vectors.select("x"), [best])[0]
    finally:
        vectors.unpersist()


def anomaly_score(assigned: DataFrame, lo: float, hi: float, distance: str = "distance") -> Column:
    """Distance to own centroid min-max scaled with the *training* bounds,
    clamped to [0, 1]; 0 everywhere when the bounds coincide."""
    if hi > lo:
        s = (F.col(distance) - F.lit(lo)) / F.lit(hi - lo)
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), s))
    return F.lit(0.0)


def search(points: DataFrame, feat: str, k_range=K_RANGE, n_init: int = N_INIT, max_iter: int = MAX_ITER,
           seed: int = SEED, tol: float = TOL) -> tuple[DataFrame, dict[int, KMeansFit]]:
    """The (k, inertia, silhouette, silhouette_sq) curve and the best fit of
    every K. All K and starts advance together; both silhouettes of all K
    come from all points (``cluster_eval``), the Euclidean ones from all pairs."""
    from .cluster_eval import curve_silhouettes
    vectors, dim = KM.prepared(points, feat)
    try:
        fits = _fitted(vectors, dim, list(range(k_range[0], k_range[1] + 1)), n_init, max_iter, seed, tol)
        sil = curve_silhouettes(vectors, [np.array(f.centers) for f in fits.values()])
        rows = [(k, f.inertia, *s) for (k, f), s in zip(fits.items(), sil)]
    finally:
        vectors.unpersist()
    schema = "k int, inertia double, silhouette double, silhouette_sq double"
    return points.sparkSession.createDataFrame(rows, schema), fits


def k_search(points: DataFrame, feat: str, k_range=K_RANGE, n_init: int = N_INIT, max_iter: int = MAX_ITER,
             seed: int = SEED) -> DataFrame:
    """(k, inertia, silhouette, silhouette_sq) for every K, the best of
    ``n_init`` starts each."""
    return search(points, feat, k_range, n_init, max_iter, seed)[0]


def elbow_point(curve: DataFrame, k: str = "k", inertia: str = "inertia") -> DataFrame:
    """K farthest from the chord between the first and last points of the
    min-max normalised inertia curve (first K on ties / a flat curve).
    The curve has one row per K (bounded by the search range)."""
    from pyspark.sql import Window
    w = Window.partitionBy()
    kmin, kmax = F.min(k).over(w), F.max(k).over(w)
    imin, imax = F.min(inertia).over(w), F.max(inertia).over(w)
    kn = (F.col(k) - kmin) / (kmax - kmin)
    inr = F.when(imax - imin > 0, (F.col(inertia) - imin) / (imax - imin)).otherwise(F.col(inertia) - imin)
    c = curve.withColumn("kn", kn).withColumn("inn", inr)
    first = F.min_by("inn", k).over(w)
    last = F.max_by("inn", k).over(w)
    # p1 = (0, first), p2 = (1, last); |cross(p2 - p1, p1 - p)| / |p2 - p1|
    dx, dy = F.lit(1.0), last - first
    cross = F.abs(dx * (first - F.col("inn")) - dy * (F.lit(0.0) - F.col("kn")))
    c = c.withColumn("elbow_distance", cross / F.sqrt(dx * dx + dy * dy))
    return c.agg(F.min_by(k, F.struct(-F.col("elbow_distance"), F.col(k))).alias("elbow_k"))


def select_k(curve: DataFrame, k: str = "k", inertia: str = "inertia", sil: str = "silhouette",
             margin: float = SILHOUETTE_MARGIN) -> DataFrame:
    """Silhouette-best K if it beats the elbow K's silhouette by more than
    ``margin``, else the elbow K; with the reason."""
    e = elbow_point(curve, k, inertia)
    b = curve.agg(F.min_by(k, F.struct(-F.col(sil), F.col(k))).alias("best_silhouette_k"),
                  F.max(sil).alias("best_silhouette"))
    el = e.first()["elbow_k"]
    es = curve.filter(F.col(k) == el).agg(F.max(sil).alias("elbow_silhouette"))
    out = b.select("*", F.lit(el).alias("elbow_k"),
                   F.lit(es.first()["elbow_silhouette"]).alias("elbow_silhouette"))
    pick = F.col("best_silhouette") > F.col("elbow_silhouette") + F.lit(margin)
    return out.select("elbow_k", "best_silhouette_k",
                      F.when(pick, F.col("best_silhouette_k")).otherwise(F.col("elbow_k")).alias("selected_k"),
                      F.when(pick, F.lit("silhouette")).otherwise(F.lit("elbow")).alias("reason"))

