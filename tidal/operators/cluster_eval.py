"""Internal and external clustering metrics without pairwise joins.

Per-cluster sufficient statistics (size n_C, vector sum S_C, sum of squared
norms Q_C) are one partial aggregation, K x D numbers in total. Every
point-to-cluster mean squared distance follows from them exactly:
sum_{y in C} |x - y|^2 = n_C |x|^2 - 2 x.S_C + Q_C, so silhouettes cost
O(n K) and never emit point pairs. Euclidean distances have no such
identity: there every point meets every other one, block by block, and only
the sums by cluster leave a task. That is quadratic in the points, in time
alone: a task holds one block of either side. External metrics come from the
small (cluster x class) contingency table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import vectors as VX
from ..session import ensure_checkpoint_dir, ship_package
from . import kmeans as KM

#: Rows of a block: Euclidean mean distances are measured block against block,
#: all blocks against all.
SAMPLE = 4096
#: Rows that a partition holds on average, at least, before partitions are joined.
ROWS = 512
#: Points whose distances to a block are held at once: they stay in the processor's cache.
NEAR = 64


def cluster_stats(points: DataFrame, feat: str, cluster_col: str, dim: int) -> list[dict]:
    """[{cluster, n, s (sum vector), q (sum of |x|^2)}] — K rows to the driver."""
    x = F.col(feat)
    g = points.groupBy(cluster_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(x[i]) for i in range(dim)]).alias("s"),
        F.sum(VX.sq_norm(feat, dim)).alias("q"))
    return sorted(({"cluster": r[cluster_col], "n": r["n"], "s": list(r["s"]), "q": r["q"]}
                   for r in g.collect()), key=lambda d: d["cluster"])


def mean_sq_dist_to_clusters(points: DataFrame, feat: str, cluster_col: str, stats: list[dict],
                             dim: int) -> DataFrame:
    """Adds ``msd``: ARRAY over clusters of the mean squared distance from
    the point to the other members of that cluster (own cluster excludes
    the point itself; NULL for a singleton's own cluster)."""
    xx = VX.sq_norm(feat, dim)
    items = []
    for st in stats:
        total = F.lit(float(st["n"])) * xx - 2 * VX.dot(feat, st["s"]) + F.lit(float(st["q"]))
        own = F.col(cluster_col) == F.lit(st["cluster"])
        denom = F.when(own, F.lit(st["n"] - 1)).otherwise(F.lit(st["n"]))
        items.append(F.when(denom > 0, F.greatest(total, F.lit(0.0)) / denom))
    return points.withColumn("msd", F.array(*items))


def silhouette_samples(points: DataFrame, feat: str, cluster_col: str, dim: int,
                       stats: list[dict] | None = None) -> DataFrame:
    """Per-point silhouette (b - a) / max(a, b) with squared Euclidean
    distances; 0 for members of singleton clusters."""
    stats = stats or cluster_stats(points, feat, cluster_col, dim)
    ids = [s["cluster"] for s in stats]
    p = mean_sq_dist_to_clusters(points, feat, cluster_col, stats, dim)
    pos = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col(cluster_col)).cast("int")
    a = F.element_at("msd", pos)
    others = F.filter(F.arrays_zip(F.col("msd").alias("m"),
                                   F.array(*[F.lit(i) for i in ids]).alias("c")),
                      lambda z: z["c"] != F.col(cluster_col))
    b = F.array_min(F.transform(others, lambda z: z["m"]))
    s = F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return p.withColumn("a", a).withColumn("b", b).withColumn("silhouette", s).drop("msd")


def silhouette_sq_summary(points: DataFrame, feat: str, cluster_col: str, dim: int) -> float:
    s = silhouette_samples(points, feat, cluster_col, dim)
    return float(s.agg(F.avg("silhouette")).first()[0])


# --- Euclidean distances, all points against all ------------------------------------

class _Block:
    """Points that others are measured against, ready for one product."""

    def __init__(self, y: np.ndarray):
        self.y, self.mean = y, y.mean(0)
        z = y - self.mean
        self.norm = np.square(z).sum(1)
        self.plane = np.vstack([-2.0 * z.T, self.norm, np.ones(len(z))])


def _distances(x: np.ndarray, block: _Block) -> np.ndarray:
    """Euclidean distances; those of near points are taken from the
    differences, as the product form cancels there."""
    z = x - block.mean
    a, b = np.square(z).sum(1), block.norm
    d = np.column_stack([z, np.ones(len(z)), a]) @ block.plane
    np.maximum(d, 0.0, out=d)
    near = 1e-6 * (a.max() + b.max()) if d.size else 0.0
    if d.size and not d.min() > near:
        i, j = np.nonzero(d <= near)
        close = d[i, j] <= 1e-6 * (a[i] + b[j])
        i, j = i[close], j[close]
        for k in range(0, len(i), 16 * KM.BATCH):
            r, c = i[k:k + 16 * KM.BATCH], j[k:k + 16 * KM.BATCH]
            d[r, c] = np.square(x[r] - block.y[c]).sum(1)
    return np.sqrt(d, out=d)


def _distance_sums(x: np.ndarray, y: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Summed distances of the points to the members (the columns of 0 and 1)
    of ``y``. Neighbours in ``y`` with the same memberships are added up
    first, so points in the order of their clusters cost least."""
    none = np.zeros((0, member.shape[1]))
    if not len(y):
        return np.zeros((len(x), member.shape[1]))
    first = np.flatnonzero(np.append(True, (member[1:] != member[:-1]).any(1)))
    block, groups = _Block(y), member[first]
    return np.concatenate([none, *[np.add.reduceat(_distances(x[at:at + NEAR], block), first, axis=1) @ groups
                                   for at in range(0, len(x), NEAR)]])


def _membership(own: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Columns of 0 and 1 for the clusters of every model; a row of ``own``
    is a model's, -1 a point without cluster."""
    return np.concatenate([np.eye(k + 1, k)[o] for o, k in zip(own, sizes)], axis=1)


def _all_pairs(rows: RDD, cols: RDD, sizes: list[int], finish: Callable) -> RDD:
    """``finish(block, sums)`` of every block of ``rows``: the summed distances
    of its points to the members of every cluster, from all blocks of ``cols``.
    A block is (its number in the partition, points, their clusters in every
    model, anything else). Every task reads all of ``cols``, a block at a time."""
    total = cols.count()

    def run(pairs):
        held = {}
        for block, (_, y, own, _) in pairs:
            seen, sums = held.get(block[0], (0, 0.0))
            held[block[0]] = seen + 1, sums + _distance_sums(block[1], y, _membership(own, sizes))
            if seen + 1 == total:
                yield finish(block, held.pop(block[0])[1])

    return rows.cartesian(cols.coalesce(1)).mapPartitions(run)


def _dealt(points: DataFrame, n: int) -> DataFrame:
    """``n`` points in at least as many partitions as there are cores, and in
    no more than hold ``ROWS`` each: all tasks measure alike, no block is tiny."""
    cores, parts = points.sparkSession.sparkContext.defaultParallelism, points.rdd.getNumPartitions()
    most = max(cores, -(-n // ROWS))
    return points.repartition(cores) if parts < cores else points.coalesce(most) if parts > most else points


def _means(sums: np.ndarray, counts: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Mean distance to each cluster; a point is not its own neighbour (-1: in
    no cluster)."""
    n, inside = np.tile(np.asarray(counts, float), (len(sums), 1)), own >= 0
    n[np.flatnonzero(inside), own[inside]] -= 1
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, sums / n, np.nan)


def _silhouettes(means: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, (b - a) / max(a, b)); 0 where a or b has no member."""
    rows = np.arange(len(means))
    a = means[rows, own]
    others = means.copy()
    others[rows, own] = np.nan
    b = np.where(np.isnan(others).all(1), np.nan, np.nanmin(np.where(np.isnan(others), np.inf, others), axis=1, initial=np.inf))
    top = np.fmax(a, b)
    s = np.where(np.isnan(a) | np.isnan(b) | ~(top > 0), 0.0, (b - a) / np.where(top > 0, top, 1.0))
    return a, b, s


def mean_distances(points: DataFrame, key: str, feat: str, cluster_col: str, sample: int = SAMPLE) -> DataFrame:
    """Adds ``md``: an ARRAY of (cluster, mean Euclidean distance to its other
    members, NULL without any), and the silhouette parts ``a``, ``b`` and
    ``silhouette``. Distances are measured against all members, ``sample``
    rows of them at a time, and every row is a point of its own, whatever its
    ``key``. Rows without a whole vector are no members and have no distances.

    The result is written once to the checkpoint folder."""
    spark = points.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    x = F.col(feat).cast("array<double>")
    frame = points.withColumn("_x", F.when(x.isNotNull() & ~F.exists(x, lambda v: v.isNull()), x)) \
        .withColumn("_c", F.col(cluster_col).cast("int")).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r["_c"]: r["n"] for r in frame.groupBy("_c").agg(F.count("_x").alias("n"), F.count(F.lit(1)).alias("rows")).collect()}
    ids = sorted(c for c, n in sizes.items() if c is not None and n)
    counts, place = [sizes[c] for c in ids], {c: i for i, c in enumerate(ids)}

    def cells(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, sample):
                part = pa.Table.from_batches([batch.slice(at, sample)]).combine_chunks().to_batches()[0]
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["cell"])

    def read(cell):
        return pa.ipc.open_stream(bytes(cell)).read_next_batch()

    def block(number, cell):
        """The whole vectors of a cell, in the order of their clusters, and the rows they stand in."""
        batch = read(cell)
        vectors, c = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        at = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        own = np.array([place.get(v, -1) for v in c.to_pylist()], np.int64)[at]
        by = np.argsort(own, kind="stable")
        at, vectors = at[by], vectors.take(pa.array(at[by]))
        lengths = np.unique(vectors.value_lengths().to_numpy(zero_copy_only=False))
        if len(lengths) > 1:
            raise ValueError(f"vectors of different lengths: {lengths.tolist()}")
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        return number, values.reshape(len(at), -1) if len(at) else np.zeros((0, 0)), own[by][None], (at, cell)

    def finish(block, sums):
        (own,), (at, cell) = block[2], block[3]
        m = _means(sums, counts, own)
        a, b, s = _silhouettes(m, np.maximum(own, 0))
        a, b, s = np.where(own < 0, np.nan, a), np.where(own < 0, np.nan, b), np.where(own < 0, 0.0, s)
        batch = read(cell)
        n, k = batch.num_rows, len(ids)
        full = [np.full((n, k), np.nan), np.full(n, np.nan), np.full(n, np.nan), np.zeros(n)]
        for to, part in zip(full, (m, a, b, s)):
            to[at] = part
        none = lambda v: pa.array(v, pa.float64(), mask=np.isnan(v))
        pairs = pa.StructArray.from_arrays([pa.array(np.tile(np.array(ids, np.int32), n)), none(full[0].reshape(-1))], ["c", "m"])
        md = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pairs)
        columns = [*batch.columns[:-2], md, none(full[1]), none(full[2]), pa.array(full[3])]
        out = pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "md", "a", "b", "silhouette"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, out.schema) as to:
            to.write_batch(out)
        return (bytearray(sink.getvalue().to_pybytes()),)

    packed = _dealt(frame, sum(sizes.values())).mapInArrow(cells, "cell binary").rdd
    rows = packed.mapPartitions(lambda rs: (block(i, r[0]) for i, r in enumerate(rs))).persist(StorageLevel.MEMORY_AND_DISK)
    cols = rows.filter(lambda b: len(b[1])).map(lambda b: (*b[:3], None)).persist(StorageLevel.MEMORY_AND_DISK)
    kind = ST.StructType([*points.schema.fields, *ST.StructType.fromDDL(
        "md array<struct<c:int,m:double>>, a double, b double, silhouette double").fields])
    out = spark.createDataFrame(_all_pairs(rows, cols, [len(ids)], finish), "cell binary") \
        .mapInArrow(lambda batches: (read(c) for batch in batches for c in batch.column(0).to_pylist()), kind).checkpoint()
    for held in (rows, cols, frame):
        held.unpersist()
    return out


def silhouette(points: DataFrame, key: str, feat: str, cluster_col: str, sample: int = SAMPLE) -> DataFrame:
    """Per-point Euclidean silhouette with a and b."""
    return mean_distances(points, key, feat, cluster_col, sample).drop("md")


def silhouette_summary(points: DataFrame, key: str, feat: str, cluster_col: str, sample: int = SAMPLE) -> float:
    return float(silhouette(points, key, feat, cluster_col, sample).agg(F.avg("silhouette")).first()[0] or 0.0)


def curve_silhouettes(vectors: DataFrame, centers: list[np.ndarray], sample: int = SAMPLE) -> list[tuple[float, float]]:
    """(Euclidean, squared) mean silhouette of the column ``x`` for several
    sets of centres at once: the distances of all points to all points are
    computed once and serve all of them, ``sample`` rows of either side at a
    time."""
    ship_package(vectors.sparkSession)
    dim, n_models, sizes = centers[0].shape[1], len(centers), [len(c) for c in centers]
    points = _dealt(vectors, vectors.count())
    mean, _ = KM.mean_and_variance(KM.in_matrices(points), dim)
    models = [KM.Model(len(c), 0, c) for c in centers]
    n, cost, sums = KM.group_sums(vectors, models, mean)
    cut = np.cumsum(sizes)[:-1]
    ns, ss = np.split(n, cut), np.split(sums, cut)
    # sum of squared norms of a cluster: its cost about the centre, moved to the mean
    qs = [c + 2 * ((m - mean) * s).sum(1) - k * np.square(m - mean).sum(1)
          for c, m, s, k in zip(np.split(cost, cut), centers, ss, ns)]

    def blocks(matrices):
        """Blocks of ``sample`` points in the order of their clusters in all models."""
        held, number = [], 0
        for part in matrices:
            held.append(part)
            while sum(map(len, held)) >= sample:
                whole = np.concatenate(held)
                yield block(number, whole[:sample])
                held, number = [whole[sample:]], number + 1
        if sum(map(len, held)):
            yield block(number, np.concatenate(held))

    def block(number, x):
        own = np.stack([KM.squared_distances(x - mean, c - mean).argmin(1) for c in centers])
        by = np.lexsort(own)
        return number, x[by], own[:, by], None

    def finish(block, sums):
        _, x, own, _ = block
        z = x - mean
        norm, sums_to, total = np.square(z).sum(1)[:, None], np.split(sums, cut, axis=1), np.zeros((n_models, 3))
        for k in range(n_models):
            s = _silhouettes(_means(sums_to[k], counts[k], own[k]), own[k])[2]
            all_ = np.maximum(ns[k] * norm - 2 * z @ ss[k].T + qs[k], 0.0)
            s2 = _silhouettes(_means(all_, ns[k], own[k]), own[k])[2]
            total[k] = s.sum(), s2.sum(), len(x)
        return total

    dealt = KM.in_matrices(points).mapPartitions(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = np.split(dealt.map(lambda b: _membership(b[2], sizes).sum(0)).treeReduce(np.add), cut)
        total = _all_pairs(dealt, dealt, sizes, finish).treeReduce(np.add)
    finally:
        dealt.unpersist()
    return [(s / n, s2 / n) for s, s2, n in total.tolist()]


def centroids_from_stats(stats: list[dict]) -> dict:
    return {s["cluster"]: [v / s["n"] for v in s["s"]] for s in stats}


def distance_to_own_centroid(points: DataFrame, feat: str, cluster_col: str, cents: dict) -> DataFrame:
    """Adds ``sq_dist_own`` (squared distance to the point's cluster mean)."""
    dim = len(next(iter(cents.values())))
    e = None
    for cid, c in cents.items():
        d = VX.sq_dist(feat, c, dim)
        e = F.when(F.col(cluster_col) == cid, d) if e is None else e.when(F.col(cluster_col) == cid, d)
    return points.withColumn("sq_dist_own", e)


def inertia(points: DataFrame, feat: str, cluster_col: str, dim: int) -> DataFrame:
    cents = centroids_from_stats(cluster_stats(points, feat, cluster_col, dim))
    return distance_to_own_centroid(points, feat, cluster_col, cents).agg(
        F.sum("sq_dist_own").alias("inertia"))


def calinski_harabasz(points: DataFrame, feat: str, cluster_col: str, dim: int) -> DataFrame:
    """(B/(k-1)) / (W/(n-k)) with cluster means; 1.0 when W = 0."""
    stats = cluster_stats(points, feat, cluster_col, dim)
    cents = centroids_from_stats(stats)
    n = sum(s["n"] for s in stats)
    k = len(stats)
    mu = [sum(s["s"][i] for s in stats) / n for i in range(dim)]
    between = sum(s["n"] * sum((cents[s["cluster"]][i] - mu[i]) ** 2 for i in range(dim)) for s in stats)
    w = distance_to_own_centroid(points, feat, cluster_col, cents).agg(
        F.sum("sq_dist_own").alias("W"))
    return w.select(F.when(F.col("W") == 0, F.lit(1.0)).otherwise(
        F.lit(between / max(k - 1, 1)) / (F.col("W") / F.lit(float(n - k)))).alias("calinski_harabasz"))


def per_cluster_cohesion(points: DataFrame, feat: str, cluster_col: str, cents: dict) -> DataFrame:
    """(cluster, size, cohesion = mean Euclidean distance to the centroid)."""
    d = distance_to_own_centroid(points, feat, cluster_col, cents)
    return d.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("size"),
                                      F.avg(F.sqrt("sq_dist_own")).alias("cohesion"))


def centroid_pairs(cents: dict) -> list[tuple]:
    """(i, j, distance) for every ordered pair of distinct centroids: K^2
    numbers computed from the K fitted vectors."""
    out = []
    for i, a in cents.items():
        for j, b in cents.items():
            if i != j:
                out.append((i, j, math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))))
    return out


def davies_bouldin(points: DataFrame, feat: str, cluster_col: str, dim: int) -> DataFrame:
    """mean over i of max over j != i of (s_i + s_j) / d_ij."""
    stats = cluster_stats(points, feat, cluster_col, dim)
    cents = centroids_from_stats(stats)
    coh = per_cluster_cohesion(points, feat, cluster_col, cents)
    pairs = points.sparkSession.createDataFrame(
        centroid_pairs(cents), f"i int, j int, d double")
    ci = coh.select(F.col(cluster_col).cast("int").alias("i"), F.col("cohesion").alias("si"))
    cj = coh.select(F.col(cluster_col).cast("int").alias("j"), F.col("cohesion").alias("sj"))
    r = pairs.join(ci, "i").join(cj, "j").filter(F.col("d") > 0) \
        .withColumn("r", (F.col("si") + F.col("sj")) / F.col("d"))
    return r.groupBy("i").agg(F.max("r").alias("ri")).agg(F.avg("ri").alias("davies_bouldin"))


def cluster_quality(points: DataFrame, key: str, feat: str, cluster_col: str, dim: int) -> DataFrame:
    """Per cluster: size, mean Euclidean and squared silhouette, cohesion, separation (nearest
    other centroid; +infinity with a single cluster)."""
    stats = cluster_stats(points, feat, cluster_col, dim)
    cents = centroids_from_stats(stats)
    sq = silhouette_samples(points, feat, cluster_col, dim, stats).groupBy(cluster_col).agg(
        F.avg("silhouette").alias("silhouette_sq_avg"))
    sil = silhouette(points, key, feat, cluster_col).groupBy(cluster_col).agg(F.avg("silhouette").alias("silhouette_avg")) \
        .join(sq, cluster_col)
    coh = per_cluster_cohesion(points, feat, cluster_col, cents)
    sep = {}
    for i, j, d in centroid_pairs(cents):
        sep[i] = min(sep.get(i, float("inf")), d)
    sep_df = points.sparkSession.createDataFrame(
        [(int(c), float(sep.get(c, float("inf")))) for c in cents], f"{cluster_col} int, separation double")
    return coh.join(sil, cluster_col).join(sep_df, cluster_col)


# --- external metrics from the contingency table ---------------------------------

def contingency(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """(pred, truth, count, row_share): counts and shares within each predicted cluster."""
    c = df.groupBy(pred, truth).agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn("row_share", F.col("count") / F.sum("count").over(Window.partitionBy(pred)))


def _comb2(c):
    return c * (c - 1) / 2.0


def external_metrics(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """ARI, NMI (arithmetic), homogeneity, completeness, V-measure, purity.

    One aggregation over the contingency cells (K x classes rows). Per-cluster
    and per-class terms f(a_i) are summed over cells as f(a_i) * n_ij / a_i,
    which adds up to f(a_i) once per cluster."""
    c = df.groupBy(pred, truth).agg(F.count(F.lit(1)).cast("double").alias("nij"))
    a = c.groupBy(pred).agg(F.sum("nij").alias("ai"), F.max("nij").alias("mi"))
    b = c.groupBy(truth).agg(F.sum("nij").alias("bj"))
    cell = c.join(a, pred).join(b, truth)
    wa = F.col("nij") / F.col("ai")
    wb = F.col("nij") / F.col("bj")
    r = cell.agg(
        F.sum("nij").alias("n"),
        F.sum(_comb2(F.col("nij"))).alias("sum_ij"),
        F.sum(F.col("nij") * F.log(F.col("nij"))).alias("nlogn_ij"),
        F.sum(F.col("nij") * (F.log(F.col("ai")) + F.log(F.col("bj")))).alias("nlog_ab"),
        F.sum(_comb2(F.col("ai")) * wa).alias("sum_a"),
        F.sum(F.col("nij") * F.log(F.col("ai"))).alias("alog"),
        F.sum(F.col("mi") * wa).alias("sum_max"),
        F.sum(_comb2(F.col("bj")) * wb).alias("sum_b"),
        F.sum(F.col("nij") * F.log(F.col("bj"))).alias("blog"),
        F.count_distinct(pred).alias("n_pred"), F.count_distinct(truth).alias("n_true"))
    n = F.col("n")
    expected = F.col("sum_a") * F.col("sum_b") / _comb2(n)
    mx = (F.col("sum_a") + F.col("sum_b")) / 2
    ari = F.when(mx == expected, F.lit(1.0)).otherwise((F.col("sum_ij") - expected) / (mx - expected))
    # entropies (natural log): H = ln n - sum(c ln c) / n
    h_pred = F.log(n) - F.col("alog") / n
    h_true = F.log(n) - F.col("blog") / n
    mi = F.greatest(F.lit(0.0), (F.col("nlogn_ij") - F.col("nlog_ab")) / n + F.log(n))
    hom = F.when(h_true > 0, mi / h_true).otherwise(F.lit(1.0))
    com = F.when(h_pred > 0, mi / h_pred).otherwise(F.lit(1.0))
    v = F.when(hom + com > 0, 2 * hom * com / (hom + com)).otherwise(F.lit(0.0))
    nmi = F.when((F.col("n_pred") == 1) & (F.col("n_true") == 1), F.lit(1.0)).otherwise(
        mi / F.greatest((h_true + h_pred) / 2, F.lit(2.220446049250313e-16)))
    return r.select(ari.alias("adjusted_rand"), nmi.alias("nmi"), hom.alias("homogeneity"),
                    com.alias("completeness"), v.alias("v_measure"),
                    (F.col("sum_max") / n).alias("purity"))
