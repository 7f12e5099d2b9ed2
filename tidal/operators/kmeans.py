"""Many k-means models on one scan.

All (K, start) models advance together: a pass over the points assigns every
point to the nearest centre of every model, adds up the groups inside the task
and adds the groups (a few numbers a centre) over the tasks, as one
``lloyd_step`` does for one model. The points stay persisted as matrices; only
the centres travel. A model leaves the passes when its summed squared centre
shift falls below ``tol`` times the mean feature variance.

Hundreds of passes differ in the centres alone, so a pass is one RDD job over
the matrices: no plan is made, no column converted and no shuffle sorted for it.

Starts are k-means++: each next centre is a point drawn in proportion to its
squared distance to the centres so far, for all models in one pass (the point
with the largest ln(u) / d^2, an exact weighted draw that needs no gathering).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

BATCH = 4096
CELL = 512  # points a stored matrix
BLOCK = 256  # points whose distances to all centres stay in the processor's cache
DIRECT = 1 << 22  # bytes of partial results that are added without a stage between


@dataclass
class Model:
    k: int
    seed: int
    centers: np.ndarray
    inertia: float = float("inf")
    passes: int = 0


def matrices(batches, column: int = 0, rows: int = BATCH):
    """The vectors of Arrow batches as matrices of at most ``rows`` rows:
    from an array column or from the cells of :func:`in_cells`."""
    for whole in batches:
        if pa.types.is_binary(whole.schema.field(column).type):
            for cell, n in zip(whole.column(column), whole.column(column + 1).to_pylist()):
                yield whole, np.frombuffer(cell.as_buffer(), np.float64).reshape(n, -1)
            continue
        for at in range(0, whole.num_rows, rows):
            part = whole.slice(at, rows)
            values = part.column(column).flatten().to_numpy(zero_copy_only=False)
            yield part, values.reshape(part.num_rows, -1)


def in_cells(points: DataFrame) -> DataFrame:
    """The column ``x``, ``CELL`` points a row as bytes, in the same order and
    partitions: passes that read the points many times copy memory instead of
    converting every number."""
    def run(batches):
        for _, x in matrices(batches):
            cells = [np.ascontiguousarray(x[at:at + CELL], np.float64) for at in range(0, len(x), CELL)]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes() for c in cells], pa.binary()),
                                              pa.array([len(c) for c in cells], pa.int32())], ["cell", "n"])

    return points.mapInArrow(run, "cell binary, n int")


def in_matrices(points: DataFrame) -> RDD:
    """The points (column ``x`` or the cells of them) as matrices of at most
    ``CELL`` rows, in the same order and partitions."""
    cells = points if "cell" in points.columns else in_cells(points.select("x"))
    return cells.rdd.map(lambda r: np.frombuffer(r[0], np.float64).reshape(r[1], -1))


def _over(points: DataFrame | RDD, run: Callable, add: Callable, size: int):
    """``run(partition id, matrices)`` of every partition, about ``size`` bytes
    each, put together by ``add``: by the driver alone while the parts are
    small, else by tasks in between."""
    parts = (points if isinstance(points, RDD) else in_matrices(points)).mapPartitionsWithIndex(lambda i, xs: [run(i, xs)])
    n = parts.getNumPartitions()
    return parts.treeReduce(add, depth=1 if n * size <= DIRECT else 2) if n else run(0, [])


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    d = np.square(x).sum(1)[:, None] - 2.0 * x @ centers.T + np.square(centers).sum(1)[None, :]
    return np.maximum(d, 0.0)


def usable(points: DataFrame, feat: str) -> DataFrame:
    """The vectors without null components, as ``x``."""
    x = F.col(feat).cast("array<double>")
    return points.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull()))


def mean_and_variance(points: DataFrame | RDD, dim: int) -> tuple[np.ndarray, float]:
    """Mean vector and mean feature variance of the points, in one pass."""
    def joined(one, other):
        (n, mean, square), (m, mean_, square_) = one, other
        if not n or not m:
            return one if n else other
        apart = mean_ - mean
        return n + m, mean + apart * (m / (n + m)), square + square_ + np.square(apart) * (n * m / (n + m))

    def run(_, matrices_):
        total = 0, np.zeros(dim), np.zeros(dim)
        for x in matrices_:
            mean = x.mean(0)
            total = joined(total, (len(x), mean, np.square(x - mean).sum(0)))
        return total

    n, mean, square = _over(points, run, joined, 8 * (2 * dim + 1))
    return mean, float(np.mean(square)) / n if n else 0.0


def _offsets(models: list[Model]) -> np.ndarray:
    return np.cumsum([0] + [len(m.centers) for m in models])


def _runs(models: list[Model]) -> list[tuple[int, int, int]]:
    """(first centre, models, centres a model) of the neighbouring models
    with equally many centres: their distances are one block."""
    out, at = [], 0
    for m in models:
        k = len(m.centers)
        if out and out[-1][2] == k:
            out[-1] = (out[-1][0], out[-1][1] + 1, k)
        else:
            out.append((at, 1, k))
        at += k
    return out


def _side_by_side(runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The centres' numbers with the first centres of a run's models one after
    the other, then their second ones and so on: the least distance of a
    model is found by comparing whole rows of memory."""
    return np.concatenate([at + np.arange(r * k).reshape(r, k).T.reshape(-1) for at, r, k in runs])


def _nearest(near: np.ndarray, runs: list[tuple[int, int, int]], mark: np.ndarray) -> np.ndarray:
    """Marks, for every model and point (the columns), the first nearest
    centre (rows as :func:`_side_by_side`); returns the least value of every
    model and point."""
    least, n = [], near.shape[1]
    for at, r, k in runs:
        part, to = near[at:at + r * k].reshape(k, r, n), mark[at:at + r * k].reshape(k, r, n)
        low = np.minimum.reduce(part, axis=0)
        np.equal(part, low, out=to)
        if np.count_nonzero(to) != r * n:  # equally near centres, or not a number
            to[:] = part.argmin(0) == np.arange(k)[:, None, None]
        least.append(low)
    return np.concatenate(least)


def group_sums(points: DataFrame | RDD, models: list[Model], mean: np.ndarray,
               with_cost: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, cost, sums) for every centre of every model after one pass: the
    points nearest to it, their summed squared distance (zeros without
    ``with_cost``) and their vector sum. Vectors are counted from ``mean``,
    which keeps the arithmetic exact for data far from the origin.

    The centres of all models are one matrix: one product gives all distances
    of ``BLOCK`` points, another one all sums."""
    runs = _runs(models)
    order = _side_by_side(runs)
    centers = (np.concatenate([m.centers for m in models]) - mean)[order]
    plane = np.column_stack([-2.0 * centers, np.square(centers).sum(1)])

    def run(_, matrices_):
        cost, sums = np.zeros(len(centers)), np.zeros(plane.shape)
        for whole in matrices_:
            for at in range(0, len(whole), BLOCK):
                x = whole[at:at + BLOCK] - mean
                x = np.column_stack([x, np.ones(len(x))])
                near = plane @ x.T
                mark = np.empty(near.shape, bool)
                least = _nearest(near, runs, mark)
                inside = mark.astype(np.float64)
                sums += inside @ x
                if with_cost:
                    least, first = np.maximum(least + (np.square(x).sum(1) - 1.0), 0.0), 0
                    for a, r, k in runs:
                        part = inside[a:a + r * k].reshape(k, r, len(x)) * least[first:first + r]
                        cost[a:a + r * k] += part.sum(2).reshape(-1)
                        first += r
        return np.column_stack([sums, cost])

    total = _over(points, run, np.add, 8 * (plane.size + len(plane)))[np.argsort(order)]  # a few numbers a centre
    return total[:, -2], total[:, -1], total[:, :-2]


def starts(points: DataFrame | RDD, models: list[tuple[int, int]], dim: int) -> list[Model]:
    """k-means++ centres for every (K, seed): max(K) passes for all of them."""
    made = [Model(k, seed, np.empty((0, dim))) for k, seed in models]
    for step in range(max((k for k, _ in models), default=0)):
        due = [m for m in made if m.k > step]
        centers, runs = np.concatenate([m.centers for m in due]), _runs(due)
        seeds = [m.seed for m in due]

        def run(part, matrices_, centers=centers, runs=runs, seeds=seeds, step=step):
            draws = [np.random.default_rng([s, step, part]) for s in seeds]
            best, found = np.full(len(seeds), -np.inf), [None] * len(seeds)
            for x in matrices_:
                weight = np.ones((len(seeds), len(x)))
                for at in range(0, len(x) if step else 0, BLOCK):
                    d, first = squared_distances(centers, x[at:at + BLOCK]), 0
                    for a, r, k in runs:
                        weight[first:first + r, at:at + BLOCK] = d[a:a + r * k].reshape(r, k, -1).min(1)
                        first += r
                key = np.log(np.stack([rng.random(len(x)) for rng in draws]))
                with np.errstate(divide="ignore", invalid="ignore"):
                    key = np.where(weight > 0, key / weight, -np.finfo(float).max)
                at = key.argmax(1)
                top = key[np.arange(len(seeds)), at]
                for m in np.flatnonzero(top > best):
                    best[m], found[m] = top[m], x[at[m]].copy()
            return [(b, x) if x is not None else None for b, x in zip(best.tolist(), found)]

        def likelier(one, other):
            return [a if b is None or a is not None and a[0] >= b[0] else b for a, b in zip(one, other)]

        got = {m: f[1] for m, f in enumerate(_over(points, run, likelier, 8 * len(due) * (dim + 1))) if f}
        for m, model in enumerate(due):
            if m in got:
                model.centers = np.vstack([model.centers, got[m]])
    return made


def advance(points: DataFrame | RDD, models: list[Model], mean: np.ndarray, variance: float, max_iter: int, tol: float) -> list[Model]:
    """Lloyd passes until every model has settled; an empty cluster keeps its
    centre. The last pass gives the inertia of the final centres."""
    open_ = [m for m in models if len(m.centers)]
    for _ in range(max_iter):
        if not open_:
            break
        n, _, sums = group_sums(points, open_, mean, False)
        edges, still = _offsets(open_), []
        for m, a, b in zip(open_, edges[:-1], edges[1:]):
            count = n[a:b, None]
            new = np.where(count > 0, mean + sums[a:b] / np.maximum(count, 1.0), m.centers)
            shift = float(np.square(new - m.centers).sum())
            m.centers, m.passes = new, m.passes + 1
            if shift > tol * variance:
                still.append(m)
        open_ = still
    return with_inertia(points, models, mean)


def with_inertia(points: DataFrame | RDD, models: list[Model], mean: np.ndarray) -> list[Model]:
    done = [m for m in models if len(m.centers)]
    if done:
        _, cost, _ = group_sums(points, done, mean)
        for m, part in zip(done, np.split(cost, _offsets(done)[1:-1])):
            m.inertia = float(part.sum())
    return models


def advance_by_batches(points: DataFrame, models: list[Model], mean: np.ndarray, batches: int, epochs: int = 1) -> list[Model]:
    """Mini-batch updates: the points fall into ``batches`` parts by the
    column ``part``; one aggregate per part moves each centre by the mean of
    its new points with the learning rate new / (seen + new), seen being the
    points of the centre so far. Every point is visited ``epochs`` times."""
    seen = [np.zeros(len(m.centers)) for m in models]
    for _ in range(epochs):
        for part in range(batches):
            n, _, sums = group_sums(points.where(F.col("part") == part).select("x"), models, mean, False)
            edges = _offsets(models)
            for m, s, a, b in zip(models, seen, edges[:-1], edges[1:]):
                new = n[a:b]
                s += new
                rate = (1.0 / np.maximum(s, 1.0))[:, None]
                m.centers = m.centers + rate * (sums[a:b] + new[:, None] * (mean - m.centers))
                m.passes += 1
    return with_inertia(points.select("x"), models, mean)


def distance_bounds(points: DataFrame | RDD, models: list[np.ndarray]) -> list[tuple[float, float, float]]:
    """(inertia, least, largest distance to the nearest centre) of every set
    of centres, in one pass; distances come from the differences."""
    def run(_, matrices_):
        cost, low, high = np.zeros(len(models)), np.full(len(models), np.inf), np.full(len(models), -np.inf)
        for whole in matrices_:
            for at in range(0, len(whole), BLOCK):
                x = whole[at:at + BLOCK]
                for m, c in enumerate(models):
                    d = np.square(x - c[squared_distances(x, c).argmin(1)]).sum(1)
                    cost[m], low[m], high[m] = cost[m] + d.sum(), min(low[m], d.min()), max(high[m], d.max())
        return cost, low, high

    def joined(one, other):
        return one[0] + other[0], np.minimum(one[1], other[1]), np.maximum(one[2], other[2])

    cost, low, high = _over(points, run, joined, 24 * len(models))
    return [(float(c), float(np.sqrt(a)), float(np.sqrt(b))) for c, a, b in zip(cost, low, high)]


def best_of(models: list[Model]) -> dict[int, Model]:
    """The model with the smallest inertia for every K (ties: seed)."""
    best: dict[int, Model] = {}
    for m in sorted(models, key=lambda m: (m.inertia, m.seed)):
        best.setdefault(m.k, m)
    return best


def prepared(points: DataFrame, feat: str) -> tuple[DataFrame, int]:
    """The persisted vectors and their length (0 without any)."""
    from pyspark import StorageLevel
    ship_package(points.sparkSession)
    x = usable(points, feat).persist(StorageLevel.MEMORY_AND_DISK)
    first = x.first()
    return x, len(first["x"]) if first else 0
