"""Hard negatives by threshold joins over an inverted index with norm bounds.

Every task indexes its vectors block by block. The index keeps, for each group
of dimensions, the rows in descending order of the norm of what follows from
there on (the suffix norm). For an anchor and a threshold, a row's dimensions
are left out of the index from the group on at which the row's suffix norm
times the anchor's can't reach the threshold any more: they are the tail of
that group's list. Partial scores are accumulated over what is indexed; pairs
whose partial score plus the remaining norms stays below the threshold are
pruned; the others are verified with whole integer products. Thresholds start
high and are lowered until every window is full or its lower end is reached.

A component x counts as floor(scale * x), so scores are exact integers. A
positive is one of the anchor's ``n_pos`` best other rows of its label; its
negatives are the ``n_neg`` best rows of other labels with
``low * positive_score <= 100 * negative_score <= high * positive_score``.

Anchors go in slices of ``ANCHOR_BYTES`` against all rows; a task holds one
block of rows and the best rows of a slice's anchors.

Defined cases: rows with a null id, label, vector or component, or one that is
not finite, take no part, neither do vectors whose integer squared norm
exceeds 2**62 (their scores are no 64-bit integers); missing components of a
shorter vector are 0; a row with the anchor's own id is the anchor, not its
positive or negative; equal anchor rows count once, equal other rows each;
ties go to the smaller id; an anchor without positives has no rows. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted

SCALE, N_POS, N_NEG, LOW, HIGH = 256, 5, 10, 30, 90
ANCHOR_BYTES = 16_000_000
BLOCK_ROWS, BLOCK_BYTES = 16_384, 32_000_000
ROWS_PER_TASK = 8_192
GROUP = 128
GROUPS_OF_DIMENSIONS = 8
VERIFY = 65_536
#: Bounds are kept this much too high, against rounding.
SLACK = 1 + 1e-9


def usable(df: DataFrame, id_col: str, vec_col: str, label: Column, anchor: Column) -> DataFrame:
    """(id, label, vec, anchor) of the rows that take part."""
    vec = F.col(quoted(vec_col)).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col(quoted(id_col)).isNotNull() & label.isNotNull() & vec.isNotNull() & ~F.coalesce(bad, F.lit(False))) \
        .select(F.col(quoted(id_col)).cast("long").alias("id"), label.cast("long").alias("label"), vec.alias("vec"),
                F.coalesce(anchor, F.lit(False)).alias("anchor"))


def matrix(values: np.ndarray, sizes: np.ndarray, width: int, scale: float):
    """Integer rows of ``width`` components (shorter ones padded with 0) and
    which of them are small enough."""
    whole = np.floor(values * scale)
    row = np.repeat(np.arange(len(sizes)), sizes)
    ok = np.bincount(row, weights=np.square(whole), minlength=len(sizes)) <= 2.0 ** 62
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = ok[row] & (at < width)
    out = np.zeros((len(sizes), width), np.int64)
    out[row[keep], at[keep]] = whole[keep].astype(np.int64)
    return out, ok


def suffix_norms(x: np.ndarray, edges: list[int]) -> np.ndarray:
    """The norm of each row from every edge on (0 after the last)."""
    squares = np.square(x.astype(np.float64))
    parts = [squares[:, a:b].sum(1) for a, b in zip(edges, edges[1:])]
    return np.sqrt(np.stack([np.sum(parts[c:], axis=0) for c in range(len(parts))] + [np.zeros(len(x))], 1)) * SLACK


class Anchors:
    """A slice of anchors, dimensions in descending order of their energy."""

    def __init__(self, ids, labels, x):
        self.ids, self.labels = ids, labels
        self.order = np.argsort(-np.square(x.astype(np.float64)).sum(0), kind="stable")
        self.x = np.ascontiguousarray(x[:, self.order])
        width = x.shape[1]
        step = max(1, -(-width // GROUPS_OF_DIMENSIONS))
        self.edges = [*range(0, width, step), width] if width else [0, 0]
        self.norms = suffix_norms(self.x, self.edges)


class Block:
    """The index of a block of rows."""

    def __init__(self, ids, labels, y, edges):
        self.ids, self.labels, self.y, self.edges = ids, labels, y, edges
        self.norms = suffix_norms(y, edges)
        self.lists = [np.argsort(-self.norms[:, c], kind="stable") for c in range(len(edges) - 1)]
        self.sorted = [self.norms[o, c] for c, o in enumerate(self.lists)]
        self.parts = [np.ascontiguousarray(y[o][:, a:b].astype(np.float64))
                      for o, a, b in zip(self.lists, edges, edges[1:])]

    def pairs(self, x, norms, least):
        """(anchor, row, score) of all pairs with score >= ``least``."""
        score = np.zeros((len(x), len(self.ids)))
        left = np.zeros((len(self.ids), 1), np.int64)  # first group of dimensions not in a row's index
        for c, order in enumerate(self.lists):
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(least > 0, least / norms[:, c], -np.inf).min()
            n = len(order) if need <= 0 else int(np.searchsorted(-self.sorted[c], -need, side="right"))
            if n == 0:
                break
            part = x[:, self.edges[c]:self.edges[c + 1]].astype(np.float64)
            rows = order[:n]
            score[:, rows] += part @ self.parts[c][:n].T
            left[rows, 0] = c + 1
        rest = np.take_along_axis(self.norms, left, 1)[:, 0]
        ahead = norms[:, left[:, 0]] * rest
        slack = 1 + 1e-9 * norms[:, :1] * self.norms[None, :, 0]
        a, r = np.nonzero(score + ahead + slack >= least[:, None])
        whole = np.empty(len(a), np.int64)
        for k in range(0, len(a), VERIFY):
            s = slice(k, k + VERIFY)
            whole[s] = np.einsum("ij,ij->i", x[a[s]], self.y[r[s]])
        keep = whole >= least[a]
        return a[keep], r[keep], whole[keep]


def best(scores, ids, k):
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def extended(held, scores, ids, k):
    return best(np.concatenate([held[0], scores]), np.concatenate([held[1], ids]), k)


def blocks(batches, anchors: Anchors, scale: float):
    """Indexed blocks of the rows of a task."""
    width = len(anchors.order)
    rows = max(256, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, width))))
    held: list = []

    def block():
        ids, labels, y = (np.concatenate([h[k] for h in held]) for k in range(3))
        return Block(ids, labels, np.ascontiguousarray(y[:, anchors.order]), anchors.edges)

    n = 0
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            vec = batch.column(2)
            y, ok = matrix(vec.flatten().to_numpy(), np.diff(vec.offsets.to_numpy()), width, scale)
            held.append((batch.column(0).to_numpy()[ok], batch.column(1).to_numpy()[ok], y[ok]))
            n += int(ok.sum())
            if n >= rows:
                yield block()
                held, n = [], 0
    if n:
        yield block()


NONE = (np.empty(0, np.int64), np.empty(0, np.int64))


def _by_anchor(block: Block, anchors: Anchors, which: np.ndarray, least: np.ndarray):
    """For every anchor of ``which`` its rows with score >= ``least``."""
    for k in range(0, len(which), GROUP):
        w, t = which[k:k + GROUP], least[k:k + GROUP]
        a, r, s = block.pairs(anchors.x[w], anchors.norms[w], t)
        cut = np.searchsorted(a, np.arange(len(w) + 1))
        for i, at in enumerate(w):
            yield at, r[cut[i]:cut[i + 1]], s[cut[i]:cut[i + 1]]


def task_positives(batches, anchors: Anchors, n_pos: int, scale: float):
    """The ``n_pos`` best other rows of each anchor's label in a task."""
    held = [NONE] * len(anchors.ids)
    for block in blocks(batches, anchors, scale):
        largest = block.norms[:, 0].max()
        start = np.array([h[0][-1] if len(h[0]) == n_pos else np.inf for h in held])
        least = np.where(np.isinf(start), np.ceil(0.5 * anchors.norms[:, 0] * largest), start)
        todo, before = np.arange(len(held)), list(held)
        while len(todo):
            again = []
            for at, r, s in _by_anchor(block, anchors, todo, least[todo]):
                other = (block.labels[r] == anchors.labels[at]) & (block.ids[r] != anchors.ids[at])
                held[at] = extended(before[at], s[other], block.ids[r[other]], n_pos)
                if np.isfinite(least[at]) and (len(held[at][0]) < n_pos or held[at][0][-1] < least[at]):
                    again.append(at)
            least[again] = np.where(least[again] > 64, np.floor(least[again] / 2), -np.inf)
            todo = np.array(again, np.int64)
    return held


def task_negatives(batches, anchors: Anchors, positives: list[np.ndarray], n_neg: int, low: int, high: int, scale: float):
    """For each anchor and positive score the ``n_neg`` best rows of other
    labels within the window."""
    windows = [[(-((-low * p) // 100), (high * p) // 100) for p in ps.tolist()] for ps in positives]
    held = [[NONE] * len(w) for w in windows]
    some = np.array([a for a, w in enumerate(windows) if any(lo <= hi for lo, hi in w)], np.int64)

    def open_(at, least):
        """The windows that may miss rows below ``least``: the lowest score
        that they still need, or None."""
        need = [lo if len(h[0]) < n_neg else max(lo, int(h[0][-1])) for (lo, hi), h in zip(windows[at], held[at])
                if lo <= hi]
        return min((x for x in need if x < least), default=None)

    for block in blocks(batches, anchors, scale):
        least = np.empty(len(held))
        before = [list(h) for h in held]
        for at in some:
            full = [h[0][-1] for h, (lo, hi) in zip(held[at], windows[at]) if lo <= hi and len(h[0]) == n_neg]
            unfilled = [max(lo, 0.8 * hi) for h, (lo, hi) in zip(held[at], windows[at]) if lo <= hi and len(h[0]) < n_neg]
            least[at] = np.floor(min([*full, *unfilled]))
        todo = some
        while len(todo):
            again = []
            for at, r, s in _by_anchor(block, anchors, todo, least[todo]):
                other = (block.labels[r] != anchors.labels[at]) & (block.ids[r] != anchors.ids[at])
                ids, s = block.ids[r[other]], s[other]
                for j, (lo, hi) in enumerate(windows[at]):
                    inside = (s >= lo) & (s <= hi)
                    held[at][j] = extended(before[at][j], s[inside], ids[inside], n_neg)
                need = open_(at, least[at])
                if need is not None:
                    least[at] = max(need, np.floor(0.8 * least[at]) - 1) if least[at] > 0 else need
                    again.append(at)
            todo = np.array(again, np.int64)
    return held


def _ranked(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _slice_negatives(rows: DataFrame, anchors: Anchors, n_pos: int, n_neg: int, low: int, high: int, scale: float) -> DataFrame:
    spark = rows.sparkSession
    known = spark.sparkContext.broadcast(anchors)

    def positives(batches):
        held = task_positives(batches, known.value, n_pos, scale)
        a = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(np.concatenate([h[1] for h in held]), pa.int64()),
                                          pa.array(np.concatenate([h[0] for h in held]), pa.int64())], ["anchor", "id", "score"])

    # at most n_pos rows an anchor of the slice
    found = _ranked(rows.mapInArrow(positives, "anchor int, id long, score long"), ["anchor"], n_pos) \
        .select("anchor", "rank", "id", "score").collect()
    lists: list[list] = [[] for _ in anchors.ids]
    for r in sorted(found):
        lists[r["anchor"]].append((r["id"], r["score"]))
    chosen = spark.sparkContext.broadcast(lists)

    def negatives(batches):
        anchors, lists = known.value, chosen.value
        scores = [np.array([s for _, s in x], np.int64) for x in lists]
        held = task_negatives(batches, anchors, scores, n_neg, low, high, scale)
        out = [(a, j, int(anchors.ids[a]), *lists[a][j], int(i), int(s)) for a, ws in enumerate(held)
               for j, w in enumerate(ws) for s, i in zip(*w)]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)],
                                         ["anchor", "place", "anchor_id", "positive_id", "positive_score", "id", "score"])

    pairs = rows.mapInArrow(negatives, "anchor int, place int, anchor_id long, positive_id long, positive_score long, id long, score long")
    return _ranked(pairs, ["anchor", "place"], n_neg).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(df: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   n_pos: int = N_POS, n_neg: int = N_NEG, low: int = LOW, high: int = HIGH, scale: float = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows of ``df`` where ``anchor`` holds."""
    spark = df.sparkSession
    all_rows = usable(df, id_col, vec_col, label, anchor)
    asked = all_rows.where("anchor").select("id", "label", "vec").distinct()
    n, size = all_rows.agg(F.count("*"), F.sum(F.when(F.col("anchor"), 8 * F.size("vec")))).first()
    rows = all_rows.drop("anchor").coalesce(max(1, -(-n // ROWS_PER_TASK)))
    parts = 1 + (size or 0) // ANCHOR_BYTES
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for part in range(parts):
        mine = asked.where(F.pmod(F.xxhash64("id", "vec"), F.lit(parts)) == part).orderBy("id").toArrow()
        if not mine.num_rows:
            continue
        mine = mine.combine_chunks()
        vec = mine.column(2).chunk(0)
        sizes = np.diff(vec.offsets.to_numpy())
        x, ok = matrix(vec.flatten().to_numpy(), sizes, int(sizes.max()), scale)
        if not ok.any():
            continue
        anchors = Anchors(mine.column(0).to_numpy()[ok], mine.column(1).to_numpy()[ok], x[ok])
        out = out.unionByName(_slice_negatives(rows, anchors, n_pos, n_neg, low, high, scale))
    return out
