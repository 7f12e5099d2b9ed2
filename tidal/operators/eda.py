"""Exploratory aggregates: the tables behind the reference's charts and logs.

Each is one or two declarative aggregations. Windows only ever run over
already-aggregated rows (one per category), never over raw records.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def ALL_ROWS():
    """Whole-frame window, used only on grouped (per-category) rows."""
    return Window.partitionBy()


def value_counts_pct(df: DataFrame, col: str) -> DataFrame:
    """Count and percent of rows per value of ``col``."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return g.withColumn("pct", F.col("count") * 100.0 / F.sum("count").over(ALL_ROWS()))


def share_of_total(df: DataFrame, key: str, value: str) -> DataFrame:
    g = df.groupBy(key).agg(F.sum(value).alias("total"))
    return g.withColumn("pct", F.col("total") * 100.0 / F.sum("total").over(ALL_ROWS()))


def numeric_summary(df: DataFrame, cols: list[str], by: list[str] = (),
                    exact_median: bool = True) -> DataFrame:
    """mean, sample std, median, min, max per column (long form).

    ``exact_median`` uses Spark's exact percentile, whose buffer holds one
    count per distinct value: right for low-cardinality measures; pass False
    for continuous columns at scale (``percentile_approx``)."""
    aggs = []
    for c in cols:
        med = F.median(c) if exact_median else F.percentile_approx(c, 0.5, 10000)
        aggs.append(F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"),
                             F.stddev_samp(c).alias("std"), med.cast("double").alias("median"),
                             F.min(c).cast("double").alias("min"),
                             F.max(c).cast("double").alias("max"),
                             F.count(c).alias("n")).alias(f"_s_{c}"))
    g = df.groupBy(*by).agg(*aggs)
    arr = F.array(*[F.col(f"_s_{c}") for c in cols])
    return g.select(*by, F.inline(arr))


def dataset_profile(df: DataFrame, date_col: str, distinct_cols: list[str],
                    approx: bool = False) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("rows"), F.min(date_col).alias("first"),
            F.max(date_col).alias("last")]
    for c in distinct_cols:
        fn = F.approx_count_distinct if approx else F.count_distinct
        aggs.append(fn(c).alias(f"distinct_{c}"))
    return df.agg(*aggs)


def pivot_by(df: DataFrame, row: str, col: str, value: str, values: list) -> DataFrame:
    """Rows x category columns of summed values; ``values`` fixes the output
    columns (no extra distinct pass)."""
    return df.groupBy(row).pivot(col, values).agg(F.sum(value))


def value_range(df: DataFrame, col):
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def histogram(df: DataFrame, col, bins: int = 50, bounds=None) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed on the right and
    empty bins count 0. A constant column is one bin."""
    x = F.col(col) if isinstance(col, str) else col
    lo, hi = bounds or value_range(df.select(x.alias("_x")), "_x")
    if lo is None:
        return df.limit(0).select(F.lit(0).alias("bin"), F.lit(0.0).alias("lower"),
                                  F.lit(0.0).alias("upper"), F.lit(0).cast("long").alias("count"))
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    if hi > lo:
        b = F.least(F.lit(bins - 1), F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)))
    else:
        b = F.lit(0).cast("long")
    g = df.select(b.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    if hi > lo:  # empty bins too
        every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        g = every.join(g, "bin", "left").fillna(0, ["count"])
    return g.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), "count")


def box_stats(df: DataFrame, value: str, by: str, exact: bool = True,
              accuracy: int = 100000) -> DataFrame:
    """Quartiles (linear interpolation), 1.5 IQR whiskers at the most extreme
    points inside the fences, outlier count, per group.

    Pass 1: percentiles per group. Exact (``percentile``) keeps one count
    per distinct value per group: right for bounded domains; pass
    ``exact=False`` (``percentile_approx``) for continuous measures at scale.
    Pass 2:
    quartiles joined back by group key (one row per group) to find whiskers."""
    pct = (F.percentile(value, [0.25, 0.5, 0.75]) if exact
           else F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy))
    q = df.groupBy(by).agg(pct.cast("array<double>").alias("q"), F.count(F.lit(1)).alias("n"))
    q = q.select(by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                 F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    v = F.col(value)
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    w = df.select(by, value).join(q.select(by, "lo_fence", "hi_fence"), by).groupBy(by).agg(
        F.min(F.when(inside, v)).cast("double").alias("lower_whisker"),
        F.max(F.when(inside, v)).cast("double").alias("upper_whisker"),
        F.sum((~inside).cast("int")).cast("long").alias("n_outliers"))
    return q.drop("lo_fence", "hi_fence").join(w, by)


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson matrix in long form (a, b, corr); NULL when either column is
    constant (no ANSI divide-by-zero).

    Two passes of plain sums (codegen-friendly, numerically stable): the
    means, then centred cross products for each unordered pair."""
    x = {c: F.col(c).cast("double") for c in cols}
    m = df.agg(*[F.avg(x[c]).alias(c) for c in cols]).first()
    d = {c: x[c] - F.lit(m[c] if m[c] is not None else 0.0) for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums = df.agg(*[F.sum(d[a] * d[b]).alias(f"{a}__{b}") for a, b in pairs])
    def s(a, b):
        return F.col(f"{a}__{b}") if cols.index(a) <= cols.index(b) else F.col(f"{b}__{a}")
    arr = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                             F.when((s(a, a) > 0) & (s(b, b) > 0),
                                    s(a, b) / F.sqrt(s(a, a) * s(b, b))).alias("corr"))
                    for a, b in itertools.product(cols, cols)])
    return sums.select(F.inline(arr))


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean per key plus the mean of those means (seasonal profile)."""
    g = df.groupBy(key).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    return g.withColumn("mean_of_means", F.avg("mean").over(ALL_ROWS()))


def top_values(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values (ties by value); per-partition top-k then merge."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col)).limit(n))


def sample_rows(df: DataFrame, key: str, n: int = 5000, seed: int = 42) -> DataFrame:
    """Repeatable sample of at most ``n`` rows: smallest hash of (key, seed).
    Independent of partitioning, unlike ``sample``; top-k runs per partition."""
    return (df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
            .orderBy("_h", key).limit(n).drop("_h"))
