"""Per-series window operators over daily series.

Every window is ``partitionBy(series keys)``; a task holds at most one
series, whose length is bounded by the calendar (days), never by the raw
record count, because the daily aggregation has already collapsed records.
Global calendar facts (first/last date, split cut dates) are a handful of
scalars computed by one aggregation and inlined as literals, so no step
joins a one-row table by a cross join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, require_columns

TRAIN_RATIO = 0.70
VAL_RATIO = 0.15
HISTORY = 30
HORIZON = 7


def _w(series: list[str], order: str = "date"):
    return Window.partitionBy(*series).orderBy(order) if series else Window.orderBy(order)


def rolling_mean(df: DataFrame, value: str, series: list[str], order: str = "date",
                 windows=(7, 30)) -> DataFrame:
    """Trailing mean over the last ``w`` rows per series; NULL until full."""
    out = df
    for w in windows:
        frame = _w(series, order).rowsBetween(-(w - 1), 0)
        out = out.withColumn(f"rolling_mean_{w}",
                             F.when(F.count(F.lit(1)).over(frame) == w,
                                    F.avg(value).over(frame)))
    return out


def computed_once(daily: DataFrame) -> DataFrame:
    """A daily frame written once to the shared checkpoint folder, for queries
    that read it several times (cut dates, last values, means): the records
    below it are scanned once, and a lost executor repeats nothing."""
    ensure_checkpoint_dir(daily.sparkSession)
    return daily.checkpoint()


def date_bounds(df: DataFrame, date_col: str = "date") -> tuple[_dt.date, _dt.date]:
    r = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    return r["lo"], r["hi"]


def densify_series(df: DataFrame, series: list[str], date_col: str = "date",
                   fill: dict | None = None, bounds=None) -> DataFrame:
    """Calendar spine: every date between the global first and last date for
    every series; columns in ``fill`` get a constant (target -> 0), other
    columns stay NULL (forward-fill them with :func:`forward_fill`).

    The spine is built by exploding a date sequence on the distinct series
    rows (no cross join), then left-joined to the data on (series, date).
    """
    lo, hi = bounds or date_bounds(df, date_col)
    keys = df.select(*series).distinct() if series else df.sparkSession.range(1).select()
    spine = keys.withColumn(date_col, F.explode(F.sequence(F.lit(lo), F.lit(hi),
                                                           F.expr("interval 1 day"))))
    out = spine.join(df, [*series, date_col], "left")
    for c, v in (fill or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def forward_fill(df: DataFrame, cols: list[str], series: list[str],
                 order: str = "date") -> DataFrame:
    w = _w(series, order).rowsBetween(Window.unboundedPreceding, 0)
    out = df
    for c in cols:
        out = out.withColumn(c, F.last(c, ignorenulls=True).over(w))
    return out


def split_cut_dates(df: DataFrame, date_col: str = "date", train_ratio: float = TRAIN_RATIO,
                    val_ratio: float = VAL_RATIO):
    """First validation date and first test date of a 70/15/15 cut on the
    distinct dates (index ``int(n*0.70)`` and ``int(n*0.85)``)."""
    dates = df.select(F.col(date_col).alias("d")).distinct()
    w = Window.orderBy("d")  # distinct calendar dates only: bounded by the span in days
    ranked = (dates.withColumn("i", F.row_number().over(w) - 1)
              .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
              .withColumn("cut1", F.floor(F.col("n") * F.lit(train_ratio)))
              .withColumn("cut2", F.floor(F.col("n") * F.lit(train_ratio + val_ratio))))
    rows = ranked.filter((F.col("i") == F.col("cut1")) | (F.col("i") == F.col("cut2"))) \
        .select("d", (F.col("i") == F.col("cut1")).alias("is1"),
                (F.col("i") == F.col("cut2")).alias("is2")).collect()
    c1 = next((r["d"] for r in rows if r["is1"]), None)
    c2 = next((r["d"] for r in rows if r["is2"]), None)
    return c1, c2


def split_label(date_col: str, cuts) -> Column:
    c1, c2 = cuts
    d = F.col(date_col)
    e = F.lit("test")
    if c2 is not None:
        e = F.when(d < F.lit(c2), "val").otherwise("test")
    else:
        e = F.lit("val")
    if c1 is not None:
        e = F.when(d < F.lit(c1), "train").otherwise(e)
    else:
        e = F.lit("train")
    return e


def temporal_split(df: DataFrame, date_col: str = "date", train_ratio: float = TRAIN_RATIO,
                   val_ratio: float = VAL_RATIO) -> DataFrame:
    """Adds ``split`` in {train, val, test}, cutting on distinct dates so one
    date never lands in two splits."""
    cuts = split_cut_dates(df, date_col, train_ratio, val_ratio)
    return df.withColumn("split", split_label(date_col, cuts))


def sequence_windows(df: DataFrame, series: list[str], target: str,
                     features: list[str], date_col: str = "date",
                     history: int = HISTORY, horizon: int = HORIZON,
                     stride: int = 1) -> DataFrame:
    """One sample per origin row: the last ``history`` rows (struct of date,
    features and target) and the next ``horizon`` targets, stride ``stride``.
    Series shorter than history+horizon give no sample."""
    require_columns(df, [*series, target, date_col, *features], "sequence_windows")
    w = _w(series, date_col)
    hist = F.collect_list(F.struct(F.col(date_col).alias("date"),
                                   *[F.col(c) for c in features],
                                   F.col(target).alias("y"))).over(
        w.rowsBetween(-(history - 1), 0))
    fut = F.collect_list(F.col(target)).over(w.rowsBetween(1, horizon))
    fut_dates = F.collect_list(F.col(date_col)).over(w.rowsBetween(1, horizon))
    out = (df.withColumn("history", hist).withColumn("target", fut)
           .withColumn("target_dates", fut_dates)
           .withColumn("_rn", F.row_number().over(w)))
    out = out.filter((F.size("history") == history) & (F.size("target") == horizon)
                     & (((F.col("_rn") - history) % stride) == 0))
    return out.select(*series, F.col(date_col).alias("origin_date"),
                      (F.col("_rn") - history).cast("long").alias("sample_index"),
                      "history", "target", "target_dates")


def lag_features(df: DataFrame, series: list[str], target: str, date_col: str = "date",
                 lags: int = HISTORY) -> DataFrame:
    """``lag_k`` = target k rows back (k = 1..lags) per series, the tabular
    form of the sequence input."""
    w = _w(series, date_col)
    out = df
    for k in range(1, lags + 1):
        out = out.withColumn(f"lag_{k}", F.lag(target, k).over(w))
    return out


def lead_targets(df: DataFrame, series: list[str], target: str, date_col: str = "date",
                 horizon: int = HORIZON) -> DataFrame:
    w = _w(series, date_col)
    out = df
    for h in range(1, horizon + 1):
        out = out.withColumn(f"y_h{h}", F.lead(target, h).over(w))
    return out


def recent_mean(df: DataFrame, series: list[str], cols: list[str], date_col: str = "date",
                n: int = 30) -> DataFrame:
    """Mean of each column over the last ``n`` rows of every series."""
    w = Window.partitionBy(*series).orderBy(F.col(date_col).desc()) if series else \
        Window.orderBy(F.col(date_col).desc())
    last = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    if series:
        return last.groupBy(*series).agg(*[F.avg(c).alias(c) for c in cols])
    return last.agg(*[F.avg(c).alias(c) for c in cols])


def last_values(train: DataFrame, series: list[str], target: str,
                date_col: str = "date") -> DataFrame:
    """Last observed target per series (``max_by``: partial aggregation, no sort)."""
    g = train.groupBy(*series) if series else train.groupBy()
    return g.agg(F.max_by(target, date_col).alias("last_value"),
                 F.max(date_col).alias("last_date"))


def persistence_forecast(train: DataFrame, test: DataFrame, series: list[str],
                         target: str, date_col: str = "date") -> DataFrame:
    """Naive baseline: the last training value repeated over the test rows."""
    last = last_values(train, series, target, date_col)
    if series:
        out = test.join(last, series, "inner")
    else:  # one global series: the single last value is a literal
        r = last.first()
        out = test.withColumn("last_value", F.lit(r["last_value"])) \
                  .withColumn("last_date", F.lit(r["last_date"]))
    return out.withColumn("yhat", F.col("last_value").cast("double"))


def future_frame(last_dates: DataFrame, periods: int = HORIZON, series: list[str] = (),
                 date_col: str = "last_date") -> DataFrame:
    """Next ``periods`` dates after each series' last date with the
    calendar-computable month-end regressor."""
    out = last_dates.withColumn(
        "ds", F.explode(F.sequence(F.date_add(F.col(date_col), 1),
                                   F.date_add(F.col(date_col), periods))))
    ds = F.col("ds")
    qe = (F.month(ds).isin(3, 6, 9, 12) & (F.dayofmonth(ds) >= F.dayofmonth(F.last_day(ds)) - 2))
    return out.select(*series, "ds",
                      ((F.dayofmonth(ds) >= 28) | qe).cast("double").alias("is_month_end"))


def join_future_regressors(future: DataFrame, regressors: DataFrame, series: list[str],
                           fill_means: DataFrame | None = None,
                           cols: list[str] = ("failure_rate_pct", "avg_urgency")) -> DataFrame:
    """Left join known regressor values on (series, ds); still-missing values
    take the per-series training mean from ``fill_means``."""
    keep = [c for c in cols if c in regressors.columns]
    out = future.join(regressors.select(*series, "ds", *keep), [*series, "ds"], "left")
    if fill_means is not None:
        if series:  # one mean row per series: equi-join on the series key
            m = fill_means.select(*series, *[F.col(c).alias(f"_m_{c}") for c in keep])
            out = out.join(m, list(series), "left")
            for c in keep:
                out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}"))).drop(f"_m_{c}")
        else:  # a single global series: its one mean row becomes literals
            r = fill_means.first()
            for c in keep:
                out = out.withColumn(c, F.coalesce(F.col(c), F.lit(r[c])))
    return out


def cv_folds(df: DataFrame, date_col: str = "ds", horizon: int = 7, period: int = 30,
             initial: int = 365, bounds=None) -> DataFrame:
    """Expanding-window backtest membership, long form (cutoff, fold, role).

    Cutoffs are ``max - horizon - j*period`` for j = 0.. while the cutoff is
    >= ``min + initial``. A row with date ``ds`` trains fold j when
    ``cutoff_j >= ds`` and tests it when ``cutoff_j < ds <= cutoff_j + horizon``;
    both fold ranges follow from integer arithmetic on ``ds``, so each row
    explodes only its own folds (no range join)."""
    lo, hi = bounds or date_bounds(df, date_col)
    span = (hi - lo).days
    n_folds = (span - horizon - initial) // period + 1
    if n_folds <= 0:
        return df.limit(0).withColumn("fold", F.lit(0)).withColumn(
            "cutoff", F.lit(None).cast("date")).withColumn("role", F.lit(None).cast("string"))
    back = F.datediff(F.lit(hi), F.col(date_col))  # days from the last date
    # train: j*period <= back - horizon  ->  j in [0, floor((back-h)/p)]
    jmax_train = F.least(F.lit(n_folds - 1), F.floor((back - horizon) / period).cast("int"))
    # test: back - horizon < j*period <= back  (period > horizon: at most one j... any)
    jlo_test = F.floor((back - horizon) / period).cast("int") + 1
    jhi_test = F.least(F.lit(n_folds - 1), F.floor(back / period).cast("int"))
    train = (df.filter(back >= horizon)
             .withColumn("fold", F.explode(F.sequence(F.lit(0), jmax_train)))
             .withColumn("role", F.lit("train")))
    test = (df.filter(jhi_test >= F.greatest(jlo_test, F.lit(0)))
            .withColumn("fold", F.explode(F.sequence(F.greatest(jlo_test, F.lit(0)), jhi_test)))
            .withColumn("role", F.lit("test")))
    out = train.unionByName(test)
    return out.withColumn("cutoff", F.date_sub(F.lit(hi), F.col("fold") * period + horizon))
