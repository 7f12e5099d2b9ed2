"""Queries for the per-series window operators (split, windows, baselines,
future frame, backtest folds)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import series as S
from ..sources import tables as T
from .registry import SHIPMENTS_CTE, query, with_ctes

SH = with_ctes(SHIPMENTS_CTE)
R85 = repr(S.TRAIN_RATIO + S.VAL_RATIO)

# global daily frame + 70/15/15 split on distinct dates (DuckDB)
PF_SPLIT = f"""{SH},
pf AS (SELECT date AS ds, sum(shipping_weight_kg) AS y,
              CAST(day(date) >= 28 OR max(is_quarter_end) = 1 AS DOUBLE) AS is_month_end,
              avg(failure_rate_pct) AS failure_rate_pct, avg(request_urgency) AS avg_urgency
       FROM shipments GROUP BY date),
dts AS (SELECT ds, row_number() OVER (ORDER BY ds) - 1 AS i, count(*) OVER () AS n FROM pf),
cuts AS (SELECT max(CASE WHEN i = floor(n * CAST({S.TRAIN_RATIO!r} AS DOUBLE)) THEN ds END) AS c1,
                max(CASE WHEN i = floor(n * CAST({R85} AS DOUBLE)) THEN ds END) AS c2 FROM dts),
sp AS (SELECT pf.*, CASE WHEN ds < c1 THEN 'train' WHEN ds < c2 THEN 'val' ELSE 'test' END AS split
       FROM pf, cuts)"""


def _pf_split(spark, sf):
    """The global daily frame with its split, from one scan of the records."""
    pf = S.computed_once(A.prophet_frame(T.shipments(spark, sf)))
    return S.temporal_split(pf, "ds")


REGION_DAILY = f"""{SH},
rd AS (SELECT date, region, sum(shipping_weight_kg) AS y, avg(failure_rate_pct) AS failure_rate_pct
       FROM shipments GROUP BY date, region)"""


def _region_daily(spark, sf):
    return T.shipments(spark, sf).groupBy("date", "region").agg(
        F.sum("shipping_weight_kg").alias("y"), F.avg("failure_rate_pct").alias("failure_rate_pct"))


@query("temporal_split", f"""{SH},
rd AS (SELECT date, region, sum(shipping_weight_kg) AS y FROM shipments GROUP BY date, region),
dts AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT date FROM rd)),
cuts AS (SELECT max(CASE WHEN i = floor(n * CAST({S.TRAIN_RATIO!r} AS DOUBLE)) THEN date END) AS c1,
                max(CASE WHEN i = floor(n * CAST({R85} AS DOUBLE)) THEN date END) AS c2 FROM dts)
SELECT date, region, y,
       CASE WHEN date < c1 THEN 'train' WHEN date < c2 THEN 'val' ELSE 'test' END AS split
FROM rd, cuts""")
def q_temporal_split(spark, sf):
    """70/15/15 split label cut on distinct dates."""
    rd = S.computed_once(T.shipments(spark, sf).groupBy("date", "region").agg(
        F.sum("shipping_weight_kg").alias("y")))
    return S.temporal_split(rd, "date")


@query("sequence_windows", f"""{REGION_DAILY},
w AS (
  SELECT region, date AS origin_date,
         row_number() OVER (PARTITION BY region ORDER BY date) - 30 AS sample_index,
         count(*) OVER h AS n_hist, sum(y) OVER h AS hist_y_sum,
         round(sum(failure_rate_pct) OVER h, 6) AS hist_failure_sum,
         min(date) OVER h AS hist_first_date,
         count(*) OVER f AS n_target, sum(y) OVER f AS target_y_sum,
         min(date) OVER f AS target_first_date, max(date) OVER f AS target_last_date
  FROM rd
  WINDOW h AS (PARTITION BY region ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY region ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING)
)
SELECT * FROM w WHERE n_hist = 30 AND n_target = 7""")
def q_sequence_windows(spark, sf):
    """30-row histories and 7-row targets per region, summarised per sample."""
    sw = S.sequence_windows(_region_daily(spark, sf), ["region"], "y", ["failure_rate_pct"])
    add = lambda a, b: a + b
    return sw.select(
        "region", "origin_date", "sample_index",
        F.size("history").cast("long").alias("n_hist"),
        F.aggregate(F.transform("history", lambda x: x["y"]), F.lit(0.0), add).alias("hist_y_sum"),
        F.round(F.aggregate(F.transform("history", lambda x: x["failure_rate_pct"]),
                            F.lit(0.0), add), 6).alias("hist_failure_sum"),
        F.col("history")[0]["date"].alias("hist_first_date"),
        F.size("target").cast("long").alias("n_target"),
        F.aggregate("target", F.lit(0.0), add).alias("target_y_sum"),
        F.col("target_dates")[0].alias("target_first_date"),
        F.element_at("target_dates", -1).alias("target_last_date"))


_LAGS = 30


@query("lag_features", f"""{REGION_DAILY}
SELECT date, region, y, {", ".join(f"lag(y, {k}) OVER w AS lag_{k}" for k in range(1, _LAGS + 1))}
FROM rd WINDOW w AS (PARTITION BY region ORDER BY date)""")
def q_lag_features(spark, sf):
    """Lags 1..30 of the daily weight per region."""
    rd = _region_daily(spark, sf).select("date", "region", "y")
    return S.lag_features(rd, ["region"], "y", lags=_LAGS)


@query("recent_mean", f"""{PF_SPLIT}
SELECT round(avg(failure_rate_pct), 6) AS failure_rate_pct, round(avg(avg_urgency), 6) AS avg_urgency
FROM (SELECT * FROM sp WHERE split = 'train' ORDER BY ds DESC LIMIT 30)""")
def q_recent_mean(spark, sf):
    """Mean regressors over the last 30 training days."""
    tr = _pf_split(spark, sf).filter("split = 'train'")
    m = S.recent_mean(tr, [], ["failure_rate_pct", "avg_urgency"], "ds", 30)
    return m.select(F.round("failure_rate_pct", 6).alias("failure_rate_pct"),
                    F.round("avg_urgency", 6).alias("avg_urgency"))


@query("persistence_forecast", f"""{PF_SPLIT},
last AS (SELECT arg_max(y, ds) AS last_value FROM sp WHERE split = 'train')
SELECT ds, y, last_value AS yhat FROM sp, last WHERE split = 'test'""")
def q_persistence_forecast(spark, sf):
    """Last training value repeated over the test dates."""
    sp = _pf_split(spark, sf)
    p = S.persistence_forecast(sp.filter("split = 'train'"), sp.filter("split = 'test'"),
                               [], "y", "ds")
    return p.select("ds", "y", "yhat")


@query("persistence_by_region", f"""{SH},
rd AS (SELECT date, region, sum(shipping_weight_kg) AS y FROM shipments GROUP BY date, region),
dts AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT date FROM rd)),
cuts AS (SELECT max(CASE WHEN i = floor(n * CAST({S.TRAIN_RATIO!r} AS DOUBLE)) THEN date END) AS c1,
                max(CASE WHEN i = floor(n * CAST({R85} AS DOUBLE)) THEN date END) AS c2 FROM dts),
sp AS (SELECT rd.*, CASE WHEN date < c1 THEN 'train' WHEN date < c2 THEN 'val' ELSE 'test' END AS split
       FROM rd, cuts),
last AS (SELECT region, arg_max(y, date) AS last_value FROM sp WHERE split = 'train' GROUP BY region)
SELECT sp.region, date, y, last_value AS yhat FROM sp JOIN last ON sp.region = last.region
WHERE split = 'test'""")
def q_persistence_by_region(spark, sf):
    rd = S.computed_once(T.shipments(spark, sf).groupBy("date", "region").agg(F.sum("shipping_weight_kg").alias("y")))
    sp = S.temporal_split(rd, "date")
    p = S.persistence_forecast(sp.filter("split = 'train'"), sp.filter("split = 'test'"),
                               ["region"], "y", "date")
    return p.select("region", "date", "y", "yhat")


_FUT = f"""{PF_SPLIT},
tr AS (SELECT * FROM sp WHERE split = 'train'),
rm AS (SELECT avg(failure_rate_pct) AS failure_rate_pct, avg(avg_urgency) AS avg_urgency
       FROM (SELECT * FROM tr ORDER BY ds DESC LIMIT 30)),
fut AS (SELECT CAST(unnest(generate_series((SELECT max(ds) FROM tr) + 1, (SELECT max(ds) FROM tr) + 7,
                                          INTERVAL 1 DAY)) AS DATE) AS ds)"""


def _future(spark, sf):
    sp = _pf_split(spark, sf)
    tr = sp.filter("split = 'train'")
    last = S.last_values(tr, [], "y", "ds")
    fut = S.future_frame(last, 7)
    means = S.recent_mean(tr, [], ["failure_rate_pct", "avg_urgency"], "ds", 30)
    return sp, tr, fut, means


@query("future_frame", f"""{_FUT}
SELECT ds, CAST(day(ds) >= 28 OR (month(ds) IN (3, 6, 9, 12) AND day(ds) >= day(last_day(ds)) - 2)
                AS DOUBLE) AS is_month_end,
       round(failure_rate_pct, 6) AS failure_rate_pct, round(avg_urgency, 6) AS avg_urgency
FROM fut, rm""")
def q_future_frame(spark, sf):
    _, _, fut, means = _future(spark, sf)
    m = means.first()
    return fut.select("ds", "is_month_end",
                      F.lit(round(m["failure_rate_pct"], 6)).alias("failure_rate_pct"),
                      F.lit(round(m["avg_urgency"], 6)).alias("avg_urgency"))


@query("join_future_regressors", f"""{PF_SPLIT},
lastval AS (SELECT max(ds) AS d FROM sp WHERE split = 'val'),
fut AS (SELECT CAST(unnest(generate_series((SELECT d FROM lastval) + 1, (SELECT d FROM lastval) + 7,
                                          INTERVAL 1 DAY)) AS DATE) AS ds),
tm AS (SELECT avg(failure_rate_pct) AS mf, avg(avg_urgency) AS mu FROM sp WHERE split = 'train')
SELECT fut.ds, round(coalesce(sp.failure_rate_pct, mf), 6) AS failure_rate_pct,
       round(coalesce(sp.avg_urgency, mu), 6) AS avg_urgency
FROM fut LEFT JOIN sp ON fut.ds = sp.ds, tm""")
def q_join_future_regressors(spark, sf):
    """Future dates after the validation split joined to the known regressor
    values; dates without a row take the training mean."""
    sp = _pf_split(spark, sf)
    last_val = S.last_values(sp.filter("split = 'val'"), [], "y", "ds")
    fut = S.future_frame(last_val, 7).select("ds")
    means = sp.filter("split = 'train'").agg(F.avg("failure_rate_pct").alias("failure_rate_pct"),
                                             F.avg("avg_urgency").alias("avg_urgency"))
    out = S.join_future_regressors(fut, sp, [], means)
    return out.select("ds", F.round("failure_rate_pct", 6).alias("failure_rate_pct"),
                      F.round("avg_urgency", 6).alias("avg_urgency"))


@query("fill_regressor_mean", f"""{PF_SPLIT},
cal AS (SELECT CAST(unnest(generate_series((SELECT min(ds) FROM sp), (SELECT max(ds) FROM sp),
                                          INTERVAL 1 DAY)) AS DATE) AS ds),
tm AS (SELECT avg(failure_rate_pct) AS mf, avg(avg_urgency) AS mu FROM sp WHERE split = 'train')
SELECT cal.ds, coalesce(sp.y, 0) AS y, round(coalesce(sp.failure_rate_pct, mf), 6) AS failure_rate_pct,
       round(coalesce(sp.avg_urgency, mu), 6) AS avg_urgency
FROM cal LEFT JOIN sp ON cal.ds = sp.ds, tm""")
def q_fill_regressor_mean(spark, sf):
    """Densified calendar: gap days get y = 0 and the training-mean regressors."""
    sp = _pf_split(spark, sf)
    dense = S.densify_series(sp.select("ds", "y", "failure_rate_pct", "avg_urgency"), [], "ds",
                             fill={"y": 0.0})
    m = sp.filter("split = 'train'").agg(F.avg("failure_rate_pct").alias("mf"),
                                         F.avg("avg_urgency").alias("mu")).first()
    return dense.select("ds", "y",
                        F.round(F.coalesce("failure_rate_pct", F.lit(m["mf"])), 6).alias("failure_rate_pct"),
                        F.round(F.coalesce("avg_urgency", F.lit(m["mu"])), 6).alias("avg_urgency"))


@query("tail_periods", f"""{PF_SPLIT}
SELECT ds, y FROM sp WHERE ds > (SELECT max(ds) FROM sp WHERE split = 'train')""")
def q_tail_periods(spark, sf):
    """Rows after the last training date."""
    sp = _pf_split(spark, sf)
    last = sp.filter("split = 'train'").agg(F.max("ds")).first()[0]
    return sp.filter(F.col("ds") > F.lit(last)).select("ds", "y")


@query("union_splits", f"""{PF_SPLIT}
SELECT ds, y, split FROM sp WHERE split = 'train'
UNION ALL SELECT ds, y, split FROM sp WHERE split = 'test'""")
def q_union_splits(spark, sf):
    """Training and test rows stacked."""
    sp = _pf_split(spark, sf).select("ds", "y", "split")
    return sp.filter("split = 'train'").unionByName(sp.filter("split = 'test'"))


@query("cv_folds", f"""{SH},
pf AS (SELECT DISTINCT date AS ds FROM shipments),
b AS (SELECT min(ds) AS lo, max(ds) AS hi FROM pf),
cut AS (SELECT CAST(c AS DATE) AS cutoff FROM b,
        unnest(generate_series(hi - INTERVAL 7 DAY, lo + INTERVAL 365 DAY, -INTERVAL 30 DAY)) t(c)),
tr AS (SELECT cutoff, count(*) AS n_train, min(ds) AS train_first, max(ds) AS train_last
       FROM cut JOIN pf ON pf.ds <= cut.cutoff GROUP BY cutoff),
te AS (SELECT cutoff, count(*) AS n_test, min(ds) AS test_first, max(ds) AS test_last
       FROM cut JOIN pf ON pf.ds > cut.cutoff AND pf.ds <= cut.cutoff + INTERVAL 7 DAY GROUP BY cutoff)
SELECT tr.cutoff, n_train, train_first, train_last, coalesce(n_test, 0) AS n_test, test_first, test_last
FROM tr LEFT JOIN te ON tr.cutoff = te.cutoff""")
def q_cv_folds(spark, sf):
    """Fold summary of the expanding-window backtest membership."""
    pf = S.computed_once(T.shipments(spark, sf).select(F.col("date").alias("ds")).distinct())
    m = S.cv_folds(pf, "ds", horizon=7, period=30, initial=365)
    g = m.groupBy("cutoff").agg(
        F.count(F.when(F.col("role") == "train", 1)).alias("n_train"),
        F.min(F.when(F.col("role") == "train", F.col("ds"))).alias("train_first"),
        F.max(F.when(F.col("role") == "train", F.col("ds"))).alias("train_last"),
        F.count(F.when(F.col("role") == "test", 1)).alias("n_test"),
        F.min(F.when(F.col("role") == "test", F.col("ds"))).alias("test_first"),
        F.max(F.when(F.col("role") == "test", F.col("ds"))).alias("test_last"))
    return g.filter(F.col("n_train") > 0)
