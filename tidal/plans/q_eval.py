"""Queries for forecast evaluation over the two naive baselines
(last value, and mean of the last 7 values) on the global daily series."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import evaluate as V
from ..operators import series as S
from ..sources import tables as T
from .q_series import PF_SPLIT, _pf_split
from .registry import query

H = 7


def _rnd(df, cols, d=6):
    for c in cols:
        df = df.withColumn(c, F.round(c, d))
    return df


# ---- prediction tables ---------------------------------------------------------

TEST_PREDS = f"""{PF_SPLIT},
tr AS (SELECT * FROM sp WHERE split = 'train'),
lv AS (SELECT arg_max(y, ds) AS pv FROM tr),
m7 AS (SELECT avg(y) AS mv FROM (SELECT y FROM tr ORDER BY ds DESC LIMIT 7)),
preds AS (SELECT 'baseline' AS model, ds, y, pv AS yhat FROM sp, lv WHERE split = 'test'
          UNION ALL SELECT 'mean7' AS model, ds, y, mv AS yhat FROM sp, m7 WHERE split = 'test')"""


def test_preds(spark, sf):
    sp = _pf_split(spark, sf)
    tr, te = sp.filter("split = 'train'"), sp.filter("split = 'test'")
    p1 = S.persistence_forecast(tr, te, [], "y", "ds").select(
        F.lit("baseline").alias("model"), "ds", "y", "yhat")
    m = S.recent_mean(tr, [], ["y"], "ds", 7).first()["y"]
    p2 = te.select(F.lit("mean7").alias("model"), "ds", "y", F.lit(m).alias("yhat"))
    return p1.unionByName(p2)


_LEADS = "\n  UNION ALL\n".join(
    f"  SELECT model, ds AS origin, {h} AS h, y_{h} AS y, yhat FROM o WHERE y_{H} IS NOT NULL"
    for h in range(1, H + 1))

HORIZON_PREDS = f"""{PF_SPLIT},
base AS (SELECT ds, split, y, avg(y) OVER (ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
                {", ".join(f"lead(y, {h}) OVER (ORDER BY ds) AS y_{h}" for h in range(1, H + 1))}
         FROM sp),
o AS (SELECT 'baseline' AS model, ds, y AS yhat, {", ".join(f"y_{h}" for h in range(1, H + 1))}
      FROM base WHERE split = 'test'
      UNION ALL
      SELECT 'mean7' AS model, ds, m7 AS yhat, {", ".join(f"y_{h}" for h in range(1, H + 1))}
      FROM base WHERE split = 'test'),
hp AS (
{_LEADS}
)"""


def horizon_preds(spark, sf):
    """Sequence-form forecasts from every test origin: 7 steps ahead of the
    last value (baseline) and of the trailing 7-day mean (mean7)."""
    sp = _pf_split(spark, sf).withColumn("_s", F.lit(0))
    w = Window.partitionBy("_s").orderBy("ds")
    base = S.lead_targets(sp, ["_s"], "y", "ds", H).withColumn(
        "m7", F.avg("y").over(w.rowsBetween(-6, 0))).filter("split = 'test'") \
        .filter(F.col(f"y_h{H}").isNotNull())
    steps = F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"y_h{h}").alias("y"))
                      for h in range(1, H + 1)])
    models = F.array(F.struct(F.lit("baseline").alias("model"), F.col("y").alias("yhat")),
                     F.struct(F.lit("mean7").alias("model"), F.col("m7").alias("yhat")))
    return (base.select(F.col("ds").alias("origin"), F.explode(steps).alias("s"), models.alias("ms"))
            .select("origin", "s", F.explode("ms").alias("m"))
            .select(F.col("m.model").alias("model"), "origin", F.col("s.h").alias("h"),
                    F.col("s.y").alias("y"), F.col("m.yhat").alias("yhat")))


_METRIC_COLS = ["mae", "mse", "rmse", "mape_eps", "r2", "max_error", "median_ae"]

METRICS_SQL = f"""{TEST_PREDS},
met AS (SELECT model, avg(abs(yhat - y)) AS mae, avg((yhat - y) * (yhat - y)) AS mse,
               sqrt(avg((yhat - y) * (yhat - y))) AS rmse,
               avg(abs(yhat - y) / (abs(y) + 1e-8)) * 100 AS mape_eps,
               CASE WHEN var_pop(y) > 0 THEN 1 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*)) END AS r2,
               max(abs(yhat - y)) AS max_error, CAST(median(abs(yhat - y)) AS DOUBLE) AS median_ae,
               count(*) AS n
        FROM preds GROUP BY model)"""


@query("union_predictions", f"{TEST_PREDS} SELECT model, ds, y, round(yhat, 6) AS yhat FROM preds")
def q_union_predictions(spark, sf):
    """Predictions of both baselines stacked with a model column."""
    return test_preds(spark, sf).withColumn("yhat", F.round("yhat", 6))


@query("regression_metrics", f"""{METRICS_SQL}
SELECT model, {", ".join(f"round({c}, 6) AS {c}" for c in _METRIC_COLS)}, n FROM met""",
       headline=True)
def q_regression_metrics(spark, sf):
    """mae, mse, rmse, mape_eps, r2, max_error, median_ae per baseline model."""
    return _rnd(V.regression_metrics(test_preds(spark, sf)), _METRIC_COLS)


@query("compare_models", f"""{METRICS_SQL},
b AS (SELECT mae AS bmae, mse AS bmse, rmse AS brmse FROM met WHERE model = 'baseline')
SELECT model, round(mae, 6) AS mae, round(mse, 6) AS mse, round(rmse, 6) AS rmse,
       CASE WHEN model <> 'baseline' AND bmae > 0 THEN round((bmae - mae) / bmae * 100, 2) END AS mae_improvement_pct,
       CASE WHEN model <> 'baseline' AND bmse > 0 THEN round((bmse - mse) / bmse * 100, 2) END AS mse_improvement_pct,
       CASE WHEN model <> 'baseline' AND brmse > 0 THEN round((brmse - rmse) / brmse * 100, 2) END AS rmse_improvement_pct
FROM met, b""")
def q_compare_models(spark, sf):
    """Metrics and percent improvement over the baseline."""
    m = V.regression_metrics(test_preds(spark, sf)).select("model", "mae", "mse", "rmse")
    return _rnd(V.compare_models(m, "baseline"), ["mae", "mse", "rmse"])


@query("relative_improvement", f"""{HORIZON_PREDS},
m AS (SELECT h, avg(CASE WHEN model = 'baseline' THEN abs(yhat - y) END) AS base_mae,
             avg(CASE WHEN model = 'mean7' THEN abs(yhat - y) END) AS model_mae FROM hp GROUP BY h)
SELECT h, round(base_mae, 6) AS base_mae, round(model_mae, 6) AS model_mae,
       CASE WHEN base_mae > 0 THEN round((base_mae - model_mae) / base_mae * 100, 2) END AS improvement_pct
FROM m""")
def q_relative_improvement(spark, sf):
    from ..functions.columns import relative_improvement
    hp = horizon_preds(spark, sf)
    ae = F.abs(F.col("yhat") - F.col("y"))
    m = hp.groupBy("h").agg(F.avg(F.when(F.col("model") == "baseline", ae)).alias("base_mae"),
                            F.avg(F.when(F.col("model") == "mean7", ae)).alias("model_mae"))
    m = m.withColumn("improvement_pct", relative_improvement("base_mae", "model_mae"))
    return _rnd(m, ["base_mae", "model_mae"])


@query("best_model", f"""{METRICS_SQL}
SELECT arg_min(model, (mae, model)) AS best_model, round(min(mae), 6) AS best_mae FROM met""")
def q_best_model(spark, sf):
    """Lowest-MAE model."""
    b = V.best_model(V.regression_metrics(test_preds(spark, sf)))
    return b.withColumn("best_mae", F.round("best_mae", 6))


@query("mape_nonzero", f"""{TEST_PREDS}
SELECT model, CASE WHEN count(CASE WHEN y <> 0 THEN 1 END) > 0
                   THEN round(avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100, 6)
                   ELSE CAST('Infinity' AS DOUBLE) END AS mape_nonzero
FROM preds GROUP BY model""")
def q_mape_nonzero(spark, sf):
    """MAPE over non-zero actuals per baseline model."""
    return _rnd(V.mape_nonzero(test_preds(spark, sf)), ["mape_nonzero"])


@query("huber_loss", f"""{HORIZON_PREDS}
SELECT model, round(avg(CASE WHEN abs(yhat - y) <= 1 THEN 0.5 * (yhat - y) * (yhat - y)
                             ELSE abs(yhat - y) - 0.5 END), 6) AS huber,
       round(avg(abs(yhat - y)), 6) AS mae, round(avg((yhat - y) * (yhat - y)), 6) AS mse
FROM hp GROUP BY model""")
def q_huber_loss(spark, sf):
    """Huber (delta 1), MAE and MSE over 7-step forecasts."""
    return _rnd(V.huber_loss(horizon_preds(spark, sf)), ["huber", "mae", "mse"])


@query("per_horizon_metrics", f"""{HORIZON_PREDS}
SELECT model, h, round(avg(abs(yhat - y)), 6) AS mae, round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse
FROM hp GROUP BY model, h""")
def q_per_horizon_metrics(spark, sf):
    """MAE and RMSE per forecast step."""
    return _rnd(V.per_horizon_metrics(horizon_preds(spark, sf)), ["mae", "rmse"])


@query("per_sample_mae", f"""{HORIZON_PREDS}
SELECT model, origin, round(avg(abs(yhat - y)), 6) AS mae FROM hp GROUP BY model, origin""")
def q_per_sample_mae(spark, sf):
    """MAE per forecast origin."""
    return _rnd(V.per_sample_mae(horizon_preds(spark, sf), ["model", "origin"]), ["mae"])


@query("align_forecast", f"""{HORIZON_PREDS}
SELECT model, origin, h, origin + CAST(h AS INTEGER) AS target_date, y, round(yhat, 6) AS yhat FROM hp""")
def q_align_forecast(spark, sf):
    """Predictions paired with actuals on (series, origin, h)."""
    hp = horizon_preds(spark, sf)
    return hp.select("model", "origin", "h", F.date_add("origin", F.col("h")).alias("target_date"),
                     "y", F.round("yhat", 6).alias("yhat"))


_GRID = V.normal_quantile_grid(99)


@query("error_quantiles", f"""{HORIZON_PREDS},
e AS (SELECT yhat - y AS e FROM hp WHERE model = 'baseline'),
q AS (SELECT quantile_cont(e, [{", ".join(repr(p) for p, _ in _GRID)}]) AS qs, stddev_samp(e) AS sd FROM e)
SELECT CAST(unnest(range({len(_GRID)})) AS INTEGER) AS i,
       unnest([{", ".join(repr(p) for p, _ in _GRID)}]) AS p,
       round(unnest([{", ".join(repr(z) for _, z in _GRID)}]), 9) AS normal_q,
       round(unnest(qs), 6) AS error_q,
       round(unnest([{", ".join(repr(z) for _, z in _GRID)}]) * sd, 6) AS reference_q
FROM q""")
def q_error_quantiles(spark, sf):
    """Empirical error quantiles beside exact normal quantiles."""
    hp = horizon_preds(spark, sf).filter("model = 'baseline'")
    q = V.error_quantiles(hp, m=len(_GRID))
    return q.select(F.col("i").cast("int").alias("i"), "p", F.round("normal_q", 9).alias("normal_q"),
                    F.round("error_q", 6).alias("error_q"), F.round("reference_q", 6).alias("reference_q"))


_VAL_SQL = f"""{PF_SPLIT},
lv AS (SELECT arg_max(y, ds) AS pv FROM sp WHERE split = 'train'),
vp AS (SELECT ds, y, pv AS yhat FROM sp, lv WHERE split = 'val'),
vm AS (SELECT avg(abs(yhat - y)) AS val_mae FROM vp)"""


def _val_preds(spark, sf):
    sp = _pf_split(spark, sf)
    return sp, S.persistence_forecast(sp.filter("split = 'train'"), sp.filter("split = 'val'"),
                                      [], "y", "ds")


@query("validation_report", f"""{_VAL_SQL}
SELECT round(avg(abs(yhat - y)), 6) AS mae, round(avg((yhat - y) * (yhat - y)), 6) AS mse,
       round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse,
       CASE WHEN count(CASE WHEN y <> 0 THEN 1 END) > 0
            THEN round(avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100, 6)
            ELSE CAST('Infinity' AS DOUBLE) END AS mape
FROM vp""")
def q_validation_report(spark, sf):
    _, vp = _val_preds(spark, sf)
    return _rnd(V.validation_report(vp, []), ["mae", "mse", "rmse", "mape"])


@query("forecast_band", f"""{_VAL_SQL},
lv2 AS (SELECT arg_max(y, ds) AS pv2 FROM sp WHERE split = 'train')
SELECT ds, y, pv2 AS yhat, round(pv2 - 1.96 * val_mae, 6) AS lower, round(pv2 + 1.96 * val_mae, 6) AS upper
FROM sp, lv2, vm WHERE split = 'test'""")
def q_forecast_band(spark, sf):
    """Baseline forecast with a +-1.96 x validation-MAE band."""
    sp, vp = _val_preds(spark, sf)
    mae = vp.agg(F.avg(F.abs(F.col("yhat") - F.col("y")))).first()[0]
    te = S.persistence_forecast(sp.filter("split = 'train'"), sp.filter("split = 'test'"), [], "y", "ds")
    b = V.forecast_band(te.select("ds", "y", "yhat"), mae)
    return _rnd(b, ["lower", "upper"])


@query("interval_coverage", f"""{_VAL_SQL},
lv2 AS (SELECT arg_max(y, ds) AS pv2 FROM sp WHERE split = 'train'),
b AS (SELECT y, pv2 - 1.96 * val_mae AS lower, pv2 + 1.96 * val_mae AS upper
      FROM sp, lv2, vm WHERE split = 'test')
SELECT round(avg(CAST(y >= lower AND y <= upper AS DOUBLE)) * 100, 6) AS coverage_pct,
       CAST(sum(CAST(y >= lower AND y <= upper AS BIGINT)) AS BIGINT) AS n_inside,
       CAST(sum(CAST(NOT (y >= lower AND y <= upper) AS BIGINT)) AS BIGINT) AS n_outside
FROM b""")
def q_interval_coverage(spark, sf):
    """Share of test actuals inside the band."""
    sp, vp = _val_preds(spark, sf)
    mae = vp.agg(F.avg(F.abs(F.col("yhat") - F.col("y")))).first()[0]
    te = S.persistence_forecast(sp.filter("split = 'train'"), sp.filter("split = 'test'"), [], "y", "ds")
    return _rnd(V.interval_coverage(V.forecast_band(te, mae)), ["coverage_pct"])


@query("backtest_metrics", f"""{PF_SPLIT},
b AS (SELECT min(ds) AS lo, max(ds) AS hi FROM sp),
cut AS (SELECT CAST(c AS DATE) AS cutoff FROM b,
        unnest(generate_series(hi - INTERVAL 7 DAY, lo + INTERVAL 365 DAY, -INTERVAL 30 DAY)) t(c)),
lastv AS (SELECT cutoff, arg_max(y, ds) AS yhat FROM cut JOIN sp ON sp.ds <= cut.cutoff GROUP BY cutoff),
p AS (SELECT cut.cutoff, ds, y, yhat FROM cut JOIN sp ON sp.ds > cut.cutoff AND sp.ds <= cut.cutoff + INTERVAL 7 DAY
      JOIN lastv ON lastv.cutoff = cut.cutoff),
ph AS (SELECT datediff('day', cutoff, ds) AS horizon, avg(abs(yhat - y)) AS mae,
              avg((yhat - y) * (yhat - y)) AS mse, avg(abs(yhat - y) / nullif(abs(y), 0)) AS mape
       FROM p GROUP BY 1)
SELECT round(avg(mae), 6) AS cv_mae, round(avg(mse), 6) AS cv_mse, round(avg(sqrt(mse)), 6) AS cv_rmse,
       round(avg(mape), 6) AS cv_mape FROM ph""")
def q_backtest_metrics(spark, sf):
    """Expanding-window backtest of the last-value baseline: fold membership
    by arithmetic explode, last training value per fold, metrics by horizon."""
    pf = S.computed_once(A.prophet_frame(T.shipments(spark, sf)))
    folds = S.cv_folds(pf, "ds", 7, 30, 365)
    last = folds.filter("role = 'train'").groupBy("fold").agg(F.max_by("y", "ds").alias("yhat"))
    preds = folds.filter("role = 'test'").join(last, "fold")
    return _rnd(V.backtest_metrics(preds), ["cv_mae", "cv_mse", "cv_rmse", "cv_mape"])
