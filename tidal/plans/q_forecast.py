"""Forecasting queries over the per-region daily series (densified, 70/15/15
split on dates): direct per-horizon models, the seasonal model, forecasts past
the data and from requests, persistence, components, changepoints, backtests
and the cross-family comparison. Fits are shared per (session, table folder)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import direct as D
from ..operators import evaluate as V
from ..operators import forecast as FC
from ..operators import series as S
from ..operators import serving
from ..sources import sinks
from ..sources import tables as T
from .registry import query

SER = ["region"]
_MEMO: dict = {}


def _memo(key, fn):
    if key not in _MEMO:
        _MEMO[key] = fn()
    return _MEMO[key]


def region_series(spark, sf):
    """(region, ds, y, is_month_end, failure_rate_pct, avg_urgency, the
    categories and avg_repair_cycle_days, split): every calendar day for every
    region; gap days have y = 0 and carry the last known other values. One
    scan of the records serves both forecasters: the daily rows are written
    once, before the bounds, the spine, the cuts and the cache read them."""
    def build():
        daily = T.shipments(spark, sf).groupBy("date", "region", "shipping_method").agg(*A.method_level_aggs())
        agg = daily.groupBy("date", "region").agg(*A.series_level_aggs())
        pf = S.computed_once(agg.select("region", F.col("date").alias("ds"), F.col("total_shipping_weight_kg").alias("y"), "failure_rate_pct",
                        F.col("mean_urgency").alias("avg_urgency"), A.C.urgency_bucket("mean_urgency").alias("request_urgency"),
                        "avg_repair_cycle_days", "shipping_method", F.lit("ALL").alias("sku_category")))
        dense = S.densify_series(pf, SER, "ds", fill={"y": 0.0})
        carried = ["failure_rate_pct", "avg_urgency", "request_urgency", "avg_repair_cycle_days", "shipping_method", "sku_category"]
        dense = S.forward_fill(dense, carried, SER, "ds")
        ds = F.col("ds")
        qe = F.month(ds).isin(3, 6, 9, 12) & (F.dayofmonth(ds) >= F.dayofmonth(F.last_day(ds)) - 2)
        dense = dense.withColumn("is_month_end", ((F.dayofmonth(ds) >= 28) | qe).cast("double"))
        dense = dense.fillna(0.0, ["failure_rate_pct", "avg_urgency", "avg_repair_cycle_days"])
        cuts = S.split_cut_dates(dense, "ds")
        return dense.withColumn("split", S.split_label("ds", cuts)).cache(), cuts
    return _memo(("series", spark.sparkContext.applicationId, sf), build)


def _direct(spark, sf):
    """(all origins, test origins, fits with their validation error)."""
    def build():
        rs, (c1, _c2) = region_series(spark, sf)
        frame = D.origin_frame(rs, SER).cache()
        frame.count()  # materialise once before the concurrent fits read it
        train = frame.filter((F.col("split") == "train") & (F.date_add("ds", S.HORIZON) < F.lit(c1)))
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=len(D.VERSIONS)) as ex:  # independent versions, concurrent jobs
            fits = list(ex.map(lambda v: D.fit(train, v), D.VERSIONS))
        return frame, D.with_band(fits, frame.filter("split = 'val'"))
    return _memo(("direct", spark.sparkContext.applicationId, sf), build)


def _full_test(frame):
    return frame.filter((F.col("split") == "test") & (F.size("targets") == S.HORIZON))


def _direct_preds(spark, sf):
    """Predictions of all versions and of the last value from the test
    origins whose next days are known."""
    frame, fits = _direct(spark, sf)
    test, coefs = _full_test(frame), D.table(spark, fits)
    out = test.select(*SER, F.col("ds").alias("origin"), F.col("lags")[0].alias("yhat"), F.posexplode("targets").alias("_h", "y")) \
        .select(*SER, "origin", (F.col("_h") + 1).alias("h"), "y", "yhat", F.lit("baseline").alias("model"))
    for f in fits:
        out = out.unionByName(D.predict(coefs, test, f.version, SER).select(*out.columns))
    return out


@query("fit_direct_forecaster")
def q_fit_direct_forecaster(spark, sf):
    """Direct models v1 (lags + calendar), v2 (+ four hashed categories), v3
    (+ exogenous): validation error and the size of the coefficient row."""
    _, fits = _direct(spark, sf)
    t = D.table(spark, fits)
    return t.select("version", "lags", F.size("intercepts").alias("n_steps"), F.size(F.col("numeric")[0]).alias("n_numeric"),
                    F.size("slots").alias("n_slots"), "val_mae")


@query("predict_direct")
def q_predict_direct(spark, sf):
    """7 steps of direct v3 with its band from every test origin, the last
    ones reaching past the data (y is null there)."""
    frame, fits = _direct(spark, sf)
    return D.predict(D.table(spark, fits), frame.filter("split = 'test'"), "v3", SER)


@query("predict_direct_future")
def q_predict_direct_future(spark, sf):
    """The 7 days after the data, every region and version, with bands."""
    frame, fits = _direct(spark, sf)
    last, coefs, out = D.last_origins(frame, SER), D.table(spark, fits), None
    for f in fits:
        p = D.predict(coefs, last, f.version, SER).drop("y")
        out = p if out is None else out.unionByName(p)
    return out


@query("forecast_requests")
def q_forecast_requests(spark, sf):
    """JSON requests (each region's last 30 to 60 days, versions v1 to v3;
    every third one is too short) to 7 days with bands; invalid requests come
    as rows with their reasons."""
    _, fits = _direct(spark, sf)
    bodies = forecast_request_bodies(spark, sf)
    good, bad = serving.forecast_requests(bodies, D.table(spark, fits), list(D.VERSIONS))
    return good.withColumn("reasons", F.lit(None).cast("array<string>")).unionByName(
        bad.select("request_id", "model_version", "reasons"), allowMissingColumns=True)


def forecast_request_bodies(spark, sf):
    """Request bodies made of the daily series: one per region and month end,
    with the 45 (for every third month 20) days before it as history."""
    rs, _ = region_series(spark, sf)
    w = S.Window.partitionBy(*SER).orderBy("ds").rowsBetween(-44, 0)
    point = F.struct(F.date_format("ds", "yyyy-MM-dd").alias("date"), "region", "sku_category", F.col("y").alias("shipping_weight_kg"),
                     "request_urgency", "shipping_method", "avg_repair_cycle_days", "failure_rate_pct",
                     F.weekday("ds").alias("day_of_week"), F.month("ds").alias("month"))
    ends = rs.withColumn("history", F.collect_list(point).over(w)).where(F.last_day("ds") == F.col("ds"))
    short = F.month("ds") % 3 == 0
    history = F.when(short, F.slice("history", -20, 20)).otherwise(F.col("history"))
    ends = ends.where(F.size("history") == 45)
    return ends.select(F.to_json(F.struct(
        F.concat_ws("-", "region", F.date_format("ds", "yyyyMMdd")).alias("request_id"), history.alias("historical_data"),
        F.concat(F.lit("v"), (F.month("ds") % 3 + 1).cast("string")).alias("model_version"))).alias("body"))


@query("save_direct_forecaster")
def q_save_direct_forecaster(spark, sf):
    """Save all direct versions, load them back, forecast the future."""
    import uuid
    frame, fits = _direct(spark, sf)
    root = sinks.output_root(spark, f"direct-{uuid.uuid4().hex[:12]}")
    out = None
    for f in fits:
        D.save(spark, root, f)
        loaded = D.load(spark, root, f.version)
        p = D.predict(D.table(spark, [loaded]), D.last_origins(frame, SER), f.version, SER).drop("y")
        out = p if out is None else out.unionByName(p)
    return out


def _seasonal(spark, sf):
    def build():
        rs, _ = region_series(spark, sf)
        train = rs.filter(F.col("split") == "train")
        return {v: FC.fit_seasonal(train, SER, v).cache() for v in FC.VERSIONS}
    return _memo(("seasonal", spark.sparkContext.applicationId, sf), build)


def _seasonal_preds(spark, sf, split: str = "test"):
    rs, _ = region_series(spark, sf)
    rows = rs.filter(F.col("split") == split)
    out = None
    for v, coefs in _seasonal(spark, sf).items():
        p = FC.predict_seasonal(rows, coefs, v, series=SER).select(
            *SER, "ds", "y", "yhat", "yhat_lower", "yhat_upper", F.lit(f"seasonal_{v}").alias("model"))
        out = p if out is None else out.unionByName(p)
    return out


@query("fit_seasonal_forecaster")
def q_fit_seasonal_forecaster(spark, sf):
    """Per-region coefficients of the seasonal model, v1 and v2: all that a
    prediction takes, besides their numbers."""
    out = None
    for v, c in _seasonal(spark, sf).items():
        c = c.select(F.lit(v).alias("version"), "series", "t0", "span_days", "y_scale",
                     F.size("changepoints").alias("n_changepoints"), F.size("beta").alias("n_coef"),
                     "sigma", "n_train", "log_target", "changepoints", "reg_mean", "reg_std", "beta")
        out = c if out is None else out.unionByName(c)
    return out


@query("predict_seasonal")
def q_predict_seasonal(spark, sf):
    """yhat and the 80% band on the test dates, both versions."""
    return _seasonal_preds(spark, sf, "test")


@query("predict_seasonal_future")
def q_predict_seasonal_future(spark, sf):
    """The 30 days after the training data for every region, both versions:
    the last slope goes on, regressors known for a date join, the band widens."""
    rs, _ = region_series(spark, sf)
    known = rs.filter("split <> 'train'").select(*SER, "ds", "failure_rate_pct", "avg_urgency")
    out = None
    for v, coefs in _seasonal(spark, sf).items():
        p = FC.predict_future(coefs, 30, v, known, SER).withColumn("model", F.lit(f"seasonal_{v}"))
        out = p if out is None else out.unionByName(p)
    return out


@query("save_seasonal_forecaster")
def q_save_seasonal_forecaster(spark, sf):
    """Save both seasonal versions, load them back, forecast the future."""
    import uuid
    root, out = sinks.output_root(spark, f"seasonal-{uuid.uuid4().hex[:12]}"), None
    for v, coefs in _seasonal(spark, sf).items():
        FC.save_seasonal(spark, root, coefs, v)
        p = FC.predict_future(FC.load_seasonal(spark, root, v), S.HORIZON, v).withColumn("model", F.lit(f"seasonal_{v}"))
        out = p if out is None else out.unionByName(p)
    return out


@query("forecast_components")
def q_forecast_components(spark, sf):
    """trend / weekly / yearly / regressor parts on the training history
    (model scale; they add up to the model-scale prediction)."""
    rs, _ = region_series(spark, sf)
    tr = rs.filter(F.col("split") == "train")
    c = FC.predict_seasonal(tr, _seasonal(spark, sf)["v2"], "v2", with_components=True, series=SER)
    return c.select(*SER, "ds", "y", "yhat", "trend", "weekly", "yearly", "extra_regressors",
                    "model_scale_yhat",
                    (F.abs(F.col("trend") + F.col("weekly") + F.col("yearly") + F.col("extra_regressors")
                           - F.col("model_scale_yhat")) < 1e-6).alias("components_sum_ok"))


@query("weekly_component_profile")
def q_weekly_component_profile(spark, sf):
    """Mean weekly effect by day of week (0 = Monday) per region."""
    comp = q_forecast_components(spark, sf)
    return comp.groupBy(*SER, F.weekday("ds").alias("day_of_week")).agg(
        F.avg("weekly").alias("mean_weekly_effect"))


@query("changepoints")
def q_changepoints(spark, sf):
    return FC.changepoints_table(_seasonal(spark, sf)["v1"])


@query("backtest")
def q_backtest(spark, sf):
    """Expanding-window backtest of seasonal v1 per region: folds fitted in
    parallel (one group per region and fold), metrics by horizon."""
    rs, _ = region_series(spark, sf)
    folds = S.cv_folds(rs.select(*SER, "ds", "y"), "ds", 7, 30, 365)
    coefs = FC.fit_seasonal(folds.filter(F.col("role") == "train"), SER, "v1", fold_col="fold")
    test = folds.filter(F.col("role") == "test")
    preds = FC.predict_seasonal(test, coefs, "v1", series=SER)
    return V.backtest_metrics(preds.select(*SER, "cutoff", "ds", "y", "yhat"), SER)


def _family_metrics(spark, sf):
    d = V.regression_metrics(_direct_preds(spark, sf), ["model"])
    s = V.regression_metrics(_seasonal_preds(spark, sf, "test"), ["model"])
    rs, _ = region_series(spark, sf)
    tr, te = rs.filter(F.col("split") == "train"), rs.filter(F.col("split") == "test")
    pb = S.persistence_forecast(tr, te, SER, "y", "ds").withColumn("model", F.lit("baseline"))
    b = V.regression_metrics(pb, ["model"])
    return b, d, s


@query("compare_versions")
def q_compare_versions(spark, sf):
    """Seasonal v1 vs v2 against the last-value baseline on the test dates."""
    b, _, s = _family_metrics(spark, sf)
    return V.compare_models(b.unionByName(s), "baseline")


@query("cross_family_table")
def q_cross_family_table(spark, sf):
    """Baseline, direct v1-v3 and seasonal v1-v2 side by side with the
    improvement over the last-value baseline of each evaluation set."""
    b, d, s = _family_metrics(spark, sf)
    direct = V.compare_models(d, "baseline").withColumn("family", F.lit("direct"))
    seas = V.compare_models(b.unionByName(s), "baseline").withColumn(
        "family", F.when(F.col("model") == "baseline", "baseline").otherwise("seasonal"))
    return direct.unionByName(seas)
