"""Seasonal forecaster for many daily series.

Per-series piecewise-linear trend with changepoints plus weekly/yearly
Fourier terms (+ regressors), ridge-penalised. The per-series solve is a
small dense system in ``applyInPandas`` (one group = one series' daily rows,
bounded by the calendar). The design matrix is the same expression in NumPy
(fit) and in Spark SQL (predict and components), so prediction stays a JVM
projection over a one-row-per-series coefficient table. Past the data the
last slope goes on and the band widens by what the fitted slope changes
would do there. The direct forecaster is in ``direct.py``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import sinks
from . import series as S

# Fixed values that must equal the reference's seasonal model settings.
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_PRIOR = 0.05
SEASONALITY_PRIOR = 10.0
REGRESSOR_PRIOR = 10.0
WEEKLY_ORDER = 3
YEARLY_ORDER = 10
INTERVAL_Z = 1.2815515655446004  # two-sided 80% normal interval
REGRESSORS = ["is_month_end", "failure_rate_pct", "avg_urgency"]
VERSIONS = {"v1": {"regressors": []}, "v2": {"regressors": REGRESSORS}}
EPOCH = "1970-01-01"
SEASONAL_NAME = "seasonal_forecaster"

# -------------------------------------------------------------- seasonal model

def _fourier_np(days: np.ndarray, period: float, order: int) -> np.ndarray:
    cols = []
    for k in range(1, order + 1):
        a = 2.0 * math.pi * k * days / period
        cols += [np.sin(a), np.cos(a)]
    return np.column_stack(cols) if cols else np.zeros((len(days), 0))


def design_np(days: np.ndarray, t: np.ndarray, cps: np.ndarray, regs: np.ndarray) -> np.ndarray:
    """[1, t, (t - cp_j)+ ..., weekly sin/cos, yearly sin/cos, regressors]."""
    hinge = np.maximum(t[:, None] - cps[None, :], 0.0) if len(cps) else np.zeros((len(t), 0))
    return np.column_stack([np.ones_like(t), t, hinge, _fourier_np(days, 7.0, WEEKLY_ORDER),
                            _fourier_np(days, 365.25, YEARLY_ORDER), regs])


def _changepoints(t: np.ndarray, n: int = N_CHANGEPOINTS, rng: float = CHANGEPOINT_RANGE) -> np.ndarray:
    """Evenly spaced over the first ``rng`` share of the history rows (the
    first row excluded)."""
    hist = int(np.floor(len(t) * rng))
    if hist <= 1 or n <= 0:
        return np.zeros(0)
    n = min(n, hist - 1)
    idx = np.linspace(0, hist - 1, n + 1).round().astype(int)[1:]
    return t[idx]


COEF_SCHEMA = T.StructType([
    T.StructField("series", T.StringType()),
    T.StructField("fold", T.IntegerType()),
    T.StructField("t0", T.DateType()),
    T.StructField("span_days", T.DoubleType()),
    T.StructField("y_scale", T.DoubleType()),
    T.StructField("log_target", T.BooleanType()),
    T.StructField("changepoints", T.ArrayType(T.DoubleType())),
    T.StructField("reg_mean", T.ArrayType(T.DoubleType())),
    T.StructField("reg_std", T.ArrayType(T.DoubleType())),
    T.StructField("beta", T.ArrayType(T.DoubleType())),
    T.StructField("sigma", T.DoubleType()),
    T.StructField("n_train", T.LongType()),
])


def _fit_one(pdf: pd.DataFrame, regressors: list[str], multiplicative: bool) -> dict:
    pdf = pdf.sort_values("ds")
    ds = pd.to_datetime(pdf["ds"])
    days = ((ds - pd.Timestamp(EPOCH)) / pd.Timedelta(days=1)).to_numpy(dtype=float)
    t0 = ds.iloc[0]
    span = max(float((ds.iloc[-1] - t0) / pd.Timedelta(days=1)), 1.0)
    t = (days - days[0]) / span
    y = pdf["y"].to_numpy(dtype=float)
    if multiplicative:
        y = np.log1p(np.maximum(y, 0.0))
    y_scale = float(np.max(np.abs(y))) or 1.0
    ys = y / y_scale
    cps = _changepoints(t)
    r = pdf[regressors].to_numpy(dtype=float) if regressors else np.zeros((len(t), 0))
    mean = np.nanmean(r, axis=0) if regressors else np.zeros(0)
    std = np.nanstd(r, axis=0) if regressors else np.zeros(0)
    std = np.where(std > 0, std, 1.0)
    rz = np.nan_to_num((r - mean) / std) if regressors else r
    x = design_np(days, t, cps, rz)
    pen = np.concatenate([[1e-8, 1e-8], np.full(len(cps), 1.0 / CHANGEPOINT_PRIOR ** 2),
                          np.full(2 * (WEEKLY_ORDER + YEARLY_ORDER), 1.0 / SEASONALITY_PRIOR ** 2),
                          np.full(len(regressors), 1.0 / REGRESSOR_PRIOR ** 2)])
    beta = np.linalg.solve(x.T @ x + np.diag(pen), x.T @ ys)
    resid = ys - x @ beta
    return {"t0": t0.date(), "span_days": span, "y_scale": y_scale, "log_target": multiplicative,
            "changepoints": cps.tolist(), "reg_mean": list(map(float, mean)),
            "reg_std": list(map(float, std)), "beta": beta.tolist(),
            "sigma": float(np.sqrt(np.mean(resid ** 2))) if len(resid) else 0.0,
            "n_train": int(len(ys))}


def fit_seasonal(frame: DataFrame, series: list[str], version: str = "v1",
                 multiplicative: bool = True, fold_col: str | None = None) -> DataFrame:
    """One coefficient row per series (and per fold when ``fold_col`` is
    given). Input: (series..., ds, y, regressors...) training rows."""
    from ..session import ship_package
    ship_package(frame.sparkSession)
    regs = VERSIONS[version]["regressors"]
    key = F.concat_ws("|", *[F.col(s).cast("string") for s in series]) if series else F.lit("ALL")
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    data = frame.select(key.alias("series"), fold.alias("fold"), "ds", F.col("y").cast("double"),
                        *[F.col(r).cast("double") for r in regs])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _fit_one(pdf, regs, multiplicative)
        out["series"] = pdf["series"].iloc[0]
        out["fold"] = int(pdf["fold"].iloc[0])
        return pd.DataFrame([out])[[f.name for f in COEF_SCHEMA.fields]]

    return data.groupBy("series", "fold").applyInPandas(fit, COEF_SCHEMA)


def _fourier_sql(days: Column, period: float, order: int) -> Column:
    return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(order)), lambda k: F.array(
        F.sin(F.lit(2.0 * math.pi) * k * days / F.lit(period)),
        F.cos(F.lit(2.0 * math.pi) * k * days / F.lit(period)))))


def design_sql(ds: str = "ds", regressors: list[str] = ()) -> Column:
    """Spark twin of :func:`design_np`; needs the coefficient columns."""
    days = F.datediff(F.col(ds), F.lit(EPOCH).cast("date")).cast("double")
    t = F.datediff(F.col(ds), F.col("t0")).cast("double") / F.col("span_days")
    hinge = F.transform("changepoints", lambda c: F.greatest(t - c, F.lit(0.0)))
    regs = F.array(*[F.coalesce((F.col(r).cast("double") - F.col("reg_mean")[i]) / F.col("reg_std")[i],
                                F.lit(0.0)) for i, r in enumerate(regressors)]) if regressors \
        else F.array().cast("array<double>")
    return F.concat(F.array(F.lit(1.0), t), hinge, _fourier_sql(days, 7.0, WEEKLY_ORDER),
                    _fourier_sql(days, 365.25, YEARLY_ORDER), regs)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _slice_dot(x: Column, beta: Column, start: Column, length: Column) -> Column:
    return _dot(F.slice(x, start, length), F.slice(beta, start, length))


def trend_variance(ds: str = "ds") -> Column:
    """Variance (in units of y_scale) that slope changes after the last
    training day add to the trend; 0 up to that day. As in the history they
    are taken to come at the rate of the fitted changepoints, with Laplace
    sizes of the fitted mean absolute change b: S changes per unit of time,
    each of variance 2 b^2, at uniform places, give 2 S b^2 tau^3 / 3 at a
    distance tau past the data."""
    tau = F.greatest(F.datediff(F.col(ds), F.col("t0")).cast("double") / F.col("span_days") - 1.0, F.lit(0.0))
    n = F.size("changepoints")
    b = F.when(n > 0, F.aggregate(F.slice("beta", F.lit(3), n), F.lit(0.0), lambda s, v: s + F.abs(v)) / n).otherwise(F.lit(0.0))
    return F.lit(2.0) * n * b * b * F.pow(tau, F.lit(3.0)) / 3.0


def future_rows(coefs: DataFrame, periods: int = S.HORIZON, version: str = "v1", regressors: DataFrame | None = None,
                series: list[str] = ()) -> DataFrame:
    """(series, ds, regressors) for the ``periods`` days after every series'
    last training day. Known regressor values join by (series, ds); month
    ends follow from the date; what stays unknown takes the training mean."""
    regs = VERSIONS[version]["regressors"]
    last = coefs.select("series", F.date_add("t0", F.col("span_days").cast("int")).alias("last_date"), "reg_mean")
    out = S.future_frame(last, periods, ["series", "reg_mean"])
    given = [c for c in regs if regressors is not None and c in regressors.columns]
    if given:
        key = F.concat_ws("|", *[F.col(s).cast("string") for s in series]) if series else F.lit("ALL")
        known = regressors.select(key.alias("series"), "ds", *[F.col(c).alias(f"_k_{c}") for c in given])
        out = out.join(known, ["series", "ds"], "left")
    for i, c in enumerate(regs):
        values = [F.col(f"_k_{c}")] if c in given else []
        values += [F.col(c)] if c in out.columns else []
        out = out.withColumn(c, F.coalesce(*values, F.col("reg_mean")[i]).cast("double"))
    return out.select("series", "ds", *regs)


def predict_future(coefs: DataFrame, periods: int = S.HORIZON, version: str = "v1", regressors: DataFrame | None = None,
                   series: list[str] = ()) -> DataFrame:
    """yhat with the widening band for the days after the data, every series."""
    rows = future_rows(coefs, periods, version, regressors, series)
    p = predict_seasonal(rows, coefs, version, series=["series"])
    return p.select("series", "ds", "yhat", "yhat_lower", "yhat_upper")


def save_seasonal(spark: SparkSession, root: str, coefs: DataFrame, version: str, metrics: dict | None = None,
                  description: str = "") -> str:
    """The per-series coefficients as a versioned table."""
    return sinks.save_model(spark, root, SEASONAL_NAME, version, "seasonal_forecaster", {"coefficients": coefs}, metrics or {},
                            {"regressors": VERSIONS[version]["regressors"]}, description)


def load_seasonal(spark: SparkSession, root: str, version: str) -> DataFrame:
    """The saved coefficients; a missing version names those that exist."""
    return sinks.load_model(spark, root, SEASONAL_NAME, version)[1]["coefficients"]


def predict_seasonal(rows: DataFrame, coefs: DataFrame, version: str = "v1",
                     with_components: bool = False, series: list[str] = ()) -> DataFrame:
    """yhat with an 80% band for the given (series, ds[, regressors]) rows, in
    the history or past it (the band widens there, see ``trend_variance``);
    components (trend, weekly, yearly, regressors) on the model scale."""
    regs = VERSIONS[version]["regressors"]
    key = F.concat_ws("|", *[F.col(s).cast("string") for s in series]) if series else F.lit("ALL")
    fold_present = "fold" in rows.columns
    r = rows.withColumn("series", key)
    jkeys = ["series", "fold"] if fold_present else ["series"]
    c = coefs if fold_present else coefs.drop("fold")
    j = r.join(c, jkeys)  # one coefficient row per series (and fold)
    x = design_sql("ds", regs)
    j = j.withColumn("_x", x)
    z = _dot(F.col("_x"), F.col("beta")) * F.col("y_scale")
    sd = F.sqrt(F.pow(F.col("sigma"), 2) + trend_variance("ds")) * F.col("y_scale")
    lo, hi = z - F.lit(INTERVAL_Z) * sd, z + F.lit(INTERVAL_Z) * sd
    back = F.expm1  # model was fitted on log1p(y)
    j = j.withColumn("yhat", F.when(F.col("log_target"), back(z)).otherwise(z)) \
         .withColumn("yhat_lower", F.when(F.col("log_target"), back(lo)).otherwise(lo)) \
         .withColumn("yhat_upper", F.when(F.col("log_target"), back(hi)).otherwise(hi))
    if with_components:
        ncp = F.size("changepoints")
        nw, ny = 2 * WEEKLY_ORDER, 2 * YEARLY_ORDER
        sc = F.col("y_scale")
        j = (j.withColumn("trend", _slice_dot(F.col("_x"), F.col("beta"), F.lit(1), ncp + 2) * sc)
              .withColumn("weekly", _slice_dot(F.col("_x"), F.col("beta"), ncp + 3, F.lit(nw)) * sc)
              .withColumn("yearly", _slice_dot(F.col("_x"), F.col("beta"), ncp + 3 + nw, F.lit(ny)) * sc)
              .withColumn("extra_regressors", _slice_dot(F.col("_x"), F.col("beta"), ncp + 3 + nw + ny,
                                                         F.lit(max(len(regs), 1))) * sc
                          if regs else F.lit(0.0))
              .withColumn("model_scale_yhat", z))
    return j.drop("_x")


def changepoints_table(coefs: DataFrame) -> DataFrame:
    """(series, changepoint date, slope change) — deltas on the model scale."""
    z = coefs.select("series", "t0", "span_days", "y_scale",
                     F.posexplode("changepoints").alias("j", "tc"), "beta")
    return z.select("series", F.date_add("t0", F.round(F.col("tc") * F.col("span_days")).cast("int"))
                    .alias("changepoint"),
                    (F.col("beta")[F.col("j") + 2] * F.col("y_scale")).alias("delta"),
                    F.when(F.col("beta")[F.col("j") + 2] >= 0, "up").otherwise("down").alias("direction"))
