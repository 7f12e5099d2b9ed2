"""Forecast evaluation: one declarative aggregation per metric table.

Inputs are long prediction tables (model[, series], origin/ds, h, y, yhat):
one row per forecast point, already far smaller than the raw records.
"""

from __future__ import annotations

import statistics

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import BAND_Z, relative_improvement

EPS = 1e-8
def PER_MODEL():
    """Whole-frame window, used on per-model metric rows only."""
    return Window.partitionBy()


def _err(y: str, yhat: str) -> Column:
    return F.col(yhat) - F.col(y)


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float], accuracy: int = 20_000) -> DataFrame:
    """(by..., p, quantile): exact linear-interpolation quantiles without one
    task holding a group's values. A quantile sketch brackets each one within
    about ``2 / accuracy`` of the ranks; the values below a bracket are counted,
    those inside are counted by value and only they are put in order."""
    v = df.where(F.col(value).isNotNull()).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
                                                  F.col(value).cast("double").alias("_v"))
    keys = [f"_k{i}" for i in range(len(by))]
    wide = sorted({x for p in probs for x in (max(0.0, p - 2.0 / accuracy), min(1.0, p + 2.0 / accuracy))})
    sketch = v.groupBy(*keys).agg(F.percentile_approx("_v", wide, accuracy).alias("_q"), F.count(F.lit(1)).alias("_n"),
                                  F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    ends = [(p, wide.index(max(0.0, p - 2.0 / accuracy)), wide.index(min(1.0, p + 2.0 / accuracy))) for p in probs]
    few = F.col("_n") <= accuracy  # a bracket might not hold two ranks: take all values
    brackets = sketch.select(*keys, "_n", F.explode(F.array(*[F.struct(
        F.lit(float(p)).alias("p"), F.when(few | F.lit(p <= 2.0 / accuracy), F.col("_min")).otherwise(F.col("_q")[a]).alias("lo"),
        F.when(few | F.lit(p >= 1 - 2.0 / accuracy), F.col("_max")).otherwise(F.col("_q")[b]).alias("hi")) for p, a, b in ends])).alias("_b"))
    lists = brackets.groupBy(*keys).agg(F.first("_n").alias("_n"), F.collect_list("_b").alias("_bs"))  # one entry a quantile
    if keys:
        cond = None
        for k in keys:
            c = F.col(f"l.{k}").eqNullSafe(F.col(f"v.{k}"))
            cond = c if cond is None else cond & c
        j = v.alias("v").join(lists.alias("l"), cond).select("v.*", "_n", "_bs")
    else:
        r = lists.first()
        if r is None:
            return df.sparkSession.createDataFrame([], "p double, quantile double")
        j = v.withColumn("_n", F.lit(r["_n"])).withColumn("_bs", F.array(*[
            F.struct(F.lit(x["p"]).alias("p"), F.lit(x["lo"]).alias("lo"), F.lit(x["hi"]).alias("hi")) for x in r["_bs"]]))
    # below a bracket every value counts as one group, inside it keeps itself
    hit = j.select(*keys, "_n", "_v", F.explode("_bs").alias("_b")).where(F.col("_v") <= F.col("_b.hi"))
    below = F.col("_v") < F.col("_b.lo")
    c = hit.groupBy(*keys, F.col("_b.p").alias("p"), F.when(~below, F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    w = Window.partitionBy(*keys, "p").orderBy(F.col("_v").asc_nulls_first())
    c = c.withColumn("_last", F.sum("_c").over(w) - 1).withColumn("_rank", F.col("p") * (F.col("_n") - 1))
    low = F.min(F.when(F.col("_last") >= F.floor("_rank"), F.col("_v")))
    high = F.min(F.when(F.col("_last") >= F.ceil("_rank"), F.col("_v")))
    out = c.groupBy(*keys, "p").agg((low + (high - low) * F.first(F.col("_rank") - F.floor("_rank"))).alias("quantile"))
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "p", "quantile")


def regression_metrics(df: DataFrame, by: list[str] = ("model",), y: str = "y",
                       yhat: str = "yhat") -> DataFrame:
    """mae, mse, rmse, mape_eps (%), r2 (NULL when the actuals are constant),
    max_error, exact median_ae per group; a model with most of the errors is
    spread over all tasks (``exact_quantiles``)."""
    by = list(by)
    e = _err(y, yhat)
    ae = F.abs(e)
    g = df.groupBy(*by).agg(
        F.avg(ae).alias("mae"), F.avg(e * e).alias("mse"),
        (F.avg(ae / (F.abs(F.col(y)) + F.lit(EPS))) * 100).alias("mape_eps"),
        F.sum(e * e).alias("_ss_res"), (F.var_pop(y) * F.count(F.lit(1))).alias("_ss_tot"),
        F.max(ae).alias("max_error"), F.count(F.lit(1)).alias("n"))
    med = exact_quantiles(df.select(*by, ae.alias("_ae")), by, "_ae", [0.5])
    med = med.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate(by)], F.col("quantile").alias("median_ae"))
    cond = F.lit(True)
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_m{i}"))
    g = g.join(med, cond, "left")
    return g.select(*by, "mae", "mse", F.sqrt("mse").alias("rmse"), "mape_eps",
                    F.when(F.col("_ss_tot") > 0, 1 - F.col("_ss_res") / F.col("_ss_tot"))
                    .alias("r2"), "max_error", "median_ae", "n")


def mape_nonzero(df: DataFrame, by: list[str] = ("model",), y: str = "y",
                 yhat: str = "yhat") -> DataFrame:
    """MAPE (%) over rows with a non-zero actual; +infinity when none."""
    nz = F.col(y) != 0
    g = df.groupBy(*by).agg(
        F.avg(F.when(nz, F.abs((F.col(y) - F.col(yhat)) / F.col(y)))).alias("_m"),
        F.count(F.when(nz, 1)).alias("_n"))
    return g.select(*by, F.when(F.col("_n") > 0, F.col("_m") * 100)
                    .otherwise(F.lit(float("inf"))).alias("mape_nonzero"))


def validation_report(df: DataFrame, by: list[str] = ("model",), y: str = "y",
                      yhat: str = "yhat") -> DataFrame:
    """mae, mse, rmse and MAPE over non-zero actuals (+inf when none) in one
    aggregation."""
    e = _err(y, yhat)
    nz = F.col(y) != 0
    g = df.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.avg(F.when(nz, F.abs((F.col(y) - F.col(yhat)) / F.col(y)))).alias("_m"),
        F.count(F.when(nz, 1)).alias("_n"))
    return g.select(*by, "mae", "mse", F.sqrt("mse").alias("rmse"),
                    F.when(F.col("_n") > 0, F.col("_m") * 100).otherwise(F.lit(float("inf"))).alias("mape"))


def huber_loss(df: DataFrame, by: list[str] = ("model",), y: str = "y", yhat: str = "yhat",
               delta: float = 1.0) -> DataFrame:
    ae = F.abs(_err(y, yhat))
    loss = F.when(ae <= delta, 0.5 * ae * ae).otherwise(delta * (ae - 0.5 * delta))
    return df.groupBy(*by).agg(F.avg(loss).alias("huber"), F.avg(ae).alias("mae"),
                               F.avg(ae * ae).alias("mse"))


def per_horizon_metrics(df: DataFrame, by: list[str] = ("model",), h: str = "h",
                        y: str = "y", yhat: str = "yhat") -> DataFrame:
    e = _err(y, yhat)
    return df.groupBy(*by, h).agg(F.avg(F.abs(e)).alias("mae"),
                                  F.sqrt(F.avg(e * e)).alias("rmse"))


def per_sample_mae(df: DataFrame, keys: list[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.abs(_err(y, yhat))).alias("mae"))


def compare_models(metrics: DataFrame, baseline: str = "baseline", model: str = "model",
                   cols=("mae", "mse", "rmse")) -> DataFrame:
    """Metrics plus percent improvement over the baseline row (NULL for the
    baseline itself and when the baseline metric is not > 0)."""
    out = metrics
    for c in cols:
        base = F.max(F.when(F.col(model) == baseline, F.col(c))).over(PER_MODEL())
        out = out.withColumn(f"{c}_improvement_pct",
                             F.when(F.col(model) != baseline, relative_improvement(base, c)))
    return out


def best_model(metrics: DataFrame, metric: str = "mae", model: str = "model") -> DataFrame:
    """Lowest-metric model (ties: smallest name)."""
    return metrics.agg(F.min_by(model, F.struct(metric, model)).alias("best_model"),
                       F.min(metric).alias(f"best_{metric}"))


def forecast_band(df: DataFrame, mae: float, yhat: str = "yhat", z: float = BAND_Z) -> DataFrame:
    """yhat +- z * validation MAE."""
    return df.withColumn("lower", F.col(yhat) - F.lit(z * mae)) \
             .withColumn("upper", F.col(yhat) + F.lit(z * mae))


def interval_coverage(df: DataFrame, by: list[str] = (), y: str = "y", lower: str = "lower",
                      upper: str = "upper") -> DataFrame:
    inside = (F.col(y) >= F.col(lower)) & (F.col(y) <= F.col(upper))
    return df.groupBy(*by).agg(
        (F.avg(inside.cast("double")) * 100).alias("coverage_pct"),
        F.sum(inside.cast("long")).alias("n_inside"),
        F.sum((~inside).cast("long")).alias("n_outside"))


def normal_quantile_grid(m: int = 99, lo: float = 0.001, hi: float = 0.999):
    """(p, z) pairs on an even probability grid, z = inverse standard normal."""
    nd = statistics.NormalDist()
    ps = [lo + (hi - lo) * i / (m - 1) for i in range(m)]
    return [(p, nd.inv_cdf(p)) for p in ps]


def error_quantiles(df: DataFrame, y: str = "y", yhat: str = "yhat", m: int = 99) -> DataFrame:
    """Q-Q table: empirical error quantiles (linear interpolation) beside
    exact normal quantiles on the same probability grid."""
    grid = normal_quantile_grid(m)
    e = df.select(_err(y, yhat).alias("_e"))
    q = exact_quantiles(e, [], "_e", [p for p, _ in grid])
    sd = e.agg(F.stddev_samp("_e")).first()[0]
    rows = df.sparkSession.createDataFrame([(i, float(p), float(z)) for i, (p, z) in enumerate(grid)], "i int, p double, normal_q double")
    return rows.join(q, "p").select("i", "p", "normal_q", F.col("quantile").alias("error_q"),
                                    (F.col("normal_q") * F.lit(sd).cast("double")).alias("reference_q"))


def backtest_metrics(preds: DataFrame, by: list[str] = (), cutoff: str = "cutoff", ds: str = "ds",
                     y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Metrics per horizon (days after the cutoff), then averaged over
    horizons: cv_mae, cv_mse, cv_rmse, cv_mape (a fraction, not %)."""
    e = _err(y, yhat)
    per_h = preds.withColumn("horizon", F.datediff(ds, cutoff)).groupBy(*by, "horizon").agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.avg(F.try_divide(F.abs(e), F.abs(F.col(y)))).alias("mape"))
    per_h = per_h.withColumn("rmse", F.sqrt("mse"))
    return per_h.groupBy(*by).agg(F.avg("mae").alias("cv_mae"), F.avg("mse").alias("cv_mse"),
                                  F.avg("rmse").alias("cv_rmse"), F.avg("mape").alias("cv_mape"))
