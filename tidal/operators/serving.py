"""Forecast requests to forecasts: JSON rows in, seven days with a band out.

Every request carries its history, so nothing is looked up or grouped: the
history array gives the lags, its last point the calendar, the categories and
the exogenous numbers, and ``direct.steps`` does the rest in one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import requests as RQ
from . import direct as D
from . import series as S


def request_features(requests: DataFrame, lags: int = S.HISTORY) -> DataFrame:
    """Valid requests with the columns ``direct.steps`` needs."""
    last = F.element_at("history", -1)
    recent = F.reverse(F.slice("history", -lags, lags))
    return requests.select(
        "request_id", "model_version", F.transform(recent, lambda p: p["shipping_weight_kg"].cast("double")).alias("lags"),
        last["day_of_week"].cast("double").alias("dow"), last["month"].cast("double").alias("month"),
        F.to_date(last["date"]).alias("origin"), *[last[c].alias(c) for c in (*D.CATEGORIES, *D.EXOGENOUS)])


def forecast_requests(bodies: DataFrame, coefs: DataFrame, versions: list[str], json_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """(forecasts, quarantine). Forecasts: request_id, day (1..7), ds,
    predicted_weight_kg, confidence_lower, confidence_upper, model_version.
    Quarantine: request_id, model_version, n_points, reasons."""
    checked = RQ.validate_histories(RQ.parse_forecast_histories(bodies, json_col), versions)
    good = request_features(checked.where("is_valid"))
    s = D.steps(coefs, good, F.col("model_version"))
    band = F.lit(D.BAND_Z) * F.col("val_mae")
    out = s.select("request_id", "model_version", "origin", "val_mae", F.posexplode("yhat").alias("_h", "predicted_weight_kg"))
    forecasts = out.select("request_id", (F.col("_h") + 1).alias("day"), F.date_add("origin", F.col("_h") + 1).alias("ds"),
                           "predicted_weight_kg", (F.col("predicted_weight_kg") - band).alias("confidence_lower"),
                           (F.col("predicted_weight_kg") + band).alias("confidence_upper"), "model_version")
    return forecasts, checked.where("not is_valid").select("request_id", "model_version", "n_points", "reasons")
