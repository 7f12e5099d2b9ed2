"""Direct forecaster, request scoring, forecasts past the data, persistence, quantiles."""

import datetime as dt
import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidal.operators import direct as D
from tidal.operators import evaluate as V
from tidal.operators import forecast as FC
from tidal.operators import series as S
from tidal.operators import serving

START = dt.date(2021, 3, 1)
METHODS = ["air", "express", "ground"]


def daily_rows(days=160):
    rng = np.random.default_rng(5)
    for region, level in (("A", 50.0), ("B", 200.0)):
        for i in range(days):
            d = START + dt.timedelta(days=i)
            method = METHODS[i % 3]
            y = level + 10 * np.sin(2 * np.pi * i / 7) + (20 if method == "air" else 0) + rng.normal(0, 1)
            yield region, d, float(y), "ALL", int(i % 3) + 1, method, 5.0 + i % 4, 0.5 * (i % 5)


SCHEMA = ("region string, ds date, y double, sku_category string, request_urgency int, shipping_method string, "
          "avg_repair_cycle_days double, failure_rate_pct double")


@pytest.fixture(scope="module")
def fitted(spark):
    daily = spark.createDataFrame(list(daily_rows()), SCHEMA)
    frame = D.origin_frame(daily, ["region"]).cache()
    cut = START + dt.timedelta(days=120)
    train = frame.where((F.col("ds") < cut) & (F.size("targets") == S.HORIZON))
    fits = D.with_band([D.fit(train, v) for v in D.VERSIONS], frame.where(F.col("ds") >= cut))
    return daily, frame, fits


def test_origins_need_a_whole_history_but_not_a_whole_future(spark, fitted):
    _, frame, _ = fitted
    by = {r["region"]: r for r in frame.groupBy("region").agg(F.count("*").alias("n"), F.min(F.size("targets")).alias("m")).collect()}
    assert {r["n"] for r in by.values()} == {160 - 29} and {r["m"] for r in by.values()} == {0}
    r = frame.where("region = 'A'").orderBy("ds").first()
    ys = [x[2] for x in daily_rows() if x[0] == "A"]
    assert r["lags"] == ys[29::-1] and r["targets"] == ys[30:37]


def test_projection_equals_the_fitted_pipeline(spark, fitted):
    _, frame, fits = fitted
    for f in fits:
        ours = {(r["region"], r["ds"]): r["yhat"] for r in D.steps(D.table(spark, [f]), frame, F.lit(f.version)).collect()}
        theirs = D.pipeline_predictions(f, frame, ["region", "ds"]).collect()
        assert len(theirs) == len(ours) == frame.count()
        assert max(np.abs(np.array(ours[r["region"], r["ds"]]) - np.array(r["yhat"])).max() for r in theirs) < 1e-6


def test_every_version_beats_the_last_value(spark, fitted):
    _, frame, fits = fitted
    test = frame.where((F.col("ds") >= START + dt.timedelta(days=120)) & (F.size("targets") == S.HORIZON))
    base = test.select(F.explode("targets").alias("y"), F.col("lags")[0].alias("p")).agg(F.avg(F.abs(F.col("y") - F.col("p")))).first()[0]
    for f in fits:
        mae = D.predict(D.table(spark, [f]), test, f.version, ["region"]).agg(F.avg(F.abs(F.col("y") - F.col("yhat")))).first()[0]
        assert mae < base


def request(rid, points, version="v3"):
    return json.dumps({"request_id": rid, "model_version": version, "historical_data": [
        {"date": str(p[1]), "region": p[0], "sku_category": p[3], "shipping_weight_kg": p[2], "request_urgency": p[4],
         "shipping_method": p[5], "avg_repair_cycle_days": p[6], "failure_rate_pct": p[7], "day_of_week": p[1].weekday(),
         "month": p[1].month} for p in points]})


def test_requests_equal_batch_predictions(spark, fitted):
    _, frame, fits = fitted
    rows = [r for r in daily_rows() if r[0] == "B"]
    shuffled = [rows[59:100][k] for k in np.random.default_rng(1).permutation(41)]
    bodies = [request("whole", shuffled), request("v1", rows[70:100], "v1"), request("short", rows[80:100]),
              request("other", rows[70:100], "v9"), "no json", json.dumps({"request_id": "none"}),
              request("range", [(*r[:4], 7, *r[5:]) for r in rows[70:100]])]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    coefs = D.table(spark, fits)
    good, bad = serving.forecast_requests(df, coefs, list(D.VERSIONS))
    good = {(r["request_id"], r["day"]): r for r in good.collect()}
    assert {k[0] for k in good} == {"whole", "v1"} and len(good) == 14
    origin = frame.where((F.col("region") == "B") & (F.col("ds") == rows[99][1]))
    for name, version in (("whole", "v3"), ("v1", "v1")):
        for r in D.predict(coefs, origin, version, ["region"]).collect():
            g = good[name, r["h"]]
            assert g["predicted_weight_kg"] == pytest.approx(r["yhat"]) and g["ds"] == r["ds"]
            assert (g["confidence_lower"], g["confidence_upper"]) == pytest.approx((r["lower"], r["upper"]))
    reasons = {r["request_id"]: r["reasons"] for r in bad.collect()}
    assert reasons["short"] == ["history<30"] and reasons["other"] == ["model_version"] and reasons["range"] == ["request_urgency"]
    assert reasons[None] == reasons["none"] == ["historical_data", "history<30"]


def test_forecasts_past_the_last_actual(spark, fitted):
    _, frame, fits = fitted
    out = D.predict(D.table(spark, fits), D.last_origins(frame, ["region"]), "v2", ["region"]).collect()
    end = START + dt.timedelta(days=159)
    assert sorted((r["region"], r["ds"]) for r in out) == [(g, end + dt.timedelta(days=h)) for g in "AB" for h in range(1, 8)]
    assert all(r["y"] is None and r["lower"] < r["yhat"] < r["upper"] for r in out)


def test_direct_models_reload_with_equal_predictions(spark, fitted):
    _, frame, fits = fitted
    root = tempfile.mkdtemp(prefix="tidal-direct-")
    for f in fits:
        D.save(spark, root, f)
    loaded = D.load(spark, root, "v2")
    a = D.predict(D.table(spark, fits), frame, "v2", ["region"])
    b = D.predict(D.table(spark, [loaded]), frame, "v2", ["region"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    p, q = (D.pipeline_predictions(m, frame, ["region", "ds"]) for m in (fits[1], loaded))
    assert p.exceptAll(q).count() == 0
    with pytest.raises(FileNotFoundError, match="v1.*v2.*v3"):
        D.load(spark, root, "v7")


def test_many_categories_do_not_limit_the_fit(spark):
    rows = [("R%05d" % (i % 6000), START + dt.timedelta(days=i), float(i % 9), "ALL", 1, "air", 1.0, 1.0) for i in range(6100)]
    frame = D.origin_frame(spark.createDataFrame(rows, SCHEMA), [], horizon=2)
    f = D.fit(frame.where(F.size("targets") == 2), "v2", horizon=2)
    assert len(f.row[4]) > 2500 and len(f.row[2]) == 2


# ---- seasonal model past the data ---------------------------------------------------

def line(days, slope_change=True):
    for i in range(days):
        yield "A", START + dt.timedelta(days=i), 100.0 + 0.2 * i + (0.5 * max(0, i - 150) if slope_change else 0.0) + (i * 37 % 11) / 10


def test_seasonal_forecast_goes_on_with_a_widening_band(spark):
    df = spark.createDataFrame([*line(800), *[("B", d, y / 2) for _, d, y in line(750)]], "region string, ds date, y double")
    coefs = FC.fit_seasonal(df, ["region"], "v1", multiplicative=False)
    out = FC.predict_future(coefs, 60, "v1", series=["region"]).orderBy("series", "ds").collect()
    assert [(r["series"], r["ds"]) for r in out] == [(s, START + dt.timedelta(days=n + k)) for s, n in (("A", 800), ("B", 750)) for k in range(60)]
    a = [r for r in out if r["series"] == "A"]
    truth = np.array([100.5 + 0.2 * i + 0.5 * (i - 150) for i in range(800, 860)])
    assert np.mean(np.abs(np.array([r["yhat"] for r in a]) - truth) / truth) < 0.03
    width = np.array([r["yhat_upper"] - r["yhat_lower"] for r in a])
    assert (np.diff(width) > 0).all()
    # the variance is that of a simulation of random slope changes
    c = coefs.where("series = 'A'").first()
    n = len(c["changepoints"])
    b, tau, rng = np.mean(np.abs(c["beta"][2:2 + n])), 60 / c["span_days"], np.random.default_rng(0)
    sims = []
    for _ in range(4000):
        k = rng.poisson(n * tau)
        sims.append((rng.laplace(0, b, k) * (tau - rng.uniform(0, tau, k))).sum())
    z = FC.INTERVAL_Z * c["y_scale"]
    assert width[-1] / 2 == pytest.approx(z * np.sqrt(c["sigma"] ** 2 + np.var(sims)), rel=0.1)
    history = FC.predict_seasonal(df.where("region = 'A'"), coefs, "v1", series=["region"]).collect()
    assert np.allclose([r["yhat_upper"] - r["yhat_lower"] for r in history], 2 * z * c["sigma"])


def test_future_regressors_join_or_take_the_training_mean(spark):
    rows = [("A", d, y, 1.0 if d.day >= 28 else 0.0, 2.0 + (d.day % 3), 1.5) for _, d, y in line(200)]
    df = spark.createDataFrame(rows, "region string, ds date, y double, is_month_end double, failure_rate_pct double, avg_urgency double")
    coefs = FC.fit_seasonal(df, ["region"], "v2", multiplicative=False)
    end = START + dt.timedelta(days=199)
    known = spark.createDataFrame([("A", end + dt.timedelta(days=1), 9.0)], "region string, ds date, failure_rate_pct double")
    got = FC.future_rows(coefs, 3, "v2", known, ["region"]).orderBy("ds").collect()
    mean = np.mean([r[4] for r in rows])
    assert [r["failure_rate_pct"] for r in got] == pytest.approx([9.0, mean, mean])
    assert [r["avg_urgency"] for r in got] == pytest.approx([1.5] * 3)
    root = tempfile.mkdtemp(prefix="tidal-seasonal-")
    FC.save_seasonal(spark, root, coefs, "v2")
    a = FC.predict_future(coefs, 5, "v2", known, ["region"])
    b = FC.predict_future(FC.load_seasonal(spark, root, "v2"), 5, "v2", known, ["region"])
    assert a.exceptAll(b).count() == 0 and a.count() == 5
    with pytest.raises(FileNotFoundError, match="v2"):
        FC.load_seasonal(spark, root, "v1")


def test_exact_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [("hot", float(v)) for v in rng.normal(size=5001)] + [("hot", 0.25)] * 3000 + [("one", 4.0), ("two", 1.0), ("two", 2.0), (None, 7.0),
                                                                                       ("two", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]
    got = {(r["k"], r["p"]): r["quantile"] for r in V.exact_quantiles(df, ["k"], "v", probs, accuracy=200).collect()}
    for k in ("hot", "one", "two", None):
        values = [v for kk, v in rows if kk == k and v is not None]
        for p in probs:
            assert got[k, p] == pytest.approx(np.quantile(values, p)), (k, p)
    whole = {r["p"]: r["quantile"] for r in V.exact_quantiles(df, [], "v", [0.5]).collect()}
    assert whole[0.5] == pytest.approx(np.quantile([v for _, v in rows if v is not None], 0.5))


def test_region_series_reads_the_records_once(spark, monkeypatch):
    from tidal.plans import q_forecast as QF
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i % 40), f"R{i % 2}", 10.0 + i, 1 + i % 3, "air", 5.0, 1.0, 0) for i in range(200)]
    schema = ("date date, region string, shipping_weight_kg double, request_urgency int, shipping_method string, "
              "avg_repair_cycle_days double, failure_rate_pct double, is_quarter_end int")
    monkeypatch.setattr(QF.T, "shipments", lambda *_: spark.createDataFrame(rows, schema).mapInArrow(tell, schema))
    monkeypatch.setattr(QF, "_MEMO", {})
    rs, _ = QF.region_series(spark, "none")
    try:
        assert rs.agg(F.round(F.sum("y"), 6)).first()[0] == sum(r[2] for r in rows)
        assert seen.value == len(rows)
    finally:
        rs.unpersist()


def test_fitted_seasonal_coefficients_are_whole_and_predict(spark, monkeypatch):
    from tidal.plans import q_forecast as QF
    rows = [(dt.date(2023, 1, 1) + dt.timedelta(days=i // 2), f"R{i % 2}", 10.0 + i % 7 + i % 2, 1 + i % 3, "air", 5.0, 1.0 + i % 4, 0)
            for i in range(300)]
    schema = ("date date, region string, shipping_weight_kg double, request_urgency int, shipping_method string, "
              "avg_repair_cycle_days double, failure_rate_pct double, is_quarter_end int")
    monkeypatch.setattr(QF.T, "shipments", lambda *_: spark.createDataFrame(rows, schema))
    monkeypatch.setattr(QF, "_MEMO", {})
    fitted = QF.q_fit_seasonal_forecaster(spark, "none")
    got = fitted.collect()
    assert sorted((r["version"], r["series"]) for r in got) == [(v, s) for v in ("v1", "v2") for s in ("R0", "R1")]
    for r in got:
        regs = len(FC.VERSIONS[r["version"]]["regressors"])
        assert len(r["changepoints"]) == r["n_changepoints"] and len(r["reg_mean"]) == len(r["reg_std"]) == regs
        assert len(r["beta"]) == r["n_coef"] == 2 + r["n_changepoints"] + 2 * (FC.WEEKLY_ORDER + FC.YEARLY_ORDER) + regs
    rs, _ = QF.region_series(spark, "none")
    test = rs.where("split = 'test'")
    want = {(r["model"], r["region"], r["ds"]): r["yhat"] for r in QF.q_predict_seasonal(spark, "none").collect()}
    for v in FC.VERSIONS:
        coefs = fitted.where(F.col("version") == v).drop("version")
        for r in FC.predict_seasonal(test, coefs, v, series=["region"]).collect():
            assert r["yhat"] == pytest.approx(want.pop((f"seasonal_{v}", r["region"], r["ds"])))
    assert not want
    rs.unpersist()
