"""Seasonal model recovery, component sums, model round trip, stream == batch."""

import datetime as dt
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from table_paths import SF_SMALL
from tidal.operators import forecast as FC
from tidal.plans.event_model import EventClusteringModel, fit_event_clustering
from tidal.sources import tables as T
from tidal.streaming import events as ST


def test_seasonal_recovers_line_plus_weekly_wave(spark):
    start = dt.date(2022, 1, 1)
    rows = []
    for i in range(500):
        d = start + dt.timedelta(days=i)
        rows.append(("A", d, 100.0 + 0.1 * i + 10.0 * math.sin(2 * math.pi * i / 7.0)))
    df = spark.createDataFrame(rows, "region string, ds date, y double")
    train = df.filter(F.col("ds") < start + dt.timedelta(days=450))
    test = df.filter(F.col("ds") >= start + dt.timedelta(days=450))
    coefs = FC.fit_seasonal(train, ["region"], "v1", multiplicative=False)
    p = FC.predict_seasonal(test, coefs, "v1", with_components=True, series=["region"])
    err = p.agg(F.avg(F.abs(F.col("yhat") - F.col("y")))).first()[0]
    assert err < 2.0
    bad = p.filter(F.abs(F.col("trend") + F.col("weekly") + F.col("yearly") + F.col("extra_regressors")
                         - F.col("model_scale_yhat")) > 1e-6).count()
    assert bad == 0


@pytest.fixture(scope="module")
def fitted(spark):
    ev = T.net_events(spark, SF_SMALL)
    model, _ = fit_event_clustering(ev, k=4, n_init=2)
    return ev, model


def test_save_load_same_predictions(spark, fitted):
    ev, model = fitted
    root = tempfile.mkdtemp(prefix="tidal-model-")
    model.save(spark, root)
    loaded = EventClusteringModel.load(spark, root, model.version)
    a = model.classify(ev).select("event_id", "cluster", F.round("anomaly_score", 9).alias("s"))
    b = loaded.classify(ev).select("event_id", "cluster", F.round("anomaly_score", 9).alias("s"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    with pytest.raises(FileNotFoundError):
        EventClusteringModel.load(spark, root, "v404")


def test_stream_scoring_equals_batch(spark, fitted):
    ev, model = fitted
    base = tempfile.mkdtemp(prefix="tidal-stream-")
    bodies = ST.request_bodies_table(spark, SF_SMALL, f"{base}/bodies")
    as_of = "2024-02-01 12:00:00"
    stream = ST.score_event_stream(spark, bodies, model, f"{base}/sink", f"{base}/ckpt", as_of)
    batch, _ = ST.score_requests(spark.read.parquet(bodies), model, as_of)
    cols = ["event_id", "cluster", "interpretation"]
    s, b = stream.select(*cols), batch.select(*cols)
    assert s.count() == ev.count()
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


@pytest.mark.parametrize("files", [1, 3])
def test_hourly_stream_equals_batch(spark, files):
    base = tempfile.mkdtemp(prefix="tidal-hourly-")
    path = f"{SF_SMALL}/events.parquet"
    if files > 1:  # a folder of part files, not in the order of time
        spark.read.parquet(path).repartition(files, "event_id").write.parquet(f"{base}/events.parquet")
        path = f"{base}/events.parquet"
    out = ST.hourly_event_counts_stream(spark, path, f"{base}/sink", f"{base}/ckpt")
    batch = ST.hourly_counts(T.net_events(spark, SF_SMALL).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")), "timestamp")
    got = {r["window_start"]: r["count"] for r in out.collect()}
    assert got == {r["window_start"]: r["count"] for r in batch.collect()}


def test_histogram_has_empty_bins(spark):
    from tidal.operators.eda import histogram
    h = histogram(spark.createDataFrame([(0.0,), (1.0,), (50.0,)], "v double"), "v", 50).collect()
    assert len(h) == 50 and sum(r["count"] for r in h) == 3
