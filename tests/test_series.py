"""Invariants of the per-series operators on hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from tidal.functions.columns import urgency_bucket
from tidal.operators import aggregate as A
from tidal.operators import evaluate as V
from tidal.operators import series as S


def _series(spark, n, start=dt.date(2024, 1, 1), series="A"):
    rows = [(series, start + dt.timedelta(days=i), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "s string, date date, y double")


def test_sequence_windows_lengths(spark):
    assert S.sequence_windows(_series(spark, 36), ["s"], "y", []).count() == 0
    w = S.sequence_windows(_series(spark, 37), ["s"], "y", []).collect()
    assert len(w) == 1
    r = w[0]
    assert len(r["history"]) == 30 and len(r["target"]) == 7
    assert r["target_dates"][0] == r["history"][-1]["date"] + dt.timedelta(days=1)
    n = 50
    assert S.sequence_windows(_series(spark, n), ["s"], "y", []).count() == n - 30 - 7 + 1
    assert S.sequence_windows(_series(spark, n), ["s"], "y", [], stride=3).count() == 5


def test_windows_are_per_series(spark):
    df = _series(spark, 40, series="A").unionByName(_series(spark, 36, series="B"))
    w = S.sequence_windows(df, ["s"], "y", [])
    assert {r["s"] for r in w.collect()} == {"A"}


def test_temporal_split_disjoint_ordered_complete(spark):
    df = _series(spark, 100)
    sp = S.temporal_split(df, "date").collect()
    by = {}
    for r in sp:
        by.setdefault(r["split"], []).append(r["date"])
    assert len(by["train"]) == 70 and len(by["val"]) == 15 and len(by["test"]) == 15
    assert max(by["train"]) < min(by["val"]) and max(by["val"]) < min(by["test"])


def test_split_never_puts_one_date_in_two_splits(spark):
    df = _series(spark, 40, series="A").unionByName(_series(spark, 40, series="B"))
    sp = S.temporal_split(df, "date")
    assert sp.groupBy("date").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_urgency_bucket_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (0.2,), (9.0,), (1.5,)], "m double")
    got = [r[0] for r in df.select(urgency_bucket("m")).collect()]
    assert got == [2, 3, 1, 3, 2]


def test_mode_tie_takes_smallest(spark):
    rows = [(dt.date(2024, 1, 1), "X", "SKU", 1.0, 2, "ground", 1.0, 1.0, 0, 1, 0),
            (dt.date(2024, 1, 1), "X", "SKU", 1.0, 3, "air", 1.0, 1.0, 0, 1, 0)]
    df = spark.createDataFrame(rows, "date date, region string, sku_category string, "
                                     "shipping_weight_kg double, request_urgency int, shipping_method string, "
                                     "avg_repair_cycle_days double, failure_rate_pct double, day_of_week int, "
                                     "month int, is_quarter_end int")
    r = A.daily_aggregate(df, "region").first()
    assert r["shipping_method"] == "air"
    assert r["request_urgency"] == 2  # mean 2.5 -> half-even 2


def test_densify_fills_every_day(spark):
    df = _series(spark, 10).filter("date <> '2024-01-05'")
    d = S.densify_series(df, ["s"], "date", fill={"y": 0.0})
    assert d.count() == 10
    assert d.filter("date = '2024-01-05'").first()["y"] == 0.0


def test_cv_folds_match_cutoff_rule(spark):
    df = _series(spark, 500).withColumnRenamed("date", "ds")
    m = S.cv_folds(df, "ds", 7, 30, 365)
    cut = m.select("cutoff").distinct().orderBy("cutoff").collect()
    hi = dt.date(2024, 1, 1) + dt.timedelta(days=499)
    lo = dt.date(2024, 1, 1)
    expect = []
    c = hi - dt.timedelta(days=7)
    while c >= lo + dt.timedelta(days=365):
        expect.append(c)
        c -= dt.timedelta(days=30)
    assert [r[0] for r in cut] == sorted(expect)
    for r in m.collect():
        if r["role"] == "train":
            assert r["ds"] <= r["cutoff"]
        else:
            assert r["cutoff"] < r["ds"] <= r["cutoff"] + dt.timedelta(days=7)


def test_mape_nonzero_all_zero_is_infinite(spark):
    df = spark.createDataFrame([("m", 0.0, 1.0), ("m", 0.0, 2.0)], "model string, y double, yhat double")
    assert V.mape_nonzero(df).first()["mape_nonzero"] == float("inf")


def test_r2_null_on_constant_actuals_and_zero_baseline(spark):
    df = spark.createDataFrame([("baseline", 1.0, 1.0), ("m", 1.0, 2.0)], "model string, y double, yhat double")
    met = V.regression_metrics(df)
    assert all(r["r2"] is None for r in met.collect())
    cmp = {r["model"]: r for r in V.compare_models(met, "baseline").collect()}
    assert cmp["m"]["mae_improvement_pct"] is None  # baseline mae is 0


def test_csv_reader_keeps_na_region(spark, tmp_path):
    p = tmp_path / "ship.csv"
    p.write_text("date,region,sku_category,shipping_weight_kg,request_urgency,shipping_method,"
                 "avg_repair_cycle_days,failure_rate_pct,day_of_week,month,is_quarter_end\n"
                 "2024-01-01,NA,CPU,3.5,2,express,5.0,0.5,0,1,0\n"
                 "2024-01-01,EMEA,GPU,1.0,1,ground,4.0,0.2,0,1,0\n")
    from tidal.sources.tables import read_shipments
    df = read_shipments(spark, str(p))
    assert sorted(r["region"] for r in df.collect()) == ["EMEA", "NA"]
    d = A.daily_aggregate(df, "region")
    assert {r["region"] for r in d.collect()} == {"NA", "EMEA"}


def test_all_levels_equal_single_levels(spark):
    from tidal.sources.tables import shipments
    sh = shipments(spark, "/root/testdata/sf0.001").cache()
    allv = A.daily_all_levels(sh).cache()
    for level in A.LEVELS:
        one = A.daily_aggregate(sh, level).select("date", "region", "sku_category",
                                                  "total_shipping_weight_kg", "request_count",
                                                  "shipping_method", "request_urgency")
        two = allv.filter(F.col("level") == level).select(*one.columns)
        assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
