"""Request parsing/validation, entry import and k-means tolerance."""

import json
import os
import subprocess
import sys

import pytest

from tidal.operators import series as S
from tidal.sources import requests as RQ


def _point(day, urgency=1, dow=3, month=7):
    """One history day of the shipments contract; the tests vary the checked fields."""
    return {"date": f"2019-07-{day:02d}", "region": "ASIA", "sku_category": "SMALL BRUSHED TIN",
            "shipping_weight_kg": 17.25, "request_urgency": urgency, "shipping_method": "ground",
            "avg_repair_cycle_days": 11.0, "failure_rate_pct": 4.0, "day_of_week": dow, "month": month}


def test_forecast_request_validation(spark):
    good = {"request_id": "ok", "historical_data": [_point(d % 28 + 1) for d in range(30)]}
    short = {"request_id": "short", "historical_data": [_point(1)] * 29}
    bad = {"request_id": "bad", "historical_data": [_point(1, urgency=5, dow=9)] * 30}
    df = spark.createDataFrame([(json.dumps(x),) for x in (good, short, bad)], "body string")
    v = {r["request_id"]: r for r in RQ.validate_forecast_requests(RQ.parse_forecast_requests(df)).collect()}
    assert v["ok"]["is_valid"] and v["ok"]["n_points"] == 30
    assert not v["short"]["is_valid"] and v["short"]["reasons"] == ["history<30"]
    assert v["bad"]["reasons"] == ["day_of_week", "request_urgency"]


def test_event_request_validation_and_time_fill(spark):
    base = {"source_ip": "10.9.8.7", "dest_ip": "192.168.5.1", "port": 21, "duration_ms": 0.25,
            "bytes_transferred": 25, "protocol": "ICMP", "log_message": "view by user 7"}
    rows = [{**base, "event_id": 1, "hour_of_day": 23, "day_of_week": 6},
            {**base, "event_id": 2, "port": 65536, "duration_ms": -0.5},
            {**base, "event_id": 3}]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "body string")
    v = {r["event_id"]: r for r in RQ.validate_event_requests(RQ.parse_event_requests(df)).collect()}
    assert v[1]["is_valid"] and not v[2]["is_valid"] and v[3]["is_valid"]
    assert set(v[2]["reasons"]) == {"port", "duration_ms"}
    filled = {r["event_id"]: r for r in RQ.fill_request_time(
        RQ.parse_event_requests(df), "2024-02-01 12:00:00").collect()}
    assert (filled[1]["hour_of_day"], filled[1]["day_of_week"]) == (23, 6)
    assert (filled[3]["hour_of_day"], filled[3]["day_of_week"]) == (12, 3)


def test_entry_imports_from_the_zipped_pyspark(tmp_path):
    """On a cluster PySpark may come from pyspark.zip, without a jars folder."""
    import zipfile

    import pyspark
    home, target = os.path.dirname(pyspark.__file__), tmp_path / "pyspark.zip"
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(home):
            for n in (n for n in names if n.endswith((".py", ".json"))):
                full = os.path.join(folder, n)
                z.write(full, os.path.join("pyspark", os.path.relpath(full, home)))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import pyspark, __spark_entry__ as e; assert '.zip' in pyspark.__file__; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": f"{target}:{root}"}, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) >= 150


def test_missing_required_fields_are_named(spark):
    point = {**_point(1), "region": None, "shipping_weight_kg": None, "date": "soon"}
    df = spark.createDataFrame([(json.dumps({"request_id": "r", "historical_data": [point] * 30}),)], "body string")
    want = ["date", "region", "shipping_weight_kg"]
    assert RQ.validate_forecast_requests(RQ.parse_forecast_requests(df)).first()["reasons"] in (want, sorted([*want, "history<30"]))
    row = RQ.validate_histories(RQ.parse_forecast_histories(df), ["v3"]).first()
    assert row["reasons"] == want and row["n_points"] == 30
    event = {"event_id": 1, "source_ip": "10.9.8.7", "port": 1, "duration_ms": 1.0, "bytes_transferred": 1, "log_message": "x"}
    ev = spark.createDataFrame([(json.dumps(event),)], "body string")
    assert RQ.validate_event_requests(RQ.parse_event_requests(ev)).first()["reasons"] == ["dest_ip", "protocol"]


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from tidal import session as SE
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        SE.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))


def test_forward_fill_carries_last_value(spark):
    import datetime as dt
    rows = [("A", dt.date(2024, 1, d), v) for d, v in ((1, 1.0), (2, None), (3, None), (4, 5.0))]
    df = spark.createDataFrame(rows, "s string, date date, v double")
    got = [r["v"] for r in S.forward_fill(df, ["v"], ["s"]).orderBy("date").collect()]
    assert got == [1.0, 1.0, 1.0, 5.0]
