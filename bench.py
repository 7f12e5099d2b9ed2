"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed completely with the ``noop`` sink (every row is
produced, nothing is collected to the driver). Caches and fitted models are
cleared between queries, so none profits from another. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidal.plans import catalog, q_forecast, q_pipeline  # noqa: E402,F401
from tidal.plans.registry import QUERIES  # noqa: E402
from tidal.session import get_spark  # noqa: E402

HEADLINE = [
    # shipments -> daily series
    "read_shipments", "daily_by_region", "daily_all_levels", "rolling_mean", "densify_series",
    "correlation_records", "box_stats_region", "pivot_region",
    # series windows + evaluation
    "temporal_split", "sequence_windows", "lag_features", "regression_metrics",
    "per_horizon_metrics", "backtest_metrics",
    # text
    "clean_log_text", "tfidf_weights", "cluster_term_profile",
    # clustering and metrics
    "nearest_centroid", "silhouette", "cluster_eval_report", "cluster_summary",
    "hourly_event_counts",
    # fitted models
    "classify_events", "cross_family_table", "backtest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark()
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    times = {}
    for name in names:
        spark.catalog.clearCache()
        for memo in (q_forecast._MEMO, q_pipeline._MEMO):
            memo.clear()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir).replace("sf", ""),
           "cpus": int(os.environ.get("BENCH_CPUS", "8"))}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
