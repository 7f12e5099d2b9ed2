"""Registered queries against their DuckDB twins on the small tables."""

import duckdb
import pytest

from table_paths import SF_SMALL

import __spark_entry__ as E
from scripts.oracle_check import _rows
from tidal.sources.tables import TABLES

SAMPLE = [
    "daily_by_region", "daily_all_levels", "rolling_mean", "densify_series", "temporal_split",
    "sequence_windows", "persistence_forecast", "cv_folds", "regression_metrics", "compare_models",
    "error_quantiles", "backtest_metrics", "clean_document_text", "tfidf_weights",
    "nearest_centroid", "silhouette", "calinski_harabasz", "davies_bouldin", "cluster_eval_report",
    "select_k", "cluster_label_rules", "cluster_summary", "standard_scale", "label_codes",
    "parse_requests", "validate_requests", "hourly_event_counts", "box_stats", "pivot_region",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_a_builder_and_sql_keys_are_registered():
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 138
    assert set(sql) <= set(qs)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_duckdb(spark, duck, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    d = duck.execute(E.oracle_sql()[name]).df()
    sc, sr = _rows(s)
    dc, dr = _rows(d)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "region", "total_shipping_weight_kg", "rolling_mean_7", "rolling_mean_30"]
    assert df.count() > 0
