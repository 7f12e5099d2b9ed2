"""Queries for the fitted event-clustering pipeline, requests, persistence
and streaming. Model fits are memoised per (session, table folder) so the
registered queries share one fit."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import cluster as CL
from ..operators import cluster_eval as CE
from ..operators import eda as EDA
from ..operators import features as FE
from ..operators import text as X
from ..session import spread
from ..sources import requests as RQ
from ..sources import sinks
from ..sources import tables as T
from ..streaming import events as ST
from .event_model import EventClusteringModel, fit_event_clustering
from .registry import NET_EVENTS_CTE, SHIPMENTS_CTE, query, with_ctes

_MEMO: dict = {}
AS_OF = "2024-02-01 12:00:00"


def _memo(key, fn):
    if key not in _MEMO:
        _MEMO[key] = fn()
    return _MEMO[key]


def _events(spark, sf):
    return spread(T.net_events(spark, sf))


def _fitted(spark, sf):
    def run():
        return fit_event_clustering(_events(spark, sf))
    return _memo(("fit", spark.sparkContext.applicationId, sf), run)


def _features(spark, sf):
    model, _ = _fitted(spark, sf)
    return model.features(_events(spark, sf)).select("event_id", "features")


def _scratch(spark, name):
    return sinks.output_root(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("assemble_features")
def q_assemble_features(spark, sf):
    """5 scaled numerics ++ 20 LSA components per event."""
    f = _features(spark, sf)
    return f.select("event_id", F.size("features").alias("n_features"),
                    *[F.col("features")[i].alias(n) for i, n in enumerate(
                        [*FE.EVENT_NUMERIC, *[f"lsa_component_{i}" for i in range(20)]])])


@query("k_search")
def q_k_search(spark, sf):
    """Inertia and both silhouettes for K = 3..10, the best of 10 starts each."""
    _, curve = _fitted(spark, sf)
    return curve


@query("kmeans_fit")
def q_kmeans_fit(spark, sf):
    """Selected K, best-of-10 k-means: per-cluster size and inertia share."""
    model, _ = _fitted(spark, sf)
    a = CL.assign(_features(spark, sf), "features", model.centers)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"),
                                    F.sum("sq_distance").alias("inertia")) \
        .withColumn("k", F.lit(model.k)).withColumn("k_reason", F.lit(model.k_reason))


@query("kmeans_minibatch")
def q_kmeans_minibatch(spark, sf):
    """Mini-batch k-means of the selected K (10 starts), every event assigned."""
    model, _ = _fitted(spark, sf)
    feats = _features(spark, sf)
    fit = CL.kmeans_minibatch(feats, "features", model.k)
    return CL.assign(feats, "features", fit.centers).select("event_id", "cluster", "distance")


@query("kmeans_predict")
def q_kmeans_predict(spark, sf):
    """Cluster and distance per event from the fitted pipeline."""
    model, _ = _fitted(spark, sf)
    return CL.assign(model.features(_events(spark, sf)), "features", model.centers) \
        .select("event_id", "cluster", "distance")


@query("cluster_centers")
def q_cluster_centers(spark, sf):
    """Fitted centroids, long form with feature names."""
    model, _ = _fitted(spark, sf)
    names = model.feature_names
    rows = [(i, names[j], float(v)) for i, c in enumerate(model.centers) for j, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, feature string, value double")


@query("classify_events")
def q_classify_events(spark, sf):
    """Full fitted pipeline: cluster, label, score, flag, version."""
    model, _ = _fitted(spark, sf)
    return model.classify(_events(spark, sf)).select(
        "event_id", "cluster", "interpretation", "anomaly_score", "is_anomalous", "model_version")


def _fitted_clusters(spark, sf):
    """Every event with its fitted cluster, feature vector and true cluster."""
    model, _ = _fitted(spark, sf)
    return model, CL.assign(model.features(_events(spark, sf)), "features", model.centers)


@query("elbow_point_fitted")
def q_elbow_point_fitted(spark, sf):
    """Elbow of the fitted K curve of the events."""
    return CL.elbow_point(_fitted(spark, sf)[1])


@query("best_silhouette_k_fitted")
def q_best_silhouette_k_fitted(spark, sf):
    """K with the best Euclidean silhouette of the fitted curve."""
    c = _fitted(spark, sf)[1]
    return c.agg(F.min_by("k", F.struct(-F.col("silhouette"), F.col("k"))).alias("best_silhouette_k"))


@query("select_k_fitted")
def q_select_k_fitted(spark, sf):
    """The K that the fitted curve selects, with the reason."""
    return CL.select_k(_fitted(spark, sf)[1])


@query("cluster_eval_report_fitted")
def q_cluster_eval_report_fitted(spark, sf):
    """The fitted event clusters against ``true_cluster`` (ARI, NMI,
    homogeneity, completeness, V-measure, purity) and by inertia, both
    silhouettes, Calinski-Harabasz and Davies-Bouldin, as (metric, value)."""
    model, a = _fitted_clusters(spark, sf)
    dim = len(model.centers[0])
    a = a.select("event_id", "features", "cluster", "true_cluster").persist()
    internal = [("inertia", model.inertia), ("silhouette", CE.silhouette_summary(a, "event_id", "features", "cluster")),
                ("silhouette_sq", CE.silhouette_sq_summary(a, "features", "cluster", dim)),
                ("calinski_harabasz", CE.calinski_harabasz(a, "features", "cluster", dim).first()[0]),
                ("davies_bouldin", CE.davies_bouldin(a, "features", "cluster", dim).first()[0])]
    external = CE.external_metrics(a, "cluster", "true_cluster").first().asDict()
    a.unpersist()
    return spark.createDataFrame([(m, float(v)) for m, v in [*internal, *external.items()]], "metric string, value double")


@query("cluster_term_profile_fitted")
def q_cluster_term_profile_fitted(spark, sf):
    """Top 10 terms of the log messages of every fitted cluster."""
    model, a = _fitted_clusters(spark, sf)
    return X.cluster_term_profile(a.select("cluster", "log_message"), "log_message", model.tfidf, "cluster", 10)


@query("pca_2d")
def q_pca_2d(spark, sf):
    """Centred 2-d projection of the feature vectors, variance ratios as columns."""
    out, ev = FE.pca_2d(_features(spark, sf), "features", 2)
    return out.select("event_id", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2"),
                      F.lit(float(ev[0])).alias("var_ratio_1"), F.lit(float(ev[1])).alias("var_ratio_2"))


@query("sample_rows")
def q_sample_rows(spark, sf):
    return EDA.sample_rows(T.net_events(spark, sf), "event_id", 5000, 42)


@query("write_assignments")
def q_write_assignments(spark, sf):
    """Write assignments, summary and metrics; return the re-read assignments."""
    from ..operators.interpret import cluster_summary
    model, _ = _fitted(spark, sf)
    scored = model.classify(_events(spark, sf)).select("event_id", "timestamp", "severity", "protocol", "duration_ms", "bytes_transferred",
                                       "hour_of_day", "cluster", "anomaly_score").persist()
    out = _scratch(spark, "assignments")
    summary = cluster_summary(scored.select("cluster", "severity", "duration_ms", "bytes_transferred",
                                            "hour_of_day", "protocol"))
    paths = sinks.write_assignments(
        scored.select("event_id", "timestamp", "severity", "protocol", "cluster", "anomaly_score"),
        summary, {"inertia": model.inertia, "k": model.k}, out)
    scored.unpersist()
    return spark.read.parquet(paths["assignments"])


@query("save_model")
def q_save_model(spark, sf):
    """Save the fitted model, load it back, score with the loaded copy."""
    model, _ = _fitted(spark, sf)
    root = _scratch(spark, "models")
    model.save(spark, root)
    loaded = EventClusteringModel.load(spark, root, model.version)
    return loaded.classify(_events(spark, sf)).select(
        "event_id", "cluster", "interpretation", "anomaly_score", "model_version")


@query("score_event_stream")
def q_score_event_stream(spark, sf):
    """Requests as JSON files -> stream -> validate -> fill time -> score."""
    model, _ = _fitted(spark, sf)
    base = _scratch(spark, "stream")
    bodies = ST.request_bodies_table(spark, sf, f"{base}/bodies")
    return ST.score_event_stream(spark, bodies, model, f"{base}/sink", f"{base}/ckpt", AS_OF)


@query("hourly_event_counts", f"""{with_ctes(NET_EVENTS_CTE)}
SELECT date_trunc('hour', "timestamp") AS window_start,
       date_trunc('hour', "timestamp") + INTERVAL 1 HOUR AS window_end, count(*) AS count
FROM net_events GROUP BY 1, 2""")
def q_hourly_event_counts(spark, sf):
    """Hourly tumbling-window counts (the batch twin of the watermarked stream)."""
    ev = T.net_events(spark, sf)
    h = ST.hourly_counts(ev, "timestamp")
    return h.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"), "count")


# ---- requests ------------------------------------------------------------------------

_REQ_SQL = f"""{with_ctes(SHIPMENTS_CTE)},
d AS (SELECT date, region, sum(shipping_weight_kg) AS shipping_weight_kg,
             avg(request_urgency) AS mu, avg(avg_repair_cycle_days) AS avg_repair_cycle_days,
             avg(failure_rate_pct) AS failure_rate_pct FROM shipments GROUP BY date, region),
p AS (SELECT region || '-' || strftime(date, '%Y-%m') AS request_id, date, region,
             shipping_weight_kg,
             CAST(greatest(1, least(3, CAST(round_even(mu, 0) AS INTEGER))) AS INTEGER) AS request_urgency,
             round(avg_repair_cycle_days, 6) AS avg_repair_cycle_days, round(failure_rate_pct, 6) AS failure_rate_pct,
             CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month FROM d)"""


def _forecast_requests(spark, sf):
    """Stand-in request bodies: one JSON request per (region, month) with
    that month's daily points as history."""
    from ..operators import aggregate as A
    d = A.daily_aggregate(T.shipments(spark, sf), "region")
    pts = d.select(F.concat_ws("-", "region", F.date_format("date", "yyyy-MM")).alias("request_id"),
                   F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), "region", "sku_category",
                            F.col("total_shipping_weight_kg").alias("shipping_weight_kg"),
                            "request_urgency", "shipping_method",
                            F.round("avg_repair_cycle_days", 6).alias("avg_repair_cycle_days"),
                            F.round("failure_rate_pct", 6).alias("failure_rate_pct"),
                            "day_of_week", "month").alias("p"))
    req = pts.groupBy("request_id").agg(F.collect_list("p").alias("historical_data"))  # <= 31 points
    return req.select(F.to_json(F.struct("request_id", "historical_data",
                                         F.lit("v3").alias("model_version"))).alias("body"))


@query("parse_requests", f"""{_REQ_SQL}
SELECT request_id, date, region, shipping_weight_kg, request_urgency, avg_repair_cycle_days,
       failure_rate_pct, day_of_week, month FROM p""")
def q_parse_requests(spark, sf):
    p = RQ.parse_forecast_requests(_forecast_requests(spark, sf), "body")
    return p.select("request_id", "date", "region", "shipping_weight_kg", "request_urgency",
                    "avg_repair_cycle_days", "failure_rate_pct", "day_of_week", "month")


@query("validate_requests", f"""{_REQ_SQL}
SELECT request_id, count(*) AS n_points,
       CASE WHEN count(*) < 30 THEN 'history<30' ELSE '' END AS reasons, count(*) >= 30 AS is_valid
FROM p GROUP BY request_id""")
def q_validate_requests(spark, sf):
    """Forecast requests with < 30 history points (or out-of-range fields)
    are quarantined with their reasons."""
    v = RQ.validate_forecast_requests(RQ.parse_forecast_requests(_forecast_requests(spark, sf), "body"))
    return v.select("request_id", "n_points", F.array_join("reasons", ";").alias("reasons"), "is_valid")


@query("fill_request_time", f"""{with_ctes(NET_EVENTS_CTE)}
SELECT event_id, CASE WHEN true_cluster = 'view' THEN 12 ELSE hour_of_day END AS hour_of_day,
       CASE WHEN true_cluster = 'view' THEN 3 ELSE day_of_week END AS day_of_week FROM net_events""")
def q_fill_request_time(spark, sf):
    """Event requests without time fields take those of a fixed ``as_of``
    (2024-02-01 12:00, a Thursday)."""
    bodies = ST.events_as_requests(T.net_events(spark, sf))
    r = RQ.fill_request_time(RQ.parse_event_requests(bodies, "body"), AS_OF)
    return r.select("event_id", "hour_of_day", "day_of_week")


@query("hourly_event_counts_stream")
def q_hourly_event_counts_stream(spark, sf):
    """The same hourly windows as a Structured Streaming job over the table's
    files; equal to the batch counts, whatever the order of the files."""
    base = _scratch(spark, "hourly")
    return ST.hourly_event_counts_stream(spark, f"{sf.rstrip('/')}/events.parquet", f"{base}/sink", f"{base}/ckpt")
