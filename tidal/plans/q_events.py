"""Queries over the network-event view: scalars, profiles, scaling, a
deterministic numeric clustering (K = 6 started from the lowest event ids)
with labels, summaries and scores, requests, and hourly windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import vectors as VX
from ..operators import cluster as CL
from ..operators import eda as EDA
from ..operators import features as FE
from ..operators import interpret as IN
from ..sources import tables as T
from .registry import NET_EVENTS_CTE, SHIPMENTS_CTE, query, with_ctes

NE = with_ctes(NET_EVENTS_CTE)
KE = 6
_SCALE_COLS = ["duration_ms_log1p", "bytes_transferred_log1p", "port", "hour_of_day", "day_of_week"]


def _rnd(df, cols, d=6):
    for c in cols:
        df = df.withColumn(c, F.round(c, d))
    return df


def _ev(spark, sf):
    return T.net_events(spark, sf)


@query("read_events", f"{NE} SELECT * FROM net_events")
def q_read_events(spark, sf):
    """Record-level network-event view derived from `events`."""
    return _ev(spark, sf)


@query("calendar_features", f"""{NE}
SELECT event_id, hour_of_day, day_of_week, CAST(month("timestamp") AS INTEGER) AS month,
       CAST(day("timestamp") AS INTEGER) AS day_of_month FROM net_events""")
def q_calendar_features(spark, sf):
    """Hour, weekday (Monday = 0), month and day of month per event."""
    e = _ev(spark, sf)
    return e.select("event_id", F.hour("timestamp").alias("hour_of_day"),
                    C.weekday0("timestamp").alias("day_of_week"), F.month("timestamp").alias("month"),
                    F.dayofmonth("timestamp").alias("day_of_month"))


@query("log1p_features", f"""{NE}
SELECT event_id, round(ln(1 + duration_ms), 9) AS duration_ms_log1p,
       round(ln(1 + bytes_transferred), 9) AS bytes_transferred_log1p FROM net_events""")
def q_log1p_features(spark, sf):
    """log(1 + x) of duration and bytes."""
    e = FE.log1p_features(_ev(spark, sf))
    return _rnd(e.select("event_id", "duration_ms_log1p", "bytes_transferred_log1p"),
                ["duration_ms_log1p", "bytes_transferred_log1p"], 9)


@query("severity_code", f"""{NE}
SELECT event_id, severity, CASE severity WHEN 'info' THEN 0 WHEN 'warning' THEN 1 WHEN 'error' THEN 2
                                         WHEN 'critical' THEN 3 END AS severity_code FROM net_events""")
def q_severity_code(spark, sf):
    """Severity name to code 0..3."""
    return _ev(spark, sf).select("event_id", "severity", C.severity_code("severity").alias("severity_code"))


def _vc_sql(col):
    return f"""{NE}
SELECT {col}, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 9) AS pct
FROM net_events GROUP BY {col}"""


def _vc(col):
    def fn(spark, sf):
        """Count and percent of events per value."""
        return EDA.value_counts_pct(_ev(spark, sf), col).withColumn("pct", F.round("pct", 9))
    return fn


query("value_counts_pct", _vc_sql("protocol"))(_vc("protocol"))
query("value_counts_severity", _vc_sql("severity"))(_vc("severity"))
query("value_counts_hour", _vc_sql("hour_of_day"))(_vc("hour_of_day"))
query("value_counts_true_cluster", _vc_sql("true_cluster"))(_vc("true_cluster"))


@query("top_ports", f"""{NE}
SELECT port, count(*) AS count FROM net_events GROUP BY port ORDER BY count DESC, port LIMIT 20""")
def q_top_ports(spark, sf):
    """20 most frequent ports."""
    return EDA.top_values(_ev(spark, sf), "port", 20)


@query("events_profile", f"""{NE}
SELECT count(*) AS rows, min("timestamp") AS first, max("timestamp") AS last,
       count(DISTINCT source_ip) AS distinct_source_ip, count(DISTINCT dest_ip) AS distinct_dest_ip
FROM net_events""")
def q_events_profile(spark, sf):
    """Rows, time range and distinct source / destination IPs."""
    return EDA.dataset_profile(_ev(spark, sf), "timestamp", ["source_ip", "dest_ip"])


@query("box_stats", f"""{NE},
q AS (SELECT severity, count(*) AS n, quantile_cont(port, 0.25) AS q1,
             quantile_cont(port, 0.5) AS median, quantile_cont(port, 0.75) AS q3
      FROM net_events GROUP BY severity),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.severity, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       CAST(min(CASE WHEN e.port BETWEEN lo_f AND hi_f THEN e.port END) AS DOUBLE) AS lower_whisker,
       CAST(max(CASE WHEN e.port BETWEEN lo_f AND hi_f THEN e.port END) AS DOUBLE) AS upper_whisker,
       CAST(sum(CASE WHEN e.port BETWEEN lo_f AND hi_f THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM net_events e JOIN f ON e.severity = f.severity GROUP BY f.severity, n, q1, median, q3, iqr""")
def q_box_stats(spark, sf):
    """Port quartiles, whiskers and outliers by severity. The measure has a
    bounded domain (1..65535), so the exact percentile buffer per group
    stays bounded however many events a severity holds; continuous
    measures at scale go through ``percentile_approx``."""
    b = EDA.box_stats(_ev(spark, sf), "port", "severity")
    return _rnd(b, ["q1", "median", "q3", "iqr"])


@query("seasonal_profile", f"""{NE},
g AS (SELECT day_of_week, avg(duration_ms) AS mean, count(*) AS n FROM net_events GROUP BY day_of_week)
SELECT day_of_week, round(mean, 6) AS mean, n, round(avg(mean) OVER (), 6) AS mean_of_means FROM g""")
def q_seasonal_profile(spark, sf):
    """Mean duration per weekday and the mean of those means."""
    m = EDA.mean_by(_ev(spark, sf), "day_of_week", "duration_ms")
    return _rnd(m, ["mean", "mean_of_means"])


@query("filter_group", f"""{with_ctes(SHIPMENTS_CTE)}
SELECT region, request_urgency, count(*) AS n, sum(shipping_weight_kg) AS total_weight
FROM shipments GROUP BY region, request_urgency""")
def q_filter_group(spark, sf):
    """Per-(region, urgency) subsets as one grouped pass instead of one filter each."""
    return T.shipments(spark, sf).groupBy("region", "request_urgency").agg(
        F.count(F.lit(1)).alias("n"), F.sum("shipping_weight_kg").alias("total_weight"))


@query("rebalance_to_ratio", f"""{NE},
c AS (SELECT true_cluster, count(*) AS n FROM net_events GROUP BY true_cluster),
s AS (SELECT *, n / sum(n) OVER () AS share, true_cluster IN ('error') AS anom FROM c),
g AS (SELECT sum(CASE WHEN anom THEN share ELSE 0 END) AS a_tot, sum(CASE WHEN anom THEN 0 ELSE share END) AS n_tot FROM s),
t AS (SELECT s.*, round(share * CASE WHEN anom THEN CASE WHEN a_tot > 0 THEN 0.05 / a_tot ELSE 1.0 END
                                     ELSE CASE WHEN n_tot > 0 THEN 0.95 / n_tot ELSE 1.0 END END, 4) AS target FROM s, g),
fx AS (SELECT 1.0 - sum(target) AS gap, arg_max(true_cluster, (target, true_cluster)) FILTER (WHERE NOT anom) AS big FROM t)
SELECT true_cluster, n, round(share, 9) AS current_share,
       round(CASE WHEN true_cluster = big AND gap <> 0 THEN round(target + gap, 4) ELSE target END, 4) AS target_share,
       round(CASE WHEN true_cluster = big AND gap <> 0 THEN round(target + gap, 4) ELSE target END / share, 6) AS weight
FROM t, fx""")
def q_rebalance_to_ratio(spark, sf):
    """Class weights giving the anomaly class ('error') a 5% share."""
    from pyspark.sql import Window
    w = Window.partitionBy()  # one row per class
    c = _ev(spark, sf).groupBy("true_cluster").agg(F.count(F.lit(1)).alias("n"))
    s = c.withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn(
        "anom", F.col("true_cluster").isin("error"))
    a_tot = F.sum(F.when(F.col("anom"), F.col("share")).otherwise(0)).over(w)
    n_tot = F.sum(F.when(F.col("anom"), 0).otherwise(F.col("share"))).over(w)
    scale = F.when(F.col("anom"), F.when(a_tot > 0, F.lit(0.05) / a_tot).otherwise(1.0)) \
             .otherwise(F.when(n_tot > 0, F.lit(0.95) / n_tot).otherwise(1.0))
    t = s.withColumn("target", F.round(F.col("share") * scale, 4))
    gap = F.lit(1.0) - F.sum("target").over(w)
    big = F.max_by(F.when(~F.col("anom"), F.col("true_cluster")),
                   F.when(~F.col("anom"), F.struct("target", "true_cluster"))).over(w)
    fixed = F.when((F.col("true_cluster") == big) & (gap != 0), F.round(F.col("target") + gap, 4)) \
             .otherwise(F.col("target"))
    return t.select("true_cluster", "n", F.round("share", 9).alias("current_share"),
                    F.round(fixed, 4).alias("target_share"),
                    F.round(fixed / F.col("share"), 6).alias("weight"))


# ---- scaling and deterministic numeric clustering -----------------------------------

SCALED = f"""{NE},
f AS (SELECT *, ln(1 + duration_ms) AS l0, ln(1 + bytes_transferred) AS l1 FROM net_events),
st AS (SELECT avg(l0) AS m0, stddev_pop(l0) AS s0, avg(l1) AS m1, stddev_pop(l1) AS s1,
              avg(port) AS m2, stddev_pop(port) AS s2, avg(hour_of_day) AS m3, stddev_pop(hour_of_day) AS s3,
              avg(day_of_week) AS m4, stddev_pop(day_of_week) AS s4 FROM f),
z AS (SELECT f.*, [(l0 - m0) / CASE WHEN s0 > 0 THEN s0 ELSE 1 END, (l1 - m1) / CASE WHEN s1 > 0 THEN s1 ELSE 1 END,
                   (port - m2) / CASE WHEN s2 > 0 THEN s2 ELSE 1 END, (hour_of_day - m3) / CASE WHEN s3 > 0 THEN s3 ELSE 1 END,
                   (day_of_week - m4) / CASE WHEN s4 > 0 THEN s4 ELSE 1 END] AS x FROM f, st)"""

EV_ASG = f"""{SCALED},
init AS (SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS INTEGER) AS cid, x AS c
         FROM z ORDER BY event_id LIMIT {KE}),
dist AS (SELECT event_id, cid, list_sum(list_transform(range(1, 6), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d
         FROM z, init),
am AS (SELECT event_id, arg_min(cid, (d, cid)) AS cluster, sqrt(min(d)) AS distance FROM dist GROUP BY event_id),
asg AS (SELECT z.*, cluster, distance FROM z JOIN am USING (event_id)),
bd AS (SELECT min(distance) AS lo, max(distance) AS hi FROM asg),
sc AS (SELECT asg.*, CASE WHEN hi > lo THEN least(1.0, greatest(0.0, (distance - lo) / (hi - lo))) ELSE 0.0 END
              AS anomaly_score FROM asg, bd)"""


def _scaled(spark, sf):
    e = FE.log1p_features(_ev(spark, sf))
    sc = FE.fit_standard_scaler(e, _SCALE_COLS)
    z = FE.assemble(sc.transform(e), [f"{c}_scaled" for c in _SCALE_COLS], "x")
    return z, sc


def _event_clusters(spark, sf):
    z, _ = _scaled(spark, sf)
    centers = CL.initial_centroids_lowest_id(z, "event_id", "x", KE)
    a = CL.assign(z, "x", centers)
    b = a.agg(F.min("distance").alias("lo"), F.max("distance").alias("hi")).first()
    return a.withColumn("anomaly_score", CL.anomaly_score(a, b["lo"], b["hi"]))


@query("standard_scale", f"""{SCALED}
SELECT event_id, {", ".join(f"round(x[{i + 1}], 6) AS {c}_scaled" for i, c in enumerate(_SCALE_COLS))} FROM z""")
def q_standard_scale(spark, sf):
    """Population-std scaling of the five event numerics."""
    z, _ = _scaled(spark, sf)
    cols = [f"{c}_scaled" for c in _SCALE_COLS]
    return _rnd(z.select("event_id", *cols), cols)


@query("minmax_scale", f"""{NE},
f AS (SELECT event_id, duration_ms, CAST(bytes_transferred AS DOUBLE) AS b, CAST(port AS DOUBLE) AS p FROM net_events),
m AS (SELECT min(duration_ms) AS a0, max(duration_ms) AS z0, min(b) AS a1, max(b) AS z1, min(p) AS a2, max(p) AS z2 FROM f)
SELECT event_id, round((duration_ms - a0) / CASE WHEN z0 > a0 THEN z0 - a0 ELSE 1 END, 9) AS duration_ms_minmax,
       round((b - a1) / CASE WHEN z1 > a1 THEN z1 - a1 ELSE 1 END, 9) AS bytes_transferred_minmax,
       round((p - a2) / CASE WHEN z2 > a2 THEN z2 - a2 ELSE 1 END, 9) AS port_minmax
FROM f, m""")
def q_minmax_scale(spark, sf):
    """Min-max scaling of duration, bytes and port."""
    cols = ["duration_ms", "bytes_transferred", "port"]
    e = _ev(spark, sf)
    out = FE.fit_minmax(e, cols).transform(e)
    return _rnd(out.select("event_id", *[f"{c}_minmax" for c in cols]), [f"{c}_minmax" for c in cols], 9)


@query("cluster_label_rules", f"""{EV_ASG},
ids AS (SELECT CAST(i AS INTEGER) AS cluster FROM range({KE}) t(i)),
sv AS (SELECT cluster, severity, count(*) AS c FROM asg GROUP BY cluster, severity),
top AS (SELECT cluster, arg_min(severity, (-c, severity)) AS sev, max(c) / sum(c) AS share FROM sv GROUP BY cluster),
cs AS (SELECT cluster, avg(duration_ms) AS d, avg(bytes_transferred) AS b, avg(hour_of_day) AS h FROM asg GROUP BY cluster),
lab AS (SELECT cs.cluster, concat_ws(', ',
          CASE WHEN share > 0.5 THEN sev || ' severity' END,
          CASE WHEN d > 1000 THEN 'long duration' WHEN d < 50 THEN 'short duration' END,
          CASE WHEN b > 100000 THEN 'high data transfer' WHEN b < 1000 THEN 'low data transfer' END,
          CASE WHEN h < 6 OR h > 22 THEN 'off-hours activity' END) AS j
        FROM cs JOIN top USING (cluster))
SELECT ids.cluster, CASE WHEN lab.j IS NULL THEN 'Empty cluster' WHEN lab.j = '' THEN 'General traffic' ELSE lab.j END
         AS interpretation
FROM ids LEFT JOIN lab USING (cluster)""")
def q_cluster_label_rules(spark, sf):
    """Rule labels per cluster of the deterministic K = 6 assignment."""
    return IN.cluster_label_rules(_event_clusters(spark, sf), KE)


SUMMARY_SQL = f"""{EV_ASG},
sv AS (SELECT cluster, severity, count(*) AS c FROM asg GROUP BY cluster, severity),
top AS (SELECT cluster, arg_min(severity, (-c, severity)) AS sev, max(c) / sum(c) AS share FROM sv GROUP BY cluster),
pv AS (SELECT cluster, protocol, count(*) AS c FROM asg GROUP BY cluster, protocol),
tp AS (SELECT cluster, arg_min(protocol, (-c, protocol)) AS proto FROM pv GROUP BY cluster),
cs AS (SELECT cluster, count(*) AS count, avg(duration_ms) AS d, avg(bytes_transferred) AS b, avg(hour_of_day) AS h
       FROM asg GROUP BY cluster),
lab AS (SELECT cs.*, sev, proto, concat_ws(', ',
          CASE WHEN share > 0.5 THEN sev || ' severity' END,
          CASE WHEN d > 1000 THEN 'long duration' WHEN d < 50 THEN 'short duration' END,
          CASE WHEN b > 100000 THEN 'high data transfer' WHEN b < 1000 THEN 'low data transfer' END,
          CASE WHEN h < 6 OR h > 22 THEN 'off-hours activity' END) AS j
        FROM cs JOIN top USING (cluster) JOIN tp USING (cluster))"""


@query("cluster_summary", f"""{SUMMARY_SQL}
SELECT cluster AS cluster_id, count, round(count * 100.0 / sum(count) OVER (), 6) AS pct_of_total,
       round(d, 6) AS avg_duration_ms, round(b, 6) AS avg_bytes, sev AS dominant_severity,
       proto AS dominant_protocol, CASE WHEN j = '' THEN 'General traffic' ELSE j END AS interpretation
FROM lab""")
def q_cluster_summary(spark, sf):
    """Per-cluster count, share, means, dominant severity/protocol, label."""
    s = IN.cluster_summary(_event_clusters(spark, sf))
    return _rnd(s, ["pct_of_total", "avg_duration_ms", "avg_bytes"])


@query("interpretation_join", f"""{SUMMARY_SQL}
SELECT event_id, asg.cluster, CASE WHEN j = '' THEN 'General traffic' ELSE j END AS interpretation
FROM asg JOIN lab ON asg.cluster = lab.cluster""")
def q_interpretation_join(spark, sf):
    """Cluster label joined to every event."""
    a = _event_clusters(spark, sf)
    labels = IN.cluster_label_rules(a, None)
    return a.select("event_id", "cluster").join(F.broadcast(labels), "cluster")  # K label rows


@query("label_or_default", f"""{SUMMARY_SQL},
ids AS (SELECT CAST(i AS INTEGER) AS cluster FROM range({KE + 2}) t(i))
SELECT ids.cluster, coalesce(CASE WHEN j = '' THEN 'General traffic' ELSE j END, 'Cluster ' || ids.cluster)
         AS interpretation
FROM ids LEFT JOIN lab ON ids.cluster = lab.cluster""")
def q_label_or_default(spark, sf):
    """Ids of a newer model version (K + 2) looked up in the K labels; unknown ids fall back."""
    labels = IN.cluster_label_rules(_event_clusters(spark, sf), None)
    ids = spark.range(KE + 2).select(F.col("id").cast("int").alias("cluster"))
    return IN.label_or_default(ids, labels)


@query("flag_anomalous", f"""{EV_ASG}
SELECT event_id, cluster, round(anomaly_score, 6) AS anomaly_score, anomaly_score > 0.7 AS is_anomalous FROM sc""")
def q_flag_anomalous(spark, sf):
    """Anomaly score per event and the 0.7 flag."""
    a = _event_clusters(spark, sf)
    return a.select("event_id", "cluster", F.round("anomaly_score", 6).alias("anomaly_score"),
                    C.flag_anomalous("anomaly_score").alias("is_anomalous"))


# ---- codes for categorical features ------------------------------------------------

_CATS = ["region", "sku_category", "request_urgency", "shipping_method"]
_SP = f"""{with_ctes(SHIPMENTS_CTE)},
dts AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT date FROM shipments)),
cut AS (SELECT max(CASE WHEN i = floor(n * CAST(0.7 AS DOUBLE)) THEN date END) AS c1 FROM dts),
tr AS (SELECT s.* FROM shipments s, cut WHERE s.date < c1),
codes AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS feature, v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
    f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM tr)" for c in _CATS)})"""


def _codes(spark, sf):
    from ..operators import series as S
    sh = T.shipments(spark, sf)
    c1, _ = S.split_cut_dates(sh, "date")
    tr = sh.filter(F.col("date") < F.lit(c1))
    return sh, FE.fit_label_codes(tr, _CATS)


@query("label_codes", f"{_SP} SELECT feature, value, code FROM codes")
def q_label_codes(spark, sf):
    """Category -> code fitted on the training split, alphabetical."""
    return _codes(spark, sf)[1]


@query("vocab_sizes", f"{_SP} SELECT feature, count(*) AS n_classes FROM codes GROUP BY feature")
def q_vocab_sizes(spark, sf):
    """Number of classes per categorical feature."""
    return _codes(spark, sf)[1].groupBy("feature").agg(F.count(F.lit(1)).alias("n_classes"))


@query("encode_lookup", f"""{_SP}
SELECT date, s.region, {", ".join(f"c{i}.code AS {c}_code" for i, c in enumerate(_CATS))}
FROM shipments s {" ".join(f"JOIN codes c{i} ON c{i}.feature = '{c}' AND c{i}.value = CAST(s.{c} AS VARCHAR)" for i, c in enumerate(_CATS))}""")
def q_encode_lookup(spark, sf):
    """Code lookup for every shipment's categorical features."""
    sh, codes = _codes(spark, sf)
    out = FE.apply_codes(sh.select("date", *_CATS), codes, _CATS)
    return out.select("date", "region", *[f"{c}_code" for c in _CATS])


@query("encode_unseen_zero", f"""{NE},
tr AS (SELECT * FROM net_events WHERE severity = 'info'),
codes AS (SELECT v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT dest_ip AS v FROM tr))
SELECT event_id, dest_ip, coalesce(code, 0) AS dest_ip_code FROM net_events LEFT JOIN codes ON dest_ip = value""")
def q_encode_unseen_zero(spark, sf):
    """Destination codes learned from 'info' events, applied to all events:
    addresses never seen with 'info' score as 0."""
    e = _ev(spark, sf)
    codes = FE.fit_label_codes(e.filter(F.col("severity") == "info"), ["dest_ip"])
    return FE.encode_unseen_zero(e, codes, "dest_ip").select("event_id", "dest_ip", "dest_ip_code")
