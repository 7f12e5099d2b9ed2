"""Readable cluster labels and summaries: one groupBy over the assigned
events, then a left join to the list of cluster ids so clusters without
rows are reported too."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference (label rules).
SEVERITY_SHARE = 0.5
LONG_DURATION_MS = 1000
SHORT_DURATION_MS = 50
HIGH_BYTES = 100000
LOW_BYTES = 1000
OFF_HOURS_BEFORE = 6
OFF_HOURS_AFTER = 22
GENERAL = "General traffic"
EMPTY = "Empty cluster"


def _cluster_ids(spark, k: int, cluster_col: str) -> DataFrame:
    return spark.range(k).select(F.col("id").cast("int").alias(cluster_col))


def _profile(events: DataFrame, cluster_col: str) -> DataFrame:
    """Per cluster: size, mean duration/bytes/hour, most frequent severity
    and protocol (smallest on ties) and the top severity's share.

    One pass over the events pre-aggregates (cluster, severity, protocol);
    everything after works on those few rows, which are read once: windows
    over them count the severities and protocols of a cluster."""
    base = events.where(F.col(cluster_col).isNotNull()).groupBy(cluster_col, "severity", "protocol").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration_ms").alias("sd"),
        F.sum("bytes_transferred").alias("sb"), F.sum("hour_of_day").alias("sh"))
    for c in ("severity", "protocol"):
        base = base.withColumn(f"n_{c}", F.sum("n").over(Window.partitionBy(cluster_col, c)))
    return base.groupBy(cluster_col).agg(
        F.sum("n").alias("count"), (F.sum("sd") / F.sum("n")).alias("avg_duration_ms"),
        (F.sum("sb") / F.sum("n")).alias("avg_bytes"), (F.sum("sh") / F.sum("n")).alias("avg_hour"),
        F.min_by("severity", F.struct(-F.col("n_severity"), F.col("severity"))).alias("dominant_severity"),
        (F.max("n_severity") / F.sum("n")).alias("top_share"),
        F.min_by("protocol", F.struct(-F.col("n_protocol"), F.col("protocol"))).alias("dominant_protocol")) \
        .withColumn("top", F.struct(F.col("dominant_severity").alias("severity"),
                                    F.col("top_share").alias("share")))


def _label_expr() -> F.Column:
    share = F.col("top.share")
    parts = F.array(
        F.when(share > SEVERITY_SHARE, F.concat(F.col("top.severity"), F.lit(" severity"))),
        F.when(F.col("avg_duration_ms") > LONG_DURATION_MS, F.lit("long duration"))
         .when(F.col("avg_duration_ms") < SHORT_DURATION_MS, F.lit("short duration")),
        F.when(F.col("avg_bytes") > HIGH_BYTES, F.lit("high data transfer"))
         .when(F.col("avg_bytes") < LOW_BYTES, F.lit("low data transfer")),
        F.when((F.col("avg_hour") < OFF_HOURS_BEFORE) | (F.col("avg_hour") > OFF_HOURS_AFTER),
               F.lit("off-hours activity")))
    joined = F.concat_ws(", ", F.array_compact(parts))
    return F.when(joined == "", F.lit(GENERAL)).otherwise(joined)


def cluster_label_rules(events: DataFrame, k: int | None = None, cluster_col: str = "cluster") -> DataFrame:
    """(cluster, interpretation). With ``k`` given, ids 0..k-1 without rows
    are labelled 'Empty cluster'."""
    lab = _profile(events, cluster_col).select(cluster_col, _label_expr().alias("interpretation"))
    if k is None:
        return lab
    ids = _cluster_ids(events.sparkSession, k, cluster_col)
    return ids.join(lab, cluster_col, "left").select(
        cluster_col, F.coalesce("interpretation", F.lit(EMPTY)).alias("interpretation"))


def cluster_summary(events: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """count, % of total, mean duration and bytes, dominant severity and
    protocol (most frequent, smallest on ties) and the label per cluster."""
    p = _profile(events, cluster_col)
    tot = F.sum("count").over(Window.partitionBy())  # one row per cluster
    return p.select(F.col(cluster_col).alias("cluster_id"), "count",
                    (F.col("count") * 100.0 / tot).alias("pct_of_total"),
                    "avg_duration_ms", "avg_bytes", "dominant_severity", "dominant_protocol",
                    _label_expr().alias("interpretation"))


def label_or_default(ids: DataFrame, labels: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Label lookup by a left join on the cluster id (K rows on the label
    side); ids without a label read 'Cluster <id>'."""
    j = ids.join(F.broadcast(labels), cluster_col, "left")  # labels: one row per cluster id
    return j.withColumn("interpretation", F.coalesce(
        F.col("interpretation"), F.concat(F.lit("Cluster "), F.col(cluster_col).cast("string"))))
