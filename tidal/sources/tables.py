"""Readers for the input tables and the two record-level views.

``shipments`` and ``net_events`` are the two flat record tables the
pipelines consume. Over the driver's TPC-H-like tables they are defined as
joins/projections (see FIXTURES.md); Catalyst prunes every column not used
by the consuming query and pushes filters into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

SHIPMENT_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("region", T.StringType()),
    T.StructField("sku_category", T.StringType()),
    T.StructField("shipping_weight_kg", T.DoubleType()),
    T.StructField("request_urgency", T.IntegerType()),
    T.StructField("shipping_method", T.StringType()),
    T.StructField("avg_repair_cycle_days", T.DoubleType()),
    T.StructField("failure_rate_pct", T.DoubleType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("is_quarter_end", T.IntegerType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("dest_ip", T.StringType()),
    T.StructField("port", T.IntegerType()),
    T.StructField("duration_ms", T.DoubleType()),
    T.StructField("bytes_transferred", T.LongType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("log_message", T.StringType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("true_cluster", T.StringType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_shipments(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Shipment records from files with an explicit schema ('NA' stays a
    region code; no inference pass)."""
    reader = spark.read.schema(SHIPMENT_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def read_events(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(EVENT_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record-level shipments over lineitem/orders/part/supplier/nation/region.

    Plain equi-joins: Spark picks broadcast or shuffle from its statistics
    and, at run time, from measured shuffle sizes.
    """
    t = lambda n: read_table(spark, sf_dir, n)

    nation = t("nation").select("n_nationkey", "n_regionkey")
    region = t("region").select("r_regionkey", "r_name")
    geo = (t("supplier").select("s_suppkey", "s_nationkey")
           .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("s_suppkey", "r_name"))
    part = t("part").select("p_partkey", "p_type", "p_size")
    orders = t("orders").select("o_orderkey", "o_orderpriority")
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                              "l_discount", "l_returnflag", "l_shipdate")
    joined = (li.join(geo, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(part, F.col("l_partkey") == F.col("p_partkey"))
              .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    d = F.col("l_shipdate").cast("date")
    return joined.select(
        d.alias("date"),
        F.col("r_name").alias("region"),
        F.col("p_type").alias("sku_category"),
        F.col("l_quantity").alias("shipping_weight_kg"),
        C.request_urgency_from_priority("o_orderpriority").alias("request_urgency"),
        F.when(F.col("l_returnflag") == "A", "air")
         .when(F.col("l_returnflag") == "R", "express")
         .otherwise("ground").alias("shipping_method"),
        F.col("p_size").cast("double").alias("avg_repair_cycle_days"),
        (F.col("l_discount") * 100).alias("failure_rate_pct"),
        C.weekday0(d).alias("day_of_week"),
        F.month(d).alias("month"),
        C.is_quarter_end(d).alias("is_quarter_end"),
    )


def net_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network-event records derived row by row from ``events``."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    src_ip = F.concat(F.lit("10.0.0."), (F.col("user_id") % 254 + 1).cast("string"))
    nbytes = F.round(F.col("value") * 100).cast("bigint")
    ts = F.col("ts").cast("timestamp_ntz")
    u20 = F.col("user_id") % 20
    return e.select(
        F.col("event_id"),
        ts.alias("timestamp"),
        src_ip.alias("source_ip"),
        F.concat(F.lit("192.168."), k.cast("string"), F.lit(".1")).alias("dest_ip"),
        (k + 1).alias("port"),
        F.col("value").alias("duration_ms"),
        nbytes.alias("bytes_transferred"),
        F.when(u20 == 0, "ICMP").when(u20.isin(1, 2), "UDP").otherwise("TCP").alias("protocol"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 200), "critical")
         .when(F.col("event_type") == "error", "error")
         .when(F.col("event_type") == "purchase", "warning")
         .otherwise("info").alias("severity"),
        F.concat(F.col("event_type"), F.lit(" by user "), F.col("user_id").cast("string"),
                 F.lit(" from "), src_ip, F.lit(": completed in "), nbytes.cast("string"),
                 F.lit("ms, code "), k.cast("string")).alias("log_message"),
        F.hour(ts).alias("hour_of_day"),
        C.weekday0(ts).alias("day_of_week"),
        F.col("event_type").alias("true_cluster"),
    )
