"""Sinks and model persistence.

Outputs go under a base folder (on a cluster: a shared path, by default
below the session's ``spark.checkpoint.dir``). Model state is written as
small Parquet tables plus one metadata JSON row; loading a missing version
fails with the versions that exist.
"""

from __future__ import annotations

import datetime as _dt
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Folder of a version that holds a Spark ML pipeline instead of a table.
PIPELINE = "pipeline"

META_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("training_metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("config", T.MapType(T.StringType(), T.StringType())),
    T.StructField("description", T.StringType()),
])


def output_root(spark: SparkSession, sub: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "tidal-out", sub)


def write_assignments(assigned: DataFrame, summary: DataFrame, metrics: dict, out_dir: str,
                      partition_by: str | None = None) -> dict:
    """Events + cluster + score (Parquet), cluster summary (CSV) and a
    one-row metrics JSON. Overwrites, so a retried job converges."""
    spark = assigned.sparkSession
    w = assigned.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(os.path.join(out_dir, "assignments"))
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(
        os.path.join(out_dir, "cluster_summary"))
    m = spark.createDataFrame([{k: float(v) for k, v in metrics.items()}])
    m.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "metrics"))
    return {"assignments": os.path.join(out_dir, "assignments"),
            "cluster_summary": os.path.join(out_dir, "cluster_summary"),
            "metrics": os.path.join(out_dir, "metrics")}


def version_dir(root: str, name: str, version: str) -> str:
    return os.path.join(root, name, version)


def save_model(spark: SparkSession, root: str, name: str, version: str, model_type: str,
               tables: dict[str, DataFrame], metrics: dict, config: dict, description: str = "") -> str:
    """Write every state table as Parquet and the metadata record."""
    base = version_dir(root, name, version)
    for tname, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(os.path.join(base, tname))
    meta = spark.createDataFrame([(name, version, model_type,
                                   _dt.datetime.now(_dt.timezone.utc).isoformat(),
                                   {k: float(v) for k, v in metrics.items()},
                                   {k: json.dumps(v) if not isinstance(v, str) else v
                                    for k, v in config.items()},
                                   description)], META_SCHEMA)
    meta.coalesce(1).write.mode("overwrite").json(os.path.join(base, "metadata"))
    return base


def load_model(spark: SparkSession, root: str, name: str, version: str) -> tuple[dict, dict]:
    """(metadata dict, {table name: DataFrame}); missing version -> error."""
    base = version_dir(root, name, version)
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = jpath.getFileSystem(hconf)
    if not fs.exists(jpath):
        parent = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(root, name))
        have = [s.getPath().getName() for s in fs.listStatus(parent)] if fs.exists(parent) else []
        raise FileNotFoundError(f"model {name} version {version} not found; available: {sorted(have)}")
    meta = spark.read.schema(META_SCHEMA).json(os.path.join(base, "metadata")).first().asDict()
    tables = {}
    for st in fs.listStatus(jpath):
        t = st.getPath().getName()
        if t not in ("metadata", PIPELINE) and st.isDirectory():
            tables[t] = spark.read.parquet(os.path.join(base, t))
    return meta, tables
