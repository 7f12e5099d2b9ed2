"""Session construction and cluster-safe helpers.

On a cluster the session is created by the platform; :func:`configure`
only fills settings that are unset. ``get_spark`` is for tests and the
local benchmark.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE coalesce partitions inside cached plans (fitted frames are cached)
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _default_heap() -> str:
    """Half the machine's memory, at most 8 GB (local mode: the driver JVM
    is the whole cluster)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    mb = max(1024, min(8192, int(total / 2 / (1024 * 1024))))
    return f"{mb}m"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidal") -> SparkSession:
    """Local session for tests and the benchmark (UI off, UTC, AQE on)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.driver.memory", os.environ.get("TIDAL_DRIVER_MEMORY", _default_heap()))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Fill required settings that the cluster did not set."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder there. Only a local session, whose
    driver and executors are one process, gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tidal-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidal`` importable in executor Python workers (what
    ``--py-files`` does): zip the package once per application and add it
    with ``addPyFile``. Needed by the pandas-UDF operators (per-series
    seasonal fit, Gramian blocks), whose functions are pickled by module
    reference. The zip is staged in a fresh driver folder only to hand it to
    Spark's file distribution."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="tidal-pkg-"), "tidal.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def spread(df: DataFrame) -> DataFrame:
    """``df``, a projection of a table scan, in at least as many partitions as
    there are cores. A table of one small file is one partition, which would
    leave compute-heavy rows (texts, vectors) to one core; large tables have
    many partitions and pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def require_columns(df: DataFrame, cols, op: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{op}: missing columns {missing}")
