"""Daily series aggregation (record level -> one row per series and day).

All aggregations are declarative ``groupBy``/``groupingSets`` so Spark runs
a partial (map-side) aggregate before the shuffle: a hot day or region
only ever ships one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import require_columns

LEVELS = {
    "all": [],
    "region": ["region"],
    "sku": ["sku_category"],
    "region_sku": ["region", "sku_category"],
}
SERIES_COLS = ("region", "sku_category")
NUMERIC_FEATURES = ["avg_repair_cycle_days", "failure_rate_pct", "day_of_week", "month"]
CATEGORICAL_FEATURES = ["region", "sku_category", "request_urgency", "shipping_method"]
TARGET = "total_shipping_weight_kg"


def _level_keys(level: str) -> list[str]:
    if level not in LEVELS:
        raise ValueError(f"unknown aggregation level {level!r}; use one of {sorted(LEVELS)}")
    return LEVELS[level]


def method_level_aggs(target: str = "shipping_weight_kg"):
    """First level: per (keys, shipping_method) partial sums and counts."""
    return [
        F.sum(target).alias("_w"), F.sum("request_urgency").alias("_u"),
        F.sum("avg_repair_cycle_days").alias("_c"), F.sum("failure_rate_pct").alias("_f"),
        F.max("is_quarter_end").alias("_q"), F.count(F.lit(1)).alias("_n"),
    ]


def series_level_aggs():
    """Second level over <= 3 method rows per group: totals, means, and the
    most frequent method (smallest name on ties) via ``min_by`` — all
    declarative aggregates (codegen), no object-hash ``mode`` buffer."""
    n = F.sum("_n")
    return [
        F.sum("_w").alias("total_shipping_weight_kg"),
        (F.sum("_u") / n).alias("mean_urgency"),
        (F.sum("_c") / n).alias("avg_repair_cycle_days"),
        (F.sum("_f") / n).alias("failure_rate_pct"),
        F.min_by("shipping_method", F.struct(-F.col("_n"), F.col("shipping_method"))).alias("shipping_method"),
        F.max("_q").alias("is_quarter_end"),
        n.alias("request_count"),
    ]


def _finish_daily(df: DataFrame, keys: list[str]) -> DataFrame:
    """Constant-within-group columns are derived from the date after grouping
    (deterministic, no ``first``); missing keys become 'ALL'."""
    out = df
    for k in SERIES_COLS:
        if k not in keys:
            out = out.withColumn(k, F.lit("ALL"))
    return out.select(
        "date", "region", "sku_category", "total_shipping_weight_kg",
        C.urgency_bucket("mean_urgency").alias("request_urgency"),
        "avg_repair_cycle_days", "failure_rate_pct", "shipping_method",
        C.weekday0("date").alias("day_of_week"), F.month("date").alias("month"),
        "is_quarter_end", "request_count",
    )


def daily_aggregate(shipments: DataFrame, level: str = "region") -> DataFrame:
    """Group records by (date[, region][, sku]): sum of weight, mean urgency
    bucketed half-even to 1..3, mean cycle and failure rate, most frequent
    method (smallest on ties), calendar columns, row count.

    Two levels: (date, keys, method) partial aggregates first (map-side
    combined, so a hot day ships one row per method per task), then the
    per-series row from <= 3 method rows."""
    require_columns(shipments, ["date", "shipping_weight_kg", "request_urgency",
                                "shipping_method"], "daily_aggregate")
    keys = _level_keys(level)
    per_method = shipments.groupBy("date", *keys, "shipping_method").agg(*method_level_aggs())
    agg = per_method.groupBy("date", *keys).agg(*series_level_aggs())
    return _finish_daily(agg, keys)


def daily_all_levels(shipments: DataFrame) -> DataFrame:
    """All four levels from one scan: the records are reduced to (date, region,
    SKU, method) first, and the grouping sets roll those few rows up, so the
    records are not repeated per level; ``level`` names the set."""
    fine = shipments.groupBy("date", "region", "sku_category", "shipping_method").agg(*method_level_aggs())
    sets = [[F.col("date"), F.col("shipping_method")],
            [F.col("date"), F.col("region"), F.col("shipping_method")],
            [F.col("date"), F.col("sku_category"), F.col("shipping_method")],
            [F.col("date"), F.col("region"), F.col("sku_category"), F.col("shipping_method")]]
    per_method = (fine.groupingSets(sets, "date", "region", "sku_category", "shipping_method")
                  .agg(*[F.sum(c).alias(c) for c in ("_w", "_u", "_c", "_f", "_n")], F.max("_q").alias("_q"),
                       F.grouping_id().alias("gid")))
    agg = per_method.groupBy("gid", "date", "region", "sku_category").agg(*series_level_aggs())
    # gid bits: date, region, sku_category, shipping_method (method always grouped)
    level = (F.when(F.col("gid") == 6, "all").when(F.col("gid") == 2, "region")
             .when(F.col("gid") == 4, "sku").otherwise("region_sku"))
    agg = (agg.withColumn("level", level)
           .withColumn("region", F.coalesce("region", F.lit("ALL")))
           .withColumn("sku_category", F.coalesce("sku_category", F.lit("ALL"))))
    return agg.select(
        "level", "date", "region", "sku_category", "total_shipping_weight_kg",
        C.urgency_bucket("mean_urgency").alias("request_urgency"),
        "avg_repair_cycle_days", "failure_rate_pct", "shipping_method",
        C.weekday0("date").alias("day_of_week"), F.month("date").alias("month"),
        "is_quarter_end", "request_count")


def daily_region_sku(shipments: DataFrame, target: str = "shipping_weight_kg") -> DataFrame:
    """Generator-style aggregate: sum of the target + means, is_quarter_end."""
    agg = shipments.groupBy("date", "region", "sku_category").agg(
        F.sum(target).alias(f"total_{target}"),
        F.avg("request_urgency").alias("request_urgency"),
        F.avg("avg_repair_cycle_days").alias("avg_repair_cycle_days"),
        F.avg("failure_rate_pct").alias("failure_rate_pct"),
        F.max("is_quarter_end").alias("is_quarter_end"),
    )
    return agg.select("date", "region", "sku_category", f"total_{target}",
                      "request_urgency", "avg_repair_cycle_days", "failure_rate_pct",
                      C.weekday0("date").alias("day_of_week"),
                      F.month("date").alias("month"), "is_quarter_end")


def prophet_frame(shipments: DataFrame, include_regressors: bool = True,
                  series_keys: tuple[str, ...] = ()) -> DataFrame:
    """Forecast-format frame: ds, y (+ is_month_end, failure_rate_pct,
    avg_urgency). ``series_keys`` keeps one series per key instead of one
    global series."""
    agg = shipments.groupBy("date", *series_keys).agg(
        F.sum("shipping_weight_kg").alias("y"),
        F.avg("request_urgency").alias("avg_urgency"),
        F.avg("failure_rate_pct").alias("failure_rate_pct"),
        F.avg("avg_repair_cycle_days").alias("avg_repair_cycle_days"),
        F.max("is_quarter_end").alias("is_quarter_end"),
    )
    cols = [*series_keys, F.col("date").alias("ds"), "y"]
    if include_regressors:
        cols += [((F.dayofmonth("date") >= 28) | (F.col("is_quarter_end") == 1))
                 .cast("double").alias("is_month_end"),
                 "failure_rate_pct", "avg_urgency"]
    return agg.select(*cols)
