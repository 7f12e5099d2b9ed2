"""Feature preparation: codes for categories, scalers, feature vectors.

Fitting a scaler reduces a column to a few numbers (mean, population std,
min, max) with one aggregation; they are inlined as literals when transforming,
so scoring is a per-row projection. Category codes are a distributed table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

EVENT_NUMERIC = ["duration_ms", "bytes_transferred", "port", "hour_of_day", "day_of_week"]
LOG_FEATURES = ["duration_ms", "bytes_transferred"]


def log1p_features(df: DataFrame, cols=LOG_FEATURES, suffix: str = "_log1p") -> DataFrame:
    """log(1 + x) into new columns (the raw columns stay)."""
    out = df
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.log1p(F.col(c).cast("double")))
    return out


@dataclass
class ScalerModel:
    cols: list
    mean: list
    scale: list

    def transform(self, df: DataFrame, suffix: str = "_scaled") -> DataFrame:
        out = df
        for c, m, s in zip(self.cols, self.mean, self.scale):
            out = out.withColumn(f"{c}{suffix}", (F.col(c).cast("double") - F.lit(m)) / F.lit(s))
        return out

    def vector(self, prefix_cols=None) -> list:
        return [F.col(f"{c}_scaled") for c in (prefix_cols or self.cols)]


def fit_standard_scaler(df: DataFrame, cols: list) -> ScalerModel:
    """Mean and *population* std per column (one aggregation); a zero std
    scales by 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    r = df.agg(*aggs).first()
    scale = [(r[f"s_{c}"] if r[f"s_{c}"] and r[f"s_{c}"] > 0 and not math.isnan(r[f"s_{c}"]) else 1.0)
             for c in cols]
    return ScalerModel(list(cols), [r[f"m_{c}"] for c in cols], scale)


@dataclass
class MinMaxModel:
    cols: list
    lo: list
    hi: list

    def transform(self, df: DataFrame, suffix: str = "_minmax") -> DataFrame:
        out = df
        for c, lo, hi in zip(self.cols, self.lo, self.hi):
            span = (hi - lo) if hi > lo else 1.0
            out = out.withColumn(f"{c}{suffix}", (F.col(c).cast("double") - F.lit(lo)) / F.lit(span))
        return out


def fit_minmax(df: DataFrame, cols: list) -> MinMaxModel:
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"lo_{c}"),
                 F.max(F.col(c).cast("double")).alias(f"hi_{c}")]
    r = df.agg(*aggs).first()
    return MinMaxModel(list(cols), [r[f"lo_{c}"] for c in cols], [r[f"hi_{c}"] for c in cols])


def fit_label_codes(df: DataFrame, cols: list) -> DataFrame:
    """(feature, value, code): the distinct values of each column as strings,
    numbered 0..n-1 in their order. Values are ranged over partitions, counted
    per range, and each range starts at the count of the ranges before it; no
    value passes the driver and no task holds more than one range."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                                          for c in cols])).alias("p")).select("p.*").where("value is not null").distinct()
    ranged = pairs.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id())
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint()  # ranges are sampled: fix them before they are read twice
    before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("feature", "part").agg(F.count(F.lit(1)).alias("n")) \
        .select("feature", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # one row a range
    rank = F.row_number().over(Window.partitionBy("feature", "part").orderBy("value")) - 1
    return ranged.withColumn("rank", rank).join(offsets, ["feature", "part"]) \
        .select("feature", "value", (F.col("start") + F.col("rank")).cast("int").alias("code"))


def _joined_code(df: DataFrame, codes: DataFrame, col: str, feature: str, how: str) -> DataFrame:
    t = codes.filter(F.col("feature") == feature).select(F.col("value").alias("_v"), F.col("code").alias(f"{col}_code"))
    return df.join(t, F.col(col).cast("string") == F.col("_v"), how).drop("_v")


def apply_codes(df: DataFrame, codes: DataFrame, cols: list) -> DataFrame:
    """Value -> code per column by equi-joins on the code table; values not
    seen in training get the next free code of their column."""
    sizes = {r["feature"]: r["n"] for r in codes.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a column
    out = df
    for c in cols:
        out = _joined_code(out, codes, c, c, "left")
        out = out.withColumn(f"{c}_code", F.coalesce(F.col(f"{c}_code"), F.lit(sizes.get(c, 0))))
    return out


def encode_unseen_zero(df: DataFrame, codes: DataFrame, col: str, feature: str | None = None) -> DataFrame:
    """Value -> code by a left join on the code table; values not seen in
    training get code 0."""
    j = _joined_code(df, codes, col, feature or col, "left")
    return j.withColumn(f"{col}_code", F.coalesce(F.col(f"{col}_code"), F.lit(0)))


def assemble(df: DataFrame, cols: list, out: str = "features") -> DataFrame:
    """Ordered feature vector (ARRAY<DOUBLE>) from numeric columns."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def pca_2d(df: DataFrame, feat: str, k: int = 2):
    """Centred k-d projection (Spark ML PCA does not centre in transform,
    so the mean is subtracted first) and the explained-variance ratios."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    dim = len(df.select(feat).first()[0])
    x = F.col(feat)
    means = df.agg(*[F.avg(x[i]).alias(f"m{i}") for i in range(dim)]).first()
    centred = df.withColumn("_c", F.transform(feat, lambda v, i: v - F.element_at(
        F.array(*[F.lit(float(means[f"m{j}"])) for j in range(dim)]), i + 1)))
    vec = centred.withColumn("_v", array_to_vector("_c"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vec)
    out = model.transform(vec).withColumn("pc", vector_to_array("_p")).drop("_c", "_v", "_p")
    return out, list(model.explainedVariance.toArray())
