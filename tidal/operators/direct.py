"""Direct forecaster: one linear model per horizon step, all steps in one
coefficient row per version.

Features of an origin day: the last ``HISTORY`` values, the calendar, from v2
on the four categories, in v3 also the exogenous numbers. A category counts as
the slot of its hash (sparse one-hot over ``SLOTS`` slots), so the number of
different values is not bounded; Spark ML's iterative solver fits the sparse
vectors. Scoring, in batch or from requests, is one SQL projection: the row's
lags, calendar and slots against the coefficients joined by version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import sinks
from . import series as S

CATEGORIES = ["region", "sku_category", "request_urgency", "shipping_method"]
EXOGENOUS = ["failure_rate_pct", "avg_repair_cycle_days"]
SLOTS = 4096
MAX_ITER = 60
BAND_Z = 1.96  # fixed value that must equal the reference: band = 1.96 x validation MAE
VERSIONS = {
    "v1": {"categories": [], "exogenous": [], "reg": 0.0},
    "v2": {"categories": CATEGORIES, "exogenous": [], "reg": 0.01},
    "v3": {"categories": CATEGORIES, "exogenous": EXOGENOUS, "reg": 0.1},
}
MODEL_NAME = "direct_forecaster"

TABLE = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("lags", T.IntegerType()),
    T.StructField("intercepts", T.ArrayType(T.DoubleType())),
    T.StructField("numeric", T.ArrayType(T.ArrayType(T.DoubleType()))),      # per step: lags, dow, month, exogenous
    T.StructField("slots", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),  # category:slot -> per step
    T.StructField("val_mae", T.DoubleType()),
])


def slot(name: str, value: Column | None = None) -> Column:
    """The slot of a category's value (null is a value of its own)."""
    v = F.coalesce((F.col(name) if value is None else value).cast("string"), F.lit(""))
    return F.pmod(F.xxhash64(F.lit(name), v), F.lit(SLOTS)).cast("int")


def origin_frame(daily: DataFrame, series: list[str], target: str = "y", date_col: str = "ds",
                 lags: int = S.HISTORY, horizon: int = S.HORIZON) -> DataFrame:
    """Every day as an origin: ``lags`` (its own value first, then back in
    time) and ``targets`` (the next days; fewer at the end of the series).
    Days with less history have no row."""
    w = Window.partitionBy(*series).orderBy(date_col) if series else Window.orderBy(date_col)

    def values(lo: int, hi: int) -> Column:
        return F.transform(F.collect_list(F.struct(F.col(target).cast("double").alias("v"))).over(w.rowsBetween(lo, hi)),
                           lambda s: s["v"])

    out = daily.withColumn("lags", F.reverse(values(-(lags - 1), 0))).withColumn("targets", values(1, horizon))
    return out.where((F.size("lags") == lags) & ~F.exists("lags", lambda v: v.isNull())) \
        .withColumn("dow", F.weekday(date_col).cast("double")).withColumn("month", F.month(date_col).cast("double"))


def _numeric(exogenous: list[str]) -> Column:
    return F.concat("lags", F.array("dow", "month", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in exogenous]))


def _prepared(frame: DataFrame, version: str) -> tuple[list, DataFrame]:
    """The stages that turn the frame's features into one sparse vector."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.functions import array_to_vector
    v = VERSIONS[version]
    out = frame.withColumn("numeric", array_to_vector(_numeric(v["exogenous"])))
    stages = []
    if v["categories"]:
        names = [f"{c}_slot" for c in v["categories"]]
        for c, n in zip(v["categories"], names):
            out = out.withColumn(n, slot(c).cast("double"))
        full = frame.sparkSession.createDataFrame([tuple([float(SLOTS - 1)] * len(names))], ", ".join(f"{n} double" for n in names))
        stages.append(OneHotEncoder(inputCols=names, outputCols=[f"{n}_vec" for n in names], dropLast=False).fit(full))
    stages.append(VectorAssembler(inputCols=["numeric", *[f"{c}_slot_vec" for c in v["categories"]]], outputCol="x"))
    return stages, out


@dataclass
class DirectFit:
    version: str
    pipeline: object       # PipelineModel over the prepared frame: predictions yhat_1..yhat_H
    row: tuple             # its coefficients as a row of ``TABLE`` (val_mae filled by ``with_band``)


def fit(train: DataFrame, version: str = "v3", lags: int = S.HISTORY, horizon: int = S.HORIZON, parallelism: int = 4) -> DirectFit:
    """One ``LinearRegression`` per step on one persisted frame of sparse
    vectors; the steps are fitted concurrently."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import LinearRegression
    v = VERSIONS[version]
    stages, data = _prepared(train, version)
    for s in stages:
        data = s.transform(data)
    data = data.select("x", "targets").persist(StorageLevel.MEMORY_AND_DISK)
    data.count()
    solver = "l-bfgs" if v["categories"] else "normal"

    def one(h):
        lr = LinearRegression(featuresCol="x", labelCol="target", predictionCol=f"yhat_{h}", regParam=v["reg"],
                              elasticNetParam=0.0, solver=solver, maxIter=MAX_ITER)
        return lr.fit(data.where(F.size("targets") >= h).withColumn("target", F.col("targets")[h - 1]).where("target is not null"))

    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        models = list(ex.map(one, range(1, horizon + 1)))
    data.unpersist()
    return DirectFit(version, PipelineModel([*stages, *models]), _row(version, models, lags))


def _row(version: str, models: list, lags: int) -> tuple:
    v = VERSIONS[version]
    n = lags + 2 + len(v["exogenous"])
    coefs = [m.coefficients.toArray() for m in models]
    numeric = [[*c[:n].tolist(), *([0.0] * (len(EXOGENOUS) - len(v["exogenous"])))] for c in coefs]
    slots = {}
    for i, name in enumerate(v["categories"]):
        part = [c[n + i * SLOTS:n + (i + 1) * SLOTS] for c in coefs]
        for k in sorted({int(j) for p in part for j in p.nonzero()[0]}):
            slots[f"{name}:{k}"] = [float(p[k]) for p in part]
    return version, lags, [float(m.intercept) for m in models], numeric, slots, None


def table(spark: SparkSession, fits: list[DirectFit]) -> DataFrame:
    """The coefficients, one row per version."""
    return spark.createDataFrame([f.row for f in fits], TABLE)


def steps(coefs: DataFrame, frame: DataFrame, version: Column) -> DataFrame:
    """``frame`` with ``yhat``, the forecasts of all steps, by the coefficients
    of ``version`` (a row of an unknown version has no result). The frame
    needs lags, dow, month, the categories and the exogenous columns."""
    c = coefs.select(F.struct("*").alias("_m"))
    j = frame.withColumn("_version", version).join(F.broadcast(c), F.col("_version") == F.col("_m.version"))  # one row a version
    x = _numeric(EXOGENOUS)
    keys = F.array(*[F.concat(F.lit(f"{n}:"), slot(n).cast("string")) for n in CATEGORIES])
    j = j.withColumn("_x", x).withColumn("_w", F.filter(F.transform(keys, lambda k: F.try_element_at(F.col("_m.slots"), k)),
                                                        lambda w: w.isNotNull()))

    def dot(row: Column) -> Column:
        return F.aggregate(F.zip_with("_x", row, lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)

    yhat = F.transform("_m.numeric", lambda row, h: F.element_at("_m.intercepts", h + 1) + dot(row)
                       + F.aggregate("_w", F.lit(0.0), lambda s, w: s + F.element_at(w, h + 1)))
    return j.withColumn("yhat", yhat).withColumn("val_mae", F.col("_m.val_mae")).drop("_m", "_x", "_w")


def predict(coefs: DataFrame, frame: DataFrame, version: str, series: list[str], date_col: str = "ds",
            model_name: str | None = None) -> DataFrame:
    """Long forecasts (series, origin, h, ds, y, yhat, lower, upper) for every
    origin, also for those whose next days are not there yet (y is null)."""
    s = steps(coefs, frame, F.lit(version)).withColumn("_target", F.col("targets"))
    out = s.select(*series, F.col(date_col).alias("origin"), "_target", "val_mae", F.posexplode("yhat").alias("_h", "yhat"))
    band = F.lit(BAND_Z) * F.col("val_mae")
    return out.select(*series, "origin", (F.col("_h") + 1).alias("h"), F.date_add("origin", F.col("_h") + 1).alias("ds"),
                      F.get("_target", F.col("_h")).alias("y"), "yhat", (F.col("yhat") - band).alias("lower"),
                      (F.col("yhat") + band).alias("upper"), F.lit(model_name or f"direct_{version}").alias("model"))


def with_band(fits: list[DirectFit], validation: DataFrame) -> list[DirectFit]:
    """The fits with the mean absolute error on the validation origins."""
    spark = validation.sparkSession
    coefs = table(spark, fits)
    for f in fits:
        p = predict(coefs, validation, f.version, [])
        mae = p.where("y is not null").agg(F.avg(F.abs(F.col("y") - F.col("yhat")))).first()[0]
        f.row = (*f.row[:-1], float(mae) if mae is not None else None)
    return fits


def last_origins(frame: DataFrame, series: list[str], date_col: str = "ds") -> DataFrame:
    """The last origin of every series, whose forecasts lie past the data."""
    last = frame.groupBy(*series).agg(F.max(date_col).alias(date_col))
    return frame.join(last, [*series, date_col], "left_semi")


# ---- persistence -------------------------------------------------------------

def save(spark: SparkSession, root: str, model: DirectFit, description: str = "") -> str:
    """The coefficient row as a table and the fitted Spark ML pipeline."""
    base = sinks.save_model(spark, root, MODEL_NAME, model.version, "direct_forecaster",
                            {"coefficients": table(spark, [model])}, {"val_mae": model.row[-1] or 0.0},
                            {"categories": VERSIONS[model.version]["categories"], "slots": SLOTS}, description)
    model.pipeline.write().overwrite().save(f"{base}/{sinks.PIPELINE}")
    return base


def load(spark: SparkSession, root: str, version: str) -> DirectFit:
    """The saved version; a missing one names those that exist."""
    from pyspark.ml import PipelineModel
    _, tables = sinks.load_model(spark, root, MODEL_NAME, version)
    row = tables["coefficients"].first()
    pipeline = PipelineModel.load(f"{sinks.version_dir(root, MODEL_NAME, version)}/{sinks.PIPELINE}")
    return DirectFit(version, pipeline, tuple(row[c] for c in TABLE.names))


def pipeline_predictions(model: DirectFit, frame: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the pipeline's own forecasts, to compare with ``steps``."""
    _, data = _prepared(frame, model.version)
    out = model.pipeline.transform(data)
    steps_ = [c for c in out.columns if c.startswith("yhat_")]
    return out.select(*keep, F.array(*steps_).alias("yhat"))
