"""End-to-end event clustering: fit once, score anywhere (batch or stream).

Fit: log1p + population-std scaling of 5 numerics, TF-IDF of the cleaned
log text -> 20 LSA components, K search (inertia + silhouette) or a given
K, best-of-n k-means, rule labels, training distance bounds. Every fitted
part is a small table; scoring is projections plus broadcast-size lookups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import flag_anomalous
from ..operators import cluster as CL
from ..operators import features as FE
from ..operators import interpret as IN
from ..operators import text as X
from ..sources import sinks

NUMERIC = ["duration_ms_log1p", "bytes_transferred_log1p", "port", "hour_of_day", "day_of_week"]


@dataclass
class EventClusteringModel:
    scaler: FE.ScalerModel
    tfidf: X.TfidfModel
    lsa: X.LsaModel
    centers: list
    lo: float
    hi: float
    labels: dict
    version: str = "v1"
    inertia: float = 0.0
    k_reason: str = "given"

    @property
    def k(self) -> int:
        return len(self.centers)

    @property
    def feature_names(self) -> list:
        return [*FE.EVENT_NUMERIC, *[f"lsa_component_{i}" for i in range(self.lsa.components.shape[0])]]

    def features(self, events: DataFrame) -> DataFrame:
        """events + ``features`` (5 scaled numerics ++ k LSA components): a
        per-row projection, whatever the ids."""
        e = self.scaler.transform(FE.log1p_features(events))
        e = X.lsa_scores(e, "log_message", self.tfidf, self.lsa, "_lsa")
        numeric = F.array(*[F.col(f"{c}_scaled").cast("double") for c in NUMERIC])
        return e.withColumn("features", F.concat(numeric, "_lsa")).drop("_lsa")

    def classify(self, events: DataFrame) -> DataFrame:
        """cluster, interpretation, anomaly score (training bounds, clamped),
        anomaly flag and model version per event."""
        a = CL.assign(self.features(events), "features", self.centers)
        a = a.withColumn("anomaly_score", CL.anomaly_score(a, self.lo, self.hi))
        lab = events.sparkSession.createDataFrame(
            [(int(c), s) for c, s in sorted(self.labels.items())], "cluster int, interpretation string")
        a = IN.label_or_default(a, lab)
        return a.withColumn("is_anomalous", flag_anomalous("anomaly_score")) \
                .withColumn("model_version", F.lit(self.version))

    # ---- persistence -----------------------------------------------------------
    def save(self, spark: SparkSession, root: str, name: str = "event_clustering") -> str:
        sc = spark.createDataFrame([(c, float(m), float(s)) for c, m, s in
                                    zip(self.scaler.cols, self.scaler.mean, self.scaler.scale)],
                                   "col string, mean double, scale double")
        cen = spark.createDataFrame([(i, j, float(v)) for i, c in enumerate(self.centers)
                                     for j, v in enumerate(c)], "cluster int, dim int, value double")
        lab = spark.createDataFrame([(int(c), s) for c, s in self.labels.items()],
                                    "cluster int, interpretation string")
        lsa = self.lsa.basis(spark)
        sv = spark.createDataFrame([(i, float(s), float(e)) for i, (s, e) in enumerate(
            zip(self.lsa.singular_values, self.lsa.explained_variance))],
            "component int, singular_value double, explained_variance double")
        metrics = {"inertia": self.inertia, "train_min_distance": self.lo,
                   "train_max_distance": self.hi, "k": self.k,
                   "lsa_total_variance": self.lsa.total_variance, "n_docs": self.tfidf.n_docs}
        config = {"min_len": self.tfidf.min_len, "ngrams": self.tfidf.ngrams,
                  "ip_token": self.tfidf.ip_token, "num_token": self.tfidf.num_token,
                  "k_reason": self.k_reason}
        return sinks.save_model(spark, root, name, self.version, "kmeans",
                                {"scaler": sc, "vocab": self.tfidf.vocabulary(spark), "lsa": lsa, "lsa_values": sv,
                                 "centers": cen, "labels": lab}, metrics, config,
                                "k-means over scaled numerics and LSA text components")

    @staticmethod
    def load(spark: SparkSession, root: str, version: str, name: str = "event_clustering"):
        import json
        meta, t = sinks.load_model(spark, root, name, version)
        m, cfg = meta["training_metrics"], meta["config"]
        sc = sorted(t["scaler"].collect(), key=lambda r: NUMERIC.index(r["col"]))
        scaler = FE.ScalerModel([r["col"] for r in sc], [r["mean"] for r in sc], [r["scale"] for r in sc])
        vocab = sorted((tuple(r) for r in t["vocab"].select("term", "df", "total_tf", "term_index", "idf").collect()),
                       key=lambda r: r[3])
        tfidf = X.TfidfModel(vocab, int(m["n_docs"]), json.loads(cfg["min_len"]),
                             json.loads(cfg["ngrams"]), cfg["ip_token"], cfg["num_token"])
        basis = t["lsa"].collect()
        k = max(r["component"] for r in basis) + 1
        v = max(r["term_index"] for r in basis) + 1
        comps = np.zeros((k, v))
        for r in basis:
            comps[r["component"], r["term_index"]] = r["loading"]
        svs = sorted(t["lsa_values"].collect(), key=lambda r: r["component"])
        lsa = X.LsaModel(comps, np.array([r["singular_value"] for r in svs]),
                         np.array([r["explained_variance"] for r in svs]), m["lsa_total_variance"],
                         int(m["n_docs"]))
        cen = t["centers"].collect()
        kk = max(r["cluster"] for r in cen) + 1
        dim = max(r["dim"] for r in cen) + 1
        centers = [[0.0] * dim for _ in range(kk)]
        for r in cen:
            centers[r["cluster"]][r["dim"]] = r["value"]
        labels = {r["cluster"]: r["interpretation"] for r in t["labels"].collect()}
        return EventClusteringModel(scaler, tfidf, lsa, centers, m["train_min_distance"],
                                    m["train_max_distance"], labels, version, m["inertia"],
                                    cfg.get("k_reason", ""))


def fit_event_features(events: DataFrame, n_components: int = X.N_COMPONENTS) -> EventClusteringModel:
    """Scaler, vocabulary and LSA basis of the events; no clusters yet."""
    scaler = FE.fit_standard_scaler(FE.log1p_features(events), NUMERIC)
    tfidf = X.fit_tfidf(events, "log_message")
    return EventClusteringModel(scaler, tfidf, X.fit_lsa(events, "log_message", tfidf, n_components), [], 0.0, 0.0, {})


def fit_event_clustering(events: DataFrame, k: int | None = None, n_init: int = CL.N_INIT,
                         k_range=CL.K_RANGE, version: str = "v1", search_n_init: int = CL.N_INIT) -> tuple[EventClusteringModel, DataFrame]:
    """Full fit; returns the model and the K-search curve (or None). One
    persisted frame of features serves the search, the fit and the labels."""
    from pyspark import StorageLevel
    model = fit_event_features(events)
    feats = model.features(events).select("features", "severity", "duration_ms", "bytes_transferred", "hour_of_day",
                                          "protocol").persist(StorageLevel.MEMORY_AND_DISK)
    curve = None
    if k is None:
        curve, fits = CL.search(feats, "features", k_range, search_n_init)
        sel = CL.select_k(curve).first()
        k, reason = int(sel["selected_k"]), sel["reason"]
        fit = fits[k] if n_init == search_n_init else CL.kmeans_fit(feats, "features", k, n_init)
    else:
        reason, fit = "given", CL.kmeans_fit(feats, "features", k, n_init)
    assigned = CL.assign(feats, "features", fit.centers)
    labels = {r["cluster"]: r["interpretation"] for r in IN.cluster_label_rules(assigned, k).collect()}
    feats.unpersist()
    model.centers, model.lo, model.hi = fit.centers, fit.train_min_distance, fit.train_max_distance
    model.labels, model.version, model.inertia, model.k_reason = labels, version, fit.inertia, reason
    return model, curve
