"""Clustering invariants: assignment, Lloyd steps, silhouettes, metrics, labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidal.operators import cluster as CL
from tidal.operators import cluster_eval as CE
from tidal.operators import interpret as IN

RNG = np.random.default_rng(7)


def _points(spark, n=60, dim=3, k=3):
    centers = RNG.normal(0, 5, size=(k, dim))
    rows = []
    for i in range(n):
        c = i % k
        rows.append((i, [float(v) for v in centers[c] + RNG.normal(0, 1, dim)], int(c)))
    return spark.createDataFrame(rows, "id long, x array<double>, truth int"), rows


def test_assign_matches_numpy(spark):
    df, rows = _points(spark)
    centers = [r[1] for r in rows[:3]]
    got = {r["id"]: r["cluster"] for r in CL.assign(df, "x", centers).collect()}
    for i, x, _ in rows:
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centers]
        assert got[i] == int(np.argmin(d))


def test_lloyd_step_never_raises_inertia(spark):
    df, rows = _points(spark)
    centers = [r[1] for r in rows[:3]]
    prev = CL.assign(df, "x", centers).agg(F.sum("sq_distance")).first()[0]
    for _ in range(3):
        _, centers = CL.lloyd_step(df, "x", centers)
        cur = CL.assign(df, "x", centers).agg(F.sum("sq_distance")).first()[0]
        assert cur <= prev + 1e-9
        prev = cur


def test_silhouette_from_sums_equals_brute_force(spark):
    df, rows = _points(spark, n=45)
    a = CL.assign(df, "x", [r[1] for r in rows[:3]])
    got = {r["id"]: r["silhouette"] for r in CE.silhouette_samples(a, "x", "cluster", 3).collect()}
    lab = {r["id"]: r["cluster"] for r in a.collect()}
    X = {i: np.array(x) for i, x, _ in rows}
    for i in X:
        own = [j for j in X if lab[j] == lab[i] and j != i]
        if not own:
            assert got[i] == 0.0
            continue
        aa = np.mean([np.sum((X[i] - X[j]) ** 2) for j in own])
        bb = min(np.mean([np.sum((X[i] - X[j]) ** 2) for j in X if lab[j] == c])
                 for c in set(lab.values()) if c != lab[i])
        assert got[i] == pytest.approx((bb - aa) / max(aa, bb), abs=1e-9)


def test_silhouette_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector
    df, rows = _points(spark, n=60)
    a = CL.assign(df, "x", [r[1] for r in rows[:3]])
    ours = CE.silhouette_sq_summary(a, "x", "cluster", 3)
    ev = ClusteringEvaluator(featuresCol="v", predictionCol="cluster", distanceMeasure="squaredEuclidean")
    theirs = ev.evaluate(a.withColumn("v", array_to_vector("x")).withColumn("cluster", F.col("cluster").cast("double")))
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_external_metrics_identity_and_invariants(spark):
    df, _ = _points(spark, n=60)
    same = CE.external_metrics(df.withColumn("p", F.col("truth")), "p", "truth").first()
    for k in ("adjusted_rand", "nmi", "homogeneity", "completeness", "v_measure", "purity"):
        assert same[k] == pytest.approx(1.0)
    rnd = df.withColumn("p", (F.col("id") * 7 % 4).cast("int"))
    m = CE.external_metrics(rnd, "p", "truth").first()
    assert m["v_measure"] == pytest.approx(m["nmi"], abs=1e-12)
    largest = max(r["count"] for r in df.groupBy("truth").count().collect()) / 60
    assert m["purity"] >= largest - 1e-12


def test_elbow_flat_curve_takes_first_k(spark):
    c = spark.createDataFrame([(k, 5.0, 0.1) for k in range(3, 11)], "k int, inertia double, silhouette double")
    assert CL.elbow_point(c).first()["elbow_k"] == 3


def test_select_k_silhouette_override(spark):
    inert = [100, 60, 30, 25, 22, 20, 19, 18]
    sil_small = [0.30, 0.31, 0.33, 0.34, 0.35, 0.36, 0.36, 0.37]   # best beats elbow by <= 0.05
    sil_big = [0.30, 0.31, 0.20, 0.34, 0.35, 0.36, 0.60, 0.37]     # best beats elbow by > 0.05
    def curve(s):
        return spark.createDataFrame([(k, float(i), float(v)) for k, i, v in zip(range(3, 11), inert, s)],
                                     "k int, inertia double, silhouette double")
    r1 = CL.select_k(curve(sil_small)).first()
    assert r1["selected_k"] == r1["elbow_k"] and r1["reason"] == "elbow"
    r2 = CL.select_k(curve(sil_big)).first()
    assert r2["selected_k"] == 9 and r2["reason"] == "silhouette"


def test_anomaly_constant_bounds_all_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "distance double")
    assert [r[0] for r in df.select(CL.anomaly_score(df, 1.0, 1.0)).collect()] == [0.0, 0.0]


def test_empty_cluster_label_and_default(spark):
    ev = spark.createDataFrame([(0, "info", 2000.0, 500, 3, "TCP"), (0, "info", 2000.0, 500, 3, "TCP")],
                               "cluster int, severity string, duration_ms double, bytes_transferred long, "
                               "hour_of_day int, protocol string")
    lab = {r["cluster"]: r["interpretation"] for r in IN.cluster_label_rules(ev, 2).collect()}
    assert lab[1] == "Empty cluster"
    assert lab[0] == "info severity, long duration, low data transfer, off-hours activity"
    ids = spark.range(3).select(F.col("id").cast("int").alias("cluster"))
    out = {r["cluster"]: r["interpretation"] for r in IN.label_or_default(ids, IN.cluster_label_rules(ev)).collect()}
    assert out[2] == "Cluster 2"


def test_single_centroid_separation_infinite(spark):
    df, rows = _points(spark, n=12, k=1)
    a = CL.assign(df, "x", [rows[0][1]])
    q = CE.cluster_quality(a, "id", "x", "cluster", 3).first()
    assert q["separation"] == float("inf")


def brute_silhouette(X, lab, dist):
    out = {}
    for i in X:
        own = [j for j in X if lab[j] == lab[i] and j != i]
        others = [np.mean([dist(X[i], X[j]) for j in X if lab[j] == c]) for c in set(lab.values()) if c != lab[i]]
        if not own or not others:
            out[i] = 0.0
            continue
        aa, bb = np.mean([dist(X[i], X[j]) for j in own]), min(others)
        out[i] = (bb - aa) / max(aa, bb)
    return out


def test_euclidean_silhouette_equals_brute_force(spark):
    df, rows = _points(spark, n=45)
    a = CL.assign(df, "x", [r[1] for r in rows[:3]])
    lab = {r["id"]: r["cluster"] for r in a.collect()}
    X = {i: np.array(x) for i, x, _ in rows}
    want = brute_silhouette(X, lab, lambda u, v: float(np.linalg.norm(u - v)))
    got = {r["id"]: r["silhouette"] for r in CE.silhouette(a, "id", "x", "cluster").collect()}
    assert got == pytest.approx(want, abs=1e-9)
    part = {r["id"]: r["silhouette"] for r in CE.silhouette(a, "id", "x", "cluster", sample=30).collect()}
    assert len(part) == 45 and abs(np.mean(list(part.values())) - np.mean(list(want.values()))) < 0.1


def test_search_makes_all_starts_and_measures_the_fits(spark):
    df, rows = _points(spark, n=120, dim=3, k=4)
    curve, fits = CL.search(df, "x", (3, 5), n_init=3)
    X = {i: np.array(x) for i, x, _ in rows}
    got = {r["k"]: r for r in curve.collect()}
    assert set(got) == {3, 4, 5}
    for k, fit in fits.items():
        lab = {i: int(np.argmin([np.sum((x - np.array(c)) ** 2) for c in fit.centers])) for i, x in X.items()}
        cost = sum(np.sum((x - np.array(fit.centers[lab[i]])) ** 2) for i, x in X.items())
        assert got[k]["inertia"] == pytest.approx(cost) and fit.inertia == pytest.approx(cost)
        for c in range(k):  # settled: every centre is the mean of its points
            own = [X[i] for i in X if lab[i] == c]
            assert not own or np.allclose(np.mean(own, 0), fit.centers[c], atol=0.05)
        want = brute_silhouette(X, lab, lambda u, v: float(np.linalg.norm(u - v)))
        sq = brute_silhouette(X, lab, lambda u, v: float(np.sum((u - v) ** 2)))
        assert got[k]["silhouette"] == pytest.approx(np.mean(list(want.values())), abs=1e-9)
        assert got[k]["silhouette_sq"] == pytest.approx(np.mean(list(sq.values())), abs=1e-9)


def test_all_starts_advance_and_the_best_is_kept(spark):
    from tidal.operators import kmeans as KM
    df, _ = _points(spark, n=90, dim=2, k=3)
    vectors, dim = KM.prepared(df, "x")
    mean, variance = KM.mean_and_variance(vectors, dim)
    models = KM.advance(vectors, KM.starts(vectors, [(3, s) for s in range(6)], dim), mean, variance, 100, 1e-4)
    assert len(models) == 6 and all(len(m.centers) == 3 and m.passes >= 1 for m in models)
    assert KM.best_of(models)[3].inertia == min(m.inertia for m in models)
    again = KM.starts(vectors, [(3, 0)], dim)[0]
    assert np.array_equal(again.centers, KM.starts(vectors, [(3, 0), (2, 9)], dim)[0].centers)
    vectors.unpersist()


def test_minibatch_stays_near_the_full_fit_and_visits_every_point(spark):
    df, _ = _points(spark, n=2000, dim=3, k=4)
    full, mini = CL.kmeans_fit(df, "x", 4, n_init=3), CL.kmeans_minibatch(df, "x", 4, n_init=3, batches=5)
    assert full.inertia <= mini.inertia * (1 + 1e-9) and mini.inertia <= 1.1 * full.inertia


def test_kmeans_far_from_the_origin_and_with_equal_points(spark):
    far = spark.createDataFrame([(i, [1e7 + (i % 2) * 3.0, 1e7]) for i in range(20)], "id long, x array<double>")
    fit = CL.kmeans_fit(far, "x", 2, n_init=2)
    assert fit.inertia == pytest.approx(0.0, abs=1e-6)
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(8)] + [(9, None)], "id long, x array<double>")
    assert CL.kmeans_fit(same, "x", 3, n_init=2).inertia == pytest.approx(0.0)


def test_one_pass_over_cells_equals_brute_force_for_all_models(spark):
    from tidal.operators import kmeans as KM
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1300, 3)) + 1e5
    x[:4] = x[4]
    centers = [x[[0, 1, 50]], x[[7, 8, 9]], x[[3, 200, 700, 900]]]  # the first two of the first model are equal
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(3)
    cells = KM.in_cells(df)
    back = np.concatenate([np.frombuffer(r["cell"]).reshape(r["n"], -1) for r in cells.collect()])
    assert np.array_equal(back, np.array([r["x"] for r in df.collect()]))
    models = [KM.Model(len(c), 0, c) for c in centers]
    n, cost, sums = KM.group_sums(cells, models, x.mean(0))
    bounds, at = KM.distance_bounds(cells, centers), 0
    for c, (inertia, lo, hi) in zip(centers, bounds):
        d = np.square(x[:, None] - c[None]).sum(2)
        own = d.argmin(1)
        for j in range(len(c)):
            assert n[at] == (own == j).sum()
            assert np.isclose(cost[at], d[own == j, j].sum())
            assert np.allclose(sums[at], (x[own == j] - x.mean(0)).sum(0), atol=1e-6)
            at += 1
        assert np.allclose([inertia, lo, hi], [d.min(1).sum(), np.sqrt(d.min()), np.sqrt(d.min(1).max())])


def test_mean_distances_hold_few_rows_at_once_and_equal_brute_force(spark):
    assert CE.ROWS * CE.SAMPLE * 8 <= 16 << 20
    rng = np.random.default_rng(5)
    x, c = rng.normal(size=(1100, 2)), rng.integers(0, 3, 1100)
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, c))], "id long, x array<double>, cluster int")
    got = {r["id"]: {m["c"]: m["m"] for m in r["md"]} for r in CE.mean_distances(df.coalesce(1), "id", "x", "cluster").collect()}
    for i in (0, 511, 512, 1024, 1099):
        d = np.sqrt(np.square(x - x[i]).sum(1))
        for k in range(3):
            others = (c == k) & (np.arange(1100) != i)
            assert np.isclose(got[i][k], d[others].mean())


def test_a_pass_is_one_job_of_one_stage_and_equals_the_pass_over_the_frame(spark):
    from tidal.operators import kmeans as KM
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 3))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").coalesce(5)
    points = KM.in_matrices(df).cache()
    assert np.array_equal(np.concatenate(points.collect()), np.array([r["x"] for r in df.collect()]))
    models = [KM.Model(4, s, x[s:s + 4]) for s in range(3)]
    spark.sparkContext.setJobGroup("pass", "one pass")
    try:
        n, cost, sums = KM.group_sums(points, models, x.mean(0))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    jobs = status.getJobIdsForGroup("pass")
    assert len(jobs) == 1 and len(status.getJobInfo(jobs[0]).stageIds) == 1
    for one, other in zip((n, cost, sums), KM.group_sums(df, models, x.mean(0))):
        assert np.allclose(one, other)
    KM.DIRECT, held = 0, KM.DIRECT  # the tasks in between give the same sums
    try:
        for one, other in zip((n, cost, sums), KM.group_sums(points, models, x.mean(0))):
            assert np.allclose(one, other)
    finally:
        KM.DIRECT = held
        points.unpersist()


def test_mean_and_variance_take_one_pass_over_the_matrices(spark):
    from tidal.operators import kmeans as KM
    x = np.random.default_rng(3).normal(size=(1500, 3)) * [1.0, 2.0, 3.0] + 1e6
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(5)
    mean, variance = KM.mean_and_variance(KM.in_matrices(df), 3)
    assert np.allclose(mean, x.mean(0), rtol=1e-13) and variance == pytest.approx(x.var(0).mean(), rel=1e-9)


def test_distances_to_the_sample_are_held_for_few_points(monkeypatch):
    draw = np.random.default_rng(5)
    x, y, member = draw.normal(size=(101, 4)), draw.normal(size=(70, 4)), np.eye(3)[draw.integers(0, 3, 70)]
    x[:9] = y[:9]
    held, whole = [], CE._distances
    monkeypatch.setattr(CE, "_distances", lambda a, b: held.append(len(a)) or whole(a, b))
    sums = CE._distance_sums(x, y, member)
    assert max(held) == CE.NEAR and sum(held) == len(x)
    assert np.allclose(sums, np.linalg.norm(x[:, None] - y[None], axis=2) @ member)
    assert CE._distance_sums(x[:0], y, member).shape == (0, 3)


def test_long_vectors_are_measured_in_batches_to_the_last_bit(spark):
    from tidal.functions import vectors as VX
    draw = np.random.default_rng(11)
    x = [[float(v) for v in r] for r in draw.normal(size=(700, 25)) * 1e3]
    rows = [(i, v) for i, v in enumerate([*x, None, [None] + x[0][1:], x[0][:24], x[0] + [1.0], [], [float("nan")] + x[0][1:]])]
    df = spark.createDataFrame(rows, "id long, x array<double>").repartition(3)
    centers = [*x[:9], x[3]]
    got = CL.assign(df, "x", centers)
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
    d = VX.distances("x", centers)
    want = df.select("id", F.coalesce(VX.argmin(d), F.lit(-1)).alias("c"), F.array_min(d).alias("d")).collect()
    assert {r["id"]: (r["cluster"], repr(r["sq_distance"])) for r in got.collect()} == {r["id"]: (r["c"], repr(r["d"])) for r in want}


def test_label_rules_read_the_events_once(spark):
    rows = [(0, "error", "TCP", 10.0, 5, 3), (0, "error", "UDP", 30.0, 5, 3), (0, "info", "UDP", 20.0, 5, 3), (0, None, "UDP", 20.0, 5, 3),
            (1, "info", "TCP", 4000.0, 500000, 12), (1, "error", "TCP", None, 500000, 12), (None, "info", "TCP", 1.0, 1, 1)]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(c):
        seen.add(1)
        return c

    events = spark.createDataFrame(rows, "c int, severity string, protocol string, duration_ms double, bytes_transferred long, hour_of_day int")
    got = IN.cluster_label_rules(events.withColumn("cluster", counted("c")), 3).collect()
    assert {r["cluster"]: r["interpretation"] for r in got} == {
        0: "short duration, low data transfer, off-hours activity", 1: "long duration, high data transfer", 2: "Empty cluster"}
    assert seen.value <= len(rows) * 2  # once, and once more for the filter below the projection
    s = IN.cluster_summary(events.withColumnRenamed("c", "cluster")).orderBy("cluster_id").collect()
    assert [(r["cluster_id"], r["count"], r["dominant_severity"], r["dominant_protocol"]) for r in s] == [
        (0, 4, "error", "UDP"), (1, 2, "error", "TCP")]


def test_centres_of_equal_models_lie_side_by_side_and_ties_go_to_the_first():
    from tidal.operators import kmeans as KM
    runs = [(0, 2, 3), (6, 1, 2)]  # two models of three centres, one of two
    order = KM._side_by_side(runs)
    assert order.tolist() == [0, 3, 1, 4, 2, 5, 6, 7]
    near = np.array([[5.0, 1], [2, 2], [2, 9], [4, 1], [2, 1], [3, 1], [7, 7], [7, 8]])
    mark = np.empty(near.shape, bool)
    least = KM._nearest(near[order], runs, mark)
    assert least.tolist() == [[2, 1], [2, 1], [7, 7]]
    assert mark[np.argsort(order)].tolist() == [[False, True], [True, False], [False, False], [False, True], [True, False], [False, False],
                                                [True, True], [False, False]]


def test_curve_silhouettes_measure_all_points_against_all(spark):
    draw = np.random.default_rng(21)
    x = draw.normal(size=(90, 3)) + draw.integers(0, 3, 90)[:, None] * 2.0
    x[1] = x[0]
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(3)
    centers = [x[:3], x[10:14]]
    for (got, got_sq), c in zip(CE.curve_silhouettes(df, centers, sample=16), centers):
        lab = {i: int(np.square(v - c).sum(1).argmin()) for i, v in enumerate(x)}
        points = dict(enumerate(x))
        want = brute_silhouette(points, lab, lambda u, v: float(np.linalg.norm(u - v)))
        sq = brute_silhouette(points, lab, lambda u, v: float(np.square(u - v).sum()))
        assert got == pytest.approx(np.mean(list(want.values())), abs=1e-9)
        assert got_sq == pytest.approx(np.mean(list(sq.values())), abs=1e-9)


def test_mean_distances_measure_all_members_whatever_the_ids(spark):
    draw = np.random.default_rng(22)
    x, c = draw.normal(size=(70, 3)), draw.integers(0, 3, 70)
    c[0] = 3  # alone in its cluster
    rows = [(i % 60, v.tolist(), int(k), str(i)) for i, (v, k) in enumerate(zip(x, c))]
    odd = [(None, None, 1, "null"), (5, [1.0, None, 2.0], 0, "part")]
    df = spark.createDataFrame(rows + odd, "id long, x array<double>, cluster int, name string").repartition(3)
    got = {r["name"]: r for r in CE.mean_distances(df, "id", "x", "cluster", sample=16).collect()}
    assert len(got) == 72 and set(got["7"].asDict()) == {"id", "x", "cluster", "name", "md", "a", "b", "silhouette"}
    want = brute_silhouette(dict(enumerate(x)), dict(enumerate(c)), lambda u, v: float(np.linalg.norm(u - v)))
    for i in range(70):
        assert got[str(i)]["id"] == i % 60 and got[str(i)]["x"] == x[i].tolist()
        assert got[str(i)]["silhouette"] == pytest.approx(want[i], abs=1e-9)
        d = np.linalg.norm(x - x[i], axis=1)
        for m in got[str(i)]["md"]:
            others = (c == m["c"]) & (np.arange(70) != i)
            assert m["m"] is None if not others.any() else m["m"] == pytest.approx(d[others].mean(), abs=1e-9)
    assert got["0"]["a"] is None and got["0"]["silhouette"] == 0.0
    for name in ("null", "part"):
        assert [m["m"] for m in got[name]["md"]] == [None] * 4 and got[name]["a"] is None and got[name]["silhouette"] == 0.0
    assert CE.mean_distances(df.limit(0), "id", "x", "cluster").collect() == []
