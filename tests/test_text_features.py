"""Text cleaning, TF-IDF/LSA invariants, scalers and codes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidal.functions import text as TX
from tidal.operators import features as FE
from tidal.operators import text as X


def test_clean_text_rules(spark):
    df = spark.createDataFrame([("GET from 10.0.0.5: took 655ms, code 42!",), (None,), ("Été 2024 — ça",)],
                               "t string")
    got = [r[0] for r in df.select(TX.clean_text("t")).collect()]
    assert got[0] == "get from IP_ADDR took 655ms code NUM"
    assert got[1] == ""
    assert got[2] == "été NUM ça"


def test_tfidf_rows_are_unit_length_and_idf_smoothed(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha beta"), (3, "alpha delta"),
                                  (4, "beta gamma gamma")], "id long, text string")
    m = X.fit_tfidf(docs, "text", ngrams=False, max_df=1.0)
    w = m.transform(docs, "id", "text")
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n2")).collect()
    assert all(r["n2"] == pytest.approx(1.0) for r in norms)
    v = {r["term"]: r for r in m.vocabulary(spark).collect()}
    assert "delta" not in v  # df = 1 < min_df
    assert v["alpha"]["idf"] == pytest.approx(np.log(5 / 4) + 1)


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    m = X.fit_tfidf(docs, "text")
    return docs, m, X.fit_lsa(docs, "text", m, 5)


def dense(weights, size, ids):
    row = {i: k for k, i in enumerate(ids)}
    out = np.zeros((len(ids), size))
    for r in weights.collect():
        out[row[r["doc_id"]], r["term_index"]] = r["weight"]
    return out


def test_lsa_equals_the_decomposition_of_the_whole_matrix(spark, corpus):
    docs, m, lsa = corpus
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    x = dense(m.transform(docs, "doc_id", "text"), m.size, ids)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(lsa.singular_values, s[:5], rtol=1e-6)
    assert np.allclose(lsa.components @ lsa.components.T, np.eye(5), atol=1e-8)
    # the same subspace: the projection of one basis on the other keeps its length
    assert np.allclose(np.linalg.svd(lsa.components @ vt[:5].T)[1], 1.0, atol=1e-5)
    z = x @ lsa.components.T
    assert np.allclose(lsa.explained_variance, z.var(0), atol=1e-9)
    assert lsa.total_variance == pytest.approx(x.var(0).sum(), abs=1e-9)
    got = {r["doc_id"]: r["lsa"] for r in X.lsa_scores(docs, "text", m, lsa).collect()}
    assert np.allclose(np.array([got[i] for i in ids]), z, atol=1e-9)


def test_vectors_equal_the_long_weights(spark, corpus):
    docs, m, _ = corpus
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    x = dense(m.transform(docs, "doc_id", "text"), m.size, ids)
    got = {r["doc_id"]: r["tfidf"].toArray() for r in m.vectors(docs, "text").select("doc_id", "tfidf").collect()}
    assert np.allclose(np.array([got[i] for i in ids]), x, atol=1e-12)


def test_repeated_and_null_ids_keep_their_own_text(spark, corpus):
    docs, m, lsa = corpus
    text = docs.first()["text"]
    odd = spark.createDataFrame([(1, text), (1, "nothing known"), (None, text), (2, None)], "doc_id long, text string")
    rows = X.lsa_scores(odd, "text", m, lsa).collect()
    assert len(rows) == 4 and rows[0]["lsa"] == rows[2]["lsa"] and any(rows[0]["lsa"])
    assert rows[3]["lsa"] == [0.0] * 5


def test_similar_terms_and_topics_by_brute_force(spark, corpus):
    docs, m, lsa = corpus
    term, load = m.terms[3][0], lsa.components.T
    cos = [(t[0], float(load[t[3]] @ load[3] / np.linalg.norm(load[t[3]]) / np.linalg.norm(load[3]))) for t in m.terms if t[3] != 3]
    want = sorted(cos, key=lambda x: (-x[1], x[0]))[:4]
    asked = spark.createDataFrame([(term,), ("no such term",), (None,)], "term string")
    got = X.term_similarity(spark, m, lsa, asked, n=4).orderBy("rank").collect()
    assert [(r["similar_term"], round(r["cosine"], 9)) for r in got] == [(t, round(c, 9)) for t, c in want]
    assert X.similar_terms(m, lsa, "no such term") == []
    scored = X.lsa_scores(docs, "text", m, lsa).limit(5).collect()
    frame = spark.createDataFrame(scored, "doc_id long, text string, lsa array<double>")
    top = X.document_topics(frame, ["doc_id"], n=2).collect()
    for r in scored:
        order = sorted(range(5), key=lambda c: (-abs(r["lsa"][c]), c))[:2]
        assert [(t["component"], t["score"]) for t in top if t["doc_id"] == r["doc_id"]] == [(c, r["lsa"][c]) for c in order]


def test_empty_corpus_has_no_components(spark):
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    m = X.fit_tfidf(none, "text")
    lsa = X.fit_lsa(none, "text", m)
    assert m.size == 0 and lsa.k == 0 and X.lsa_scores(none, "text", m, lsa).count() == 2


def test_scaler_uses_population_std_and_guards_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    sc = FE.fit_standard_scaler(df, ["a", "b"])
    assert sc.scale == [1.0, 1.0]  # std_pop([1,3]) = 1; constant column scales by 1
    out = [r["a_scaled"] for r in sc.transform(df).collect()]
    assert out == [-1.0, 1.0]


def test_unseen_category_gets_zero(spark):
    train = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "c string")
    codes = FE.fit_label_codes(train, ["c"])
    assert {r["value"]: r["code"] for r in codes.collect()} == {"a": 0, "b": 1}
    new = spark.createDataFrame([("b",), ("zzz",)], "c string")
    got = {r["c"]: r["c_code"] for r in FE.encode_unseen_zero(new, codes, "c").collect()}
    assert got == {"b": 1, "zzz": 0}
    assert {r["c"]: r["c_code"] for r in FE.apply_codes(new, codes, ["c"]).collect()} == {"b": 1, "zzz": 2}


def test_codes_over_several_ranges_follow_the_order_of_values(spark):
    rows = [(f"v{(i * 7919) % 5000:05d}", f"w{i % 3}") for i in range(20000)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        codes = FE.fit_label_codes(df, ["a", "b"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for c, k in (("a", 0), ("b", 1)):
        values = sorted({r[k] for r in rows})
        assert {r["value"]: r["code"] for r in codes if r["feature"] == c} == {v: i for i, v in enumerate(values)}


def test_lsa_of_many_terms_takes_few_passes(spark):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    df = spark.createDataFrame([(i, " ".join(rng.choice(words, 40))) for i in range(400)], "id long, text string")
    tfidf = X.fit_tfidf(df, "text", ngrams=False)
    assert tfidf.size > 250
    sc = spark.sparkContext
    sc.setJobGroup("lsa-passes", "lsa")
    try:
        lsa = X.fit_lsa(df, "text", tfidf, 5)
        jobs = sc.statusTracker().getJobIdsForGroup("lsa-passes")
    finally:
        sc.setJobGroup("other", "other")
    assert len(jobs) <= 10  # an iterative decomposition runs one for every iteration
    a = np.zeros((400, tfidf.size))
    for r in tfidf.transform(df, "id", "text").collect():
        a[r["doc_id"], r["term_index"]] = r["weight"]
    s = np.linalg.svd(a, compute_uv=False)[:5]
    assert np.allclose(lsa.singular_values, s)
    assert np.allclose(lsa.explained_variance, (a @ lsa.components.T).var(0))
    assert np.isclose(lsa.total_variance, a.var(0).sum())


def test_weights_and_statistics_of_bigrams_by_hand(spark):
    df = spark.createDataFrame([(1, "red fox red fox"), (2, "red fox blue"), (3, None), (4, "blue owl")], "id long, text string")
    stats = {r["term"]: (r["df"], r["total_tf"]) for r in X.term_statistics(df, "text").collect()}
    assert stats == {"red": (2, 3), "fox": (2, 3), "blue": (2, 2), "owl": (1, 1), "red fox": (2, 3), "fox red": (1, 1),
                     "fox blue": (1, 1), "blue owl": (1, 1)}
    model = X.fit_tfidf(df, "text")
    got = {(r["doc_id"], r["term"]): r["tf"] for r in model.transform(df, "id", "text").collect()}
    assert got == {(1, "red"): 2, (1, "fox"): 2, (1, "red fox"): 2, (2, "red"): 1, (2, "fox"): 1, (2, "blue"): 1,
                   (2, "red fox"): 1, (4, "blue"): 1}


def test_counted_terms_equal_brute_force_however_the_texts_are_cut(monkeypatch):
    import random
    from collections import Counter

    import pyarrow as pa
    draw = random.Random(1)
    for rows, piece, ngrams in ((1, 1, True), (3, 8, True), (500, 1 << 21, True), (500, 1 << 21, False)):
        monkeypatch.setattr(X, "ROWS", rows)
        monkeypatch.setattr(X, "PIECE", piece)
        texts = [draw.choice(["", None, "a", " ".join(draw.choices(["\u00e4", "bb", "c", "dd", "e"], k=draw.randint(1, 9)))])
                 for _ in range(60)]
        docs, occurrences = Counter(), Counter()
        for t in texts:
            words = X.split_words(t)
            terms = words + list(map(" ".join, zip(words, words[1:]))) if ngrams else words
            docs.update(set(terms))
            occurrences.update(terms)
        ids: dict = {}
        cut = list(X._pieces(pa.array(texts, pa.string())))
        assert sum(map(len, cut)) == len(texts) and max(map(len, cut)) <= rows
        parts = [X._terms_of(p, ids, ngrams) for p in cut]
        keys, df, tf = X._counted(*(np.concatenate([p[c] for p in parts]) for c in range(3)))
        names = list(ids)
        terms = [names[k] if k < 1 << 32 else f"{names[(k >> 32) - 1]} {names[k & 0xFFFFFFFF]}" for k in keys.tolist()]
        assert dict(zip(terms, df.tolist())) == docs and dict(zip(terms, tf.tolist())) == occurrences


def test_texts_are_cleaned_counted_and_weighed_in_arrow_as_the_tokens_say(spark, monkeypatch):
    import random
    from collections import Counter
    draw = random.Random(2)
    some = ["The", "fox", "10.0.0.1", "x1.2.3.4y", "12", "007", "a", "\u00e9t\u00e9", "\u0391\u03a3", "\u0130st", "don't", "_x", "\u00bd",
            "42!", "\u65e5\u672c \u8a9e", "\u0663\u0664", "\n", "1.2.3.4.5", "ok ok", "red", "red fox"]
    rows = [(i if i % 7 else None, draw.choice([None, "", " ".join(draw.choices(some, k=draw.randint(1, 30)))])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(2)
    for kw in ({}, {"min_len": 1, "ip_token": "ip_address", "num_token": "num"}, {"ngrams": False, "num_token": "N-2 x"}):
        plain = {k: v for k, v in kw.items() if k != "ngrams"}
        tokens = [r["w"] for r in X.with_tokens(df, "text", "w", **plain).collect()]
        terms = [w + (list(map(" ".join, zip(w, w[1:]))) if kw.get("ngrams", True) else []) for w in tokens]
        docs, occurrences = Counter(t for w in terms for t in set(w)), Counter(t for w in terms for t in w)
        with monkeypatch.context() as m:
            m.delattr(X, "with_tokens")
            stats = {r["term"]: (r["df"], r["total_tf"]) for r in X.term_statistics(df, "text", **kw).collect()}
            assert stats == {t: (docs[t], n) for t, n in occurrences.items()}
            model = X.fit_tfidf(df, "text", **kw)
            weights = Counter((r["doc_id"], r["term"], r["tf"], round(r["weight"], 9)) for r in model.transform(df, "id", "text").collect())
            top = Counter((r["doc_id"], r["rank"], r["term"], round(r["weight"], 9)) for r in X.rank_terms(df, "id", "text", model, 3).collect())
            lsa = X.LsaModel(np.random.default_rng(1).normal(size=(4, model.size)), None, None, 1.0, 200)
            scores = [r["s"] for r in X.lsa_scores(df, "text", model, lsa, "s").collect()]
        idf, place = {t[0]: t[4] for t in model.terms}, {t[0]: t[3] for t in model.terms}
        want, first = Counter(), Counter()
        for (i, _), words, got in zip(rows, terms, scores):
            tf = Counter(t for t in words if t in idf)
            norm = np.sqrt(sum((n * idf[t]) ** 2 for t, n in tf.items()))
            w = {t: n * idf[t] / norm for t, n in tf.items()}
            want.update((i, t, n, round(w[t], 9)) for t, n in tf.items())
            first.update((i, k + 1, t, round(w[t], 9)) for k, t in enumerate(sorted(w, key=lambda t: (-round(w[t], 12), t))[:3]))
            assert np.allclose(got, sum((w[t] * lsa.components[:, place[t]] for t in w), np.zeros(4)))
        assert weights == want and top == first


def test_lsa_takes_components_and_variances_from_the_products_of_the_terms(spark, monkeypatch):
    from pyspark.mllib.linalg.distributed import RowMatrix
    monkeypatch.delattr(RowMatrix, "computeSVD")
    monkeypatch.delattr(RowMatrix, "multiply")
    words = ["red", "fox", "blue", "owl", "grey", "cat"]
    draw = np.random.default_rng(4)
    df = spark.createDataFrame([(i, " ".join(draw.choice(words, draw.integers(0, 9)))) for i in range(60)], "id long, text string")
    m = X.fit_tfidf(df, "text")
    dense = np.zeros((60, m.size))
    for r in m.transform(df, "id", "text").collect():
        dense[r["doc_id"], r["term_index"]] = r["weight"]
    lsa = X.fit_lsa(df, "text", m, 5)
    assert np.allclose(lsa.singular_values, np.linalg.svd(dense, compute_uv=False)[:5])
    assert np.allclose(lsa.explained_variance, (dense @ lsa.components.T).var(0))
    assert lsa.total_variance == pytest.approx(dense.var(0).sum())


def test_among_equal_loadings_the_first_is_positive(spark):
    texts = ["blue red", "red blue", "blue", "red", "blue", "red"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    lsa = X.fit_lsa(df, "text", X.fit_tfidf(df, "text", ngrams=False), 2)
    assert np.allclose(lsa.components, np.array([[1, 1], [1, -1]]) / np.sqrt(2))


def test_lsa_reads_weights_from_arrow_batches(spark):
    texts = ["red fox runs", "", None, "red fox red fox 10.0.0.1", "blue fox sleeps 42", "zzz"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    model = X.fit_tfidf(df, "t", max_features=50)
    rows = model.weight_vectors(df, "t")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Scan" in plan
    key = lambda v: (v.indices.tolist(), np.round(v.values, 12).tolist())
    want = sorted(key(r[0]) for r in model.vectors(df, "t").select("tfidf").collect())
    got = [r[0] for r in rows.collect()]
    assert sorted(map(key, got)) == want and all(v.size == model.size for v in got)
    assert X.TfidfModel([], 18).weight_vectors(df, "t").count() == len(texts)
