"""Edge cases and brute-force comparisons of the training-data operators."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from tidal.llm import cross_parsing as CP
from tidal.llm import decontaminate as DC
from tidal.llm import line_frequency as LF
from tidal.llm import mixing as MX
from tidal.llm import page_difference as PG
from tidal.llm import personal_data as PD
from tidal.llm import quality_knn as QK
from tidal.llm import shingle_join as SJ
from tidal.llm import token_planes as TP
from tidal.llm import toxicity as TX


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 0), (3, 0), (7, 0), (10, 1)], "doc_id long, toxic int")
    out = TX.score_toxicity(docs, TX.learn(docs, labels, F.lit(True))).collect()
    assert len(out) == 11 and all(0 <= r["score"] <= 1 for r in out) and out[0]["spans"] == "x"
    by = {r["doc_id"]: r["score"] for r in out}
    assert by[10] > max(by[1], by[7], by[4])
    none = TX.learn(docs.limit(0), labels, F.lit(True))
    assert TX.score_toxicity(docs, none).where("doc_id = 10").first()["score"] > TX.Model.score(none, "")


def test_label_model_learns_accuracies_and_correlations():
    pats = [((1, 1, 1), 90), ((-1, -1, 1), 10), ((0, 0, 0), 400), ((0, 0, 1), 5), ((1, 1, 0), 5)]
    m = TX.LabelModel(pats, np.array([1, .6, 0, .2, .6]))
    post = m.posterior(np.array([p for p, _ in pats]))
    assert post[0] > .95 and post[2] < .05 and m.correlations[0, 1] > .5


def test_decontamination_against_brute_force(spark, docs):
    items = [(0, " ".join(prose(1, 60).split()[10:30])), (1, "short text"), (2, None), (3, ""), (3, "idiot, you STUPID")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).add(str(i))
    for r in DC.decontaminate(docs, bench).collect():
        w, hit, found = words(docs.where(F.col("doc_id").eqNullSafe(r["doc_id"])).first()["text"]), set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found |= ids
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == (len(w), len(hit), sorted(found))
        assert len(words(r["clean_text"])) == len(w) - len(hit)
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert DC.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert DC.cleaned(docs, bench).columns == docs.columns


def test_personal_data(spark, docs):
    more = spark.createDataFrame([(20, 'key token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" at 10.0.0.256 and 1.2.3.4'),
                                  (21, "4111 1111 1111 1111, 4111111111111112, " + "9" * 5000 + " a@b@c.d.e")], "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in PD.find(docs.select("doc_id", "text").union(more)).collect()}
    assert got[8] == [("email", 5, 24), ("phone", 28, 45)] and got[4] == [] and got[5] == []
    assert [s for s in got[20] if s[0] == "ip"] == [("ip", 73, 80)] and ("secret", 13, 53) in got[20]
    assert ("card", 0, 19) in got[21] and ("email", got[21][-1][1], got[21][-1][2]) == got[21][-1]
    assert PD.find(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [False, True])
def test_token_planes_round_trip(spark, docs, bits):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, at, want = Tokenizer.from_file(path), 0, []
    texts = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    for i, t in texts:
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = TP.token_planes(docs, path, bits=bits, block=256)
    assert rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert TP.token_planes(docs.limit(0), path).count() == 0


def test_word_cache_equals_the_tokenizer():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer
    tok, rnd = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(3)
    cache = TP.WordCache(tok)
    for _ in range(3000):
        t = "".join(rnd.choice(" \n\t 'sdtThé½_-.,!#9日\x1c ") for _ in range(rnd.randint(0, 25)))
        assert cache.ids(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_mixing(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 17)), [None, "a", "b", "c"][k % 4 if k % 3 else 1]) for k in range(600)] + [(900, None, "d")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m = MX.mix(d)
    sums = m.groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("k"),
                                   F.first("source_size").alias("s")).collect()
    assert all(abs(r["t"] - r["k"]) <= 20 and r["t"] <= 2 * r["s"] for r in sums)
    assert abs(sum(r["t"] for r in sums) - 1.5 * sum(r["s"] for r in sums)) < 1e-6
    assert m.where("copies > 2").count() == 0 and rows_of(m, "doc_id", "copies") == rows_of(MX.mix(d), "doc_id", "copies")
    assert MX.mix(d.limit(0)).count() == 0


def test_line_frequency(spark, docs):
    page = [(k, f"Subscribe to our letter {k}\n" + prose(k, 30), None) for k in range(30)] + [(99, "Subscribe to our letter 7\nsome words", None)]
    d = spark.createDataFrame(page, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in LF.filter_quality(d, min_docs=5).collect()}
    assert got[3]["boilerplate_words"] == 5 and got[3]["kept"] and not got[99]["kept"]
    out = {r["doc_id"]: r for r in LF.filter_quality(docs).collect()}
    assert out[4]["n_words"] == 0 and out[4]["base_failed"] and out[7]["n_words"] == 9000


def test_boilerplate_of_small_and_of_hot_hosts(spark):
    small = [(k, "Subscribe to our letter\n" + prose(k, 30), "small") for k in range(60)]
    hot = [(k, ("All rights reserved here\n" if k < 1002 else "") + f"own line number {'x' * (k % 7)}{'y' * (k // 7)}", "hot")
           for k in range(1000, 1000 + 2)] + [(k, "All rights reserved here", "hot") for k in range(2000, 3000)] + [
           (k, prose(k, 3), "hot") for k in range(3000, 24000)]
    d = spark.createDataFrame(small + hot, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["boilerplate_words"] for r in LF.filter_quality(d).where("doc_id < 3000").collect()}
    assert got[3] == 4 and got[1000] == 4 and got[2500] == 4


def test_text_without_boilerplate_lines(spark):
    rows = [(k, f"Subscribe to our letter {k}\n\n" + prose(k, 30) + "\n", None) for k in range(30)] + [(50, None, None), (51, "Subscribe to our letter 7", "x")]
    got = rows_of(LF.without_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")), "doc_id", "text")
    assert got == sorted([(k, "\n" + prose(k, 30) + "\n") for k in range(30)] + [(50, None), (51, "Subscribe to our letter 7")], key=repr)


def test_repeated_words_and_lines(spark):
    t = "a b c d e f g h i j\na b c d e f g h\n\na b c d e f g h"
    r = LF.measure(spark.createDataFrame([(1, t, "s")], "doc_id long, text string, source string")).first()
    assert (r["n_words"], r["n_repeat_words"], r["n_dup_lines"]) == (26, 24, 1)


def test_near_duplicates(spark, docs):
    got = rows_of(SJ.near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    by = {r[0]: r for r in got}
    assert len(got) == 11 and by[1][2] == by[2][2] == by[3][2] == 1 and by[4] == (4, 0, 4) and by[6] == (6, 1, 6)
    assert SJ.near_duplicates(docs.limit(0)).count() == 0
    kept = [r["doc_id"] for r in SJ.keep_first(docs).collect()]
    assert 1 in kept and 2 not in kept and 3 not in kept and None in kept


def test_one_row_of_a_group_stays(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a), (1, a), (2, a), (None, b), (None, b), (2, c), (None, c), (4, None), (4, None)]
    got = rows_of(SJ.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), "doc_id", "text")
    assert got == sorted([(1, a), (None, b), (2, c), (4, None), (4, None)], key=repr)


@pytest.mark.parametrize("hot", [1, 3])
def test_near_copy_of_a_large_copy_group_is_linked(spark, monkeypatch, hot):
    monkeypatch.setattr(SJ, "HOT", hot)
    rows = []
    for seed in range(8):  # one group of copies and one near copy each
        base = prose(seed, 60)
        rows += [(100 * seed + k, base) for k in range(30)] + [(100 * seed + 30, base.replace(base.split()[30], "changed"))]
    got = rows_of(SJ.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)), "doc_id", "component_id")
    assert got == sorted(((i, i // 100 * 100) for i, _ in rows), key=repr)


def test_dealing_counts_classes_not_copies(spark, monkeypatch):
    monkeypatch.setattr(SJ, "HOT", 5)
    base = prose(1, 60)
    texts = spark.createDataFrame([(base,)] * 40 + [(base + " " + w,) for w in "abc"], "text string").repartition(5)
    frequency = SJ.frequencies(texts)
    assert int(frequency.max()) > 5 and len(SJ.hot_shingles(texts, frequency)[0]) == 0
    monkeypatch.setattr(SJ, "HOT", 3)
    shingles, groups = SJ.hot_shingles(texts, frequency)
    assert len(shingles) and set(groups.tolist()) == {2}


def test_cross_parsing(spark, docs):
    train = [(k, prose(k, 80) if k % 2 else "el agua de la montaña y los ríos del valle " * 9 + str(k), ["es", "en"][k % 2]) for k in range(8)]
    d = spark.createDataFrame(train, "doc_id long, text string, lang string")
    parser = CP.learn(d, F.lit(True))
    out = {r["doc_id"]: r["lang_pred"] for r in CP.identify(docs, parser).collect()}
    assert out[4] == out[5] == "und" and out[1] == out[7] == "en"
    assert {r["lang_pred"] for r in CP.identify(docs, CP.learn(d.limit(0), F.lit(True))).collect()} == {"und"}
    assert parser.phrases(["agua de la montaña"])[0].tolist().index(min(parser.phrases(["agua de la montaña"])[0])) == parser.languages.index("es")


def test_page_difference(spark):
    page = lambda body: f"<html><nav>menu</nav><p>site motto<p>{body}</p><footer>f</footer>"
    rows = [(1, "http://h/a/1", page("one &amp; only")), (2, "http://h/a/2", page("two\n words")), (3, None, None),
            (4, "http://g/x", "<div class='ad'>buy</div><article><h1>T</h1><p>body a < b<div class=comments>no</div></article>rest"),
            (4, "http://g/x", "<div class='ad'>buy</div><article><h1>T</h1><p>body a < b<div class=comments>no</div></article>rest")]
    got = rows_of(PG.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id", "text")
    assert got == [(1, "one & only"), (2, "two words"), (3, ""), (4, "T\n\nbody a < b"), (4, "T\n\nbody a < b")]


def test_alignment_decides_beside_an_article(spark):
    page = lambda k, teaser: (f"<nav>menu</nav><main><p>read more on our site<p>{prose(k, 12)}</main>"  # noqa: E731
                              f"<div>{prose(k + 50, 20)}</div><article>{teaser}</article><div>all rights reserved</div>")
    rows = [(k, f"http://h/a/{k}", page(k, f"teaser {k}")) for k in (1, 2)]
    copy = "<p>site motto</p><article><p>{}<p>{}</article><div>by author {}</div>"
    rows += [(k, f"http://g/{k}", copy.format(prose(8, 20), prose(9, 20), k)) for k in (3, 4)]
    got = dict(rows_of(PG.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id", "text"))
    for k in (1, 2):
        assert got[k].split("\n\n") == [prose(k, 12), prose(k + 50, 20), f"teaser {k}"]
    for k in (3, 4):
        assert got[k].split("\n\n") == [prose(8, 20), prose(9, 20), f"by author {k}"]


def test_shared_lines_is_a_longest_common_subsequence():
    assert len(PG.shared_lines([1, 2, 3, 1, 4], [2, 1, 3, 4, 1])) == 3 and PG.shared_lines([], [1]) == set()


def test_quality(spark, docs):
    train = [(k, prose(k, 50) if k % 2 else " ".join(["JUNK!!"] * 50), k % 2, 0) for k in range(40)]
    d = spark.createDataFrame(train, "doc_id long, text string, quality int, toxic int")
    model = QK.learn(d.select("doc_id", "text"), d.select("doc_id", "quality"), F.lit(True))
    out = {r["doc_id"]: r["predicted"] for r in QK.score_quality(docs, model).collect()}
    assert out[1] == 1 and QK.score_quality(spark.createDataFrame([("JUNK!! " * 40,)], "text string"), model).first()["predicted"] == 0
    empty = QK.learn(d.limit(0), d.select("doc_id", "quality"), F.lit(True))
    assert QK.score_quality(docs, empty).first()["score"] == 0.5


def test_digest_columns_of_the_queries(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]


def test_only_few_texts_are_copied_out_of_a_batch_at_a_time(monkeypatch):
    import pyarrow as pa
    sizes, copied = [], TP.text_bytes
    monkeypatch.setattr(TP, "text_bytes", lambda b: sizes.append(b.num_rows) or copied(b))
    batch = pa.RecordBatch.from_arrays([pa.array(range(1700)), pa.array([f"t{i}" if i % 3 else None for i in range(1700)])], ["doc_id", "text"])
    assert list(TP.held_rows(batch)) == [(i, f"t{i}".encode() if i % 3 else b"") for i in range(1700)]
    assert max(sizes) <= 500
