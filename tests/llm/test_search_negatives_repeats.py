"""Ranked search, hard negatives and repeated passages against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from tidal.llm import difference_cover as DV
from tidal.llm import interval_search as IS
from tidal.llm import threshold_negatives as TN

# ---- ranked search ------------------------------------------------------------------


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // length
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    df = sum(t in d for _, d in counts)
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i, score))
        out += [(item, r, i, s) for r, (*_, i, s) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


ODD = [(1, "Amber Birch amber"), (2, None), (3, ""), (4, "--- ,,,"), (5, "amber birch AMBER"), (5, "amber birch AMBER"),
       (None, "amber birch amber"), (7, "Été café été" + " cedar" * 50), (8, "x_y a@b delta9"), (9, prose(3, 4000))]


@pytest.mark.parametrize("shard", [40, 1_000_000])
def test_search_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(IS, "SHARD", shard)
    docs = ODD + [(20 + i, prose(i % 9, 5 + i % 60)) for i in range(150)]
    items = [(1, prose(2, 12)), (2, "amber birch"), (2, "amber birch"), (3, None), (4, "!!"), (5, "nowhere"), (6, "ÉTÉ été cedar X y"), (7, prose(4, 200))]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string").repartition(3)
    b = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, rank int")
    for k in (3, 10):
        got = [tuple(r) for r in IS.search(d, b, k).select("item_id", "rank", "doc_id", "score").collect()]
        assert sorted(got, key=repr) == brute_search(docs, items, k)


def test_search_over_slices_of_items_and_empty_tables(spark, monkeypatch):
    docs = [(i, prose(i % 5, 20)) for i in range(30)]
    items = [(i, prose(i, 10)) for i in range(8)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(IS, "ITEM_BYTES", 100)
    monkeypatch.setattr(IS, "TEXT_PIECE", 20)
    got = [tuple(r) for r in IS.search(d, b, 4).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=repr) == brute_search(docs, items, 4)
    assert IS.search(d, b.limit(0)).count() == 0 and IS.search(d.limit(0), b).count() == 0


# ---- hard negatives ------------------------------------------------------------------


def brute_negatives(rows, anchors, n_pos=5, n_neg=10):
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
            if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, label, v in rows:
        if a not in anchors:
            continue
        scored = sorted((-dot(v, w), i, lab) for i, lab, w in rows if i != a)
        for p, pid, _ in [s for s in scored if s[2] == label][:n_pos]:
            inside = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:n_neg]
            out += [(a, pid, r, nid, -p, -s) for r, (s, nid, _) in enumerate(inside, 1)]
    return sorted(out)


def vectors(n, dim, seed=0, scale=0.3):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, scale, (6, dim))
    return [(i, int(i * 7 % 5), [float(np.float32(x)) for x in base[i % 6] * (i % 3) + rng.normal(0, scale / 2, dim)]) for i in range(n)]


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(df, every=10):
    out = TN.hard_negatives(df, F.col("vec_id") % every == 0, F.col("label"))
    return sorted(tuple(r) for r in out.select(*COLUMNS).collect())


@pytest.mark.parametrize("dim, block", [(1, 300), (7, 300), (64, 4)])
def test_negatives_against_brute_force(spark, monkeypatch, dim, block):
    monkeypatch.setattr(TN, "BLOCK_BYTES", 8 * dim * 256 if block == 4 else TN.BLOCK_BYTES)
    rows = vectors(400, dim)
    rows += [(1000 + i, i % 5, rows[3][2]) for i in range(60)]            # ties
    rows += [(2000, 9, [0.0] * dim), (2010, 9, [-x for x in rows[5][2]]), (2001, 3, [1e3] * dim)]
    odd = [(3000, None, rows[0][2]), (3010, 1, None), (None, 1, rows[0][2]), (3020, 1, [float("nan")] * dim), (3030, 1, [float("inf")] * dim),
           (3040, 1, [None] * dim), (3050, 2, [])]
    df = spark.createDataFrame([(*r, 1.5) for r in rows + odd], "vec_id long, label int, embedding array<float>, score double").repartition(3)
    assert mined(df) == brute_negatives(rows + [odd[-1]], {i for i, *_ in rows + [(3050, 0, 0)] if i % 10 == 0})


def test_negatives_of_one_label_slices_and_empty_tables(spark, monkeypatch):
    rows = vectors(120, 8, 3)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    whole = mined(df)
    monkeypatch.setattr(TN, "ANCHOR_BYTES", 100)
    assert mined(df) == whole == brute_negatives(rows, set(range(0, 120, 10)))
    assert mined(df.withColumn("label", F.lit(1))) == [] and mined(df.limit(0)) == []


def test_index_leaves_out_covered_dimensions_and_loses_no_pair():
    rng = np.random.default_rng(1)
    y = (rng.normal(size=(500, 32)) * np.linspace(60, 1, 32)).astype(np.int64)
    x = TN.Anchors(np.arange(20), np.zeros(20, int), y[:20])
    block = TN.Block(np.arange(500), np.zeros(500, int), np.ascontiguousarray(y[:, x.order]), x.edges)
    for least in (-1e9, 0.0, 500.0, 4000.0, 1e9):
        a, r, s = block.pairs(x.x, x.norms, np.full(20, least))
        exact = y[:20] @ y.T
        assert sorted(zip(a, r)) == sorted(zip(*np.nonzero(exact >= least))) and (s == exact[a, r]).all()
    need = 4000.0 / x.norms
    assert (block.norms[:, -2] < need[:, -2].min()).all()  # the last dimensions are not indexed at this threshold


# ---- repeated passages -----------------------------------------------------------------


def brute_repeats(texts, width):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + width] for b in raw for i in range(len(b) - width + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeats(df, **kw):
    out = DV.remove_repeated(df, **kw).collect()
    return {r["k"]: (r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], r["kept_sha256"]) for r in out}, out


PASSAGE, OTHER = prose(11, 90), prose(12, 120)
TEXTS = [prose(1, 200), None, "", "short", PASSAGE + prose(2, 40), prose(3, 40) + PASSAGE, OTHER, OTHER, OTHER, "aé" * 700,
         PASSAGE[:399], PASSAGE[:400], prose(4, 30) + "!" + PASSAGE[50:480] + "?", "é" + PASSAGE[1:450], OTHER + PASSAGE + OTHER]


@pytest.mark.parametrize("chunk, piece, bucket", [(2_000_000, 4_000_000, 500_000), (3_000, 500, 200)])
def test_repeats_against_brute_force(spark, monkeypatch, chunk, piece, bucket):
    for name, v in (("CHUNK", chunk), ("PIECE", piece), ("BUCKET", bucket), ("SEEN", 3)):
        monkeypatch.setattr(DV, name, v)
    df = spark.createDataFrame([(k, t, "x", 7) for k, t in enumerate(TEXTS)], "k int, text string, spans string, n_removed int").repartition(3)
    got, rows = repeats(df)
    want = brute_repeats(TEXTS, 400)
    assert len(rows) == len(TEXTS)
    for k, w in enumerate(want):
        assert got[k][:2] == w[:2] and got[k][2] == w[2] and got[k][3] == w[3], k


def test_repeats_inside_one_text_and_edges_of_the_width(spark):
    texts = ["ab" * 199, "ab" * 200, "ab" * 201, "z" * 401, prose(5, 60) * 2]
    got, _ = repeats(spark.createDataFrame(list(enumerate(texts)), "k int, text string"))
    assert [got[k] for k in range(5)] == brute_repeats(texts, 400)
    got, _ = repeats(spark.createDataFrame([(0, "z" * 401), (1, "y" * 400)], "k int, text string"))
    assert got[0][1] == 401 and got[1][1] == 0
    assert DV.remove_repeated(spark.createDataFrame([], "k int, text string")).count() == 0


def test_repeats_in_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(DV, "BUCKET", 2_000)
    near = [prose(6, 100) + f" {i} " + prose(7, 90) for i in range(60)]
    texts = near + [prose(8, 150)] * 80 + [prose(8, 150)[:900] + "tail"] + [prose(9, 80) + str(i) * 30 for i in range(20)]
    got, rows = repeats(spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(7))
    assert len(rows) == len(texts) and [got[k] for k in range(len(texts))] == brute_repeats(texts, 400)


def test_other_widths(spark):
    texts = [t for t in TEXTS if t]
    got, _ = repeats(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), width=60, covers=(5,))
    assert [got[k] for k in range(len(texts))] == brute_repeats(texts, 60)


def test_difference_covers_cover_all_differences():
    for q in (2, 3, 5, 11, 17):
        v, places = DV.cover(q)
        assert len(places) == q + 1 and {(a - b) % v for a in places for b in places} == set(range(v))
    assert DV.lengths(400) == [94, 268, 400]
