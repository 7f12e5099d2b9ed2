"""No cap decides a result: brute force and cases that once were lost."""

import hashlib
import re
import string
from collections import Counter

import numpy as np
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from tidal.llm import components as CO
from tidal.llm import cross_parsing as CP
from tidal.llm import decontaminate as DC
from tidal.llm import line_frequency as LF
from tidal.llm import mixing as MX
from tidal.llm import page_difference as PG
from tidal.llm import personal_data as PD
from tidal.llm import quality_knn as QK
from tidal.llm import shingle_join as SJ

# ---- near duplicates -----------------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def edited(text, *places):
    w = text.split()
    for p in places:
        w[p] = f"edit{p}x{len(places)}"
    return " ".join(w)


@pytest.mark.parametrize("small, centers, block", [(32, 4, 1_000_000), (8, 2, 200)])
def test_components_equal_brute_force(spark, monkeypatch, small, centers, block):
    for name, v in (("SMALL", small), ("CENTERS", centers), ("BLOCK", block), ("HOT", 6), ("LOCAL", small + 20)):
        monkeypatch.setattr(SJ, name, v)
    base, common = prose(1, 50), prose(2, 40)
    texts = [base] * 40 + [edited(base, p) for p in range(5, 45)]            # one copy group, near copies not linked with each other
    texts += [edited(prose(3, 50), p) for p in range(3, 47)]                 # near copies without their original
    texts += [edited(prose(4, 60), p, p + 15) for p in range(2, 40, 3)]      # chains and strangers
    texts += [prose(20 + k, 25) + " " + common for k in range(25)]           # a passage in many texts
    texts += ["", None, "one", "one", "two words", prose(5, 2000), prose(5, 2000) + " more"]
    rows = [((i * 37) % 1000, t) for i, t in enumerate(texts)]
    got = SJ.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == brute_components(rows)


def test_rows_of_a_round_are_linear_in_the_group(spark):
    members = spark.createDataFrame([(1, k, 100, 10, k, 500) for k in range(500)], "h long, class long, n int, pos int, root long, members long")
    pairs, rest = SJ.group_pairs(members, 32)
    assert pairs.count() <= SJ.CENTERS * 500 and rest.count() == 500 - SJ.CENTERS
    few, none = SJ.group_pairs(members.where("class < 20").withColumn("members", F.lit(20).cast("long")), 32)
    assert few.count() == 190 and none.count() == 0


def test_stages_keep_columns_with_their_own_names(spark):
    names = ["row", "place", "salt", "_of", "_same", "n", "copies", "key", "gap", "class"]
    rows = [(i, t, src, *[v] * len(names)) for i, t, src, v in
            [(1, prose(1, 40), "a", 77), (2, prose(1, 40), "a", 78), (3, prose(2, 40), "b", 79)]]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    for stage, want in ((SJ.keep_first, {77, 79}), (MX.repeated, {77, 78, 79}), (LF.without_boilerplate, {77, 78, 79})):
        out = stage(d)
        assert out.columns == d.columns
        got = out.collect()
        assert all(len(set(r[3:])) == 1 and r[3] in want for r in got) and (stage is MX.repeated or {r[3] for r in got} == want)


def test_components_of_odd_links_and_without_an_end(spark, monkeypatch):
    links = spark.createDataFrame([(1, 2), (1, 2), (2, 2), (3, None), (9, 8), (8, 2), (20, 21)], "a long, b long")
    assert sorted(tuple(r) for r in CO.components(links).collect()) == [(2, 1), (8, 1), (9, 1), (21, 20)]
    assert CO.components(links.limit(0)).count() == 0
    monkeypatch.setattr(CO, "ROUNDS", 1)
    monkeypatch.setattr(CO, "OPEN_NODES", 1)
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long").repartition(8)
    with pytest.raises(RuntimeError):
        CO.components(chain)


# ---- mixing --------------------------------------------------------------------------


def taken(docs):
    m = MX.mix(docs)
    rows = m.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select("doc_id", "source", "size", "target", (F.col("size") * MX.copies_of(F.col("row"))).alias("taken")).collect()


def test_equal_rows_share_their_copies(spark):
    rows = [(7, prose(1, 10), "a")] * 300 + [(100 + k, prose(k, 10 + k % 20), "b") for k in range(150)]
    got = taken(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert len(got) == 450 and all(r["taken"] <= 2 * r["size"] and r["taken"] % r["size"] == 0 for r in got)
    for s in "ab":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)


def test_targets_are_met_and_reruns_agree(spark):
    rng = np.random.default_rng(2)
    rows = [(i, prose(i, int(n)), ["hot", "hot", "x", "y", None][i % 5]) for i, n in enumerate(rng.integers(0, 400, 600))]
    rows += [(None, prose(3, 15), "x"), (None, prose(4, 15), "x"), (5000, None, "y"), (5001, prose(1, 20_000), "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, again = taken(df.repartition(3)), taken(df.repartition(7))
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(0.01 * own[0]["target"], 400)
    copies = Counter(r["text"] for r in MX.repeated(df).collect())
    want = Counter()
    by_key = {}
    for r in got:
        by_key.setdefault((r["doc_id"], r["source"], r["size"]), []).append(r["taken"] // r["size"] if r["size"] else 0)
    for i, t, s in rows:
        n = len((t or "").split())
        want[t] += sum(by_key[i, s, n]) if i is not None else 0
    assert {t: c for t, c in copies.items() if t not in (prose(3, 15), prose(4, 15))} == {t: c for t, c in want.items() if c}


# ---- language, quality, personal data, benchmark --------------------------------------


def test_a_large_alphabet_is_told_apart(spark):
    rng = np.random.default_rng(0)
    signs = [chr(0x4E00 + k) for k in range(3000)]
    orders = {}
    for lang in ("ja", "zh"):
        orders[lang] = ["".join(rng.choice(signs, 3)) for _ in range(900)]
    text = lambda lang, n: "".join(rng.choice(orders[lang], n))
    train = [(k, text(lang, 600), lang) for k in range(20) for lang in ("ja", "zh")]
    parser = CP.learn(spark.createDataFrame([(i, t, lang) for i, (_, t, lang) in enumerate(train)], "doc_id long, text string, lang string"), F.lit(True))
    assert parser.symbols > 2000 > parser.width
    tests = [(k, text(lang, 60), lang) for k in range(15) for lang in ("ja", "zh")]
    got = CP.identify(spark.createDataFrame(tests, "doc_id long, text string, truth string"), parser).collect()
    assert all(r["lang_pred"] == r["truth"] for r in got)


def brute_phrases(sample, text):
    """Longest matches from left to right; a symbol that the sample lacks
    belongs to the phrase that follows it."""
    n = i = 0
    while i < len(text):
        n += 1
        i += text[i] not in sample
        k = i
        while k < len(text) and text[i:k + 1] in sample:
            k += 1
        i = k
    return n


def test_phrases_equal_a_greedy_parse(spark, monkeypatch):
    monkeypatch.setattr(CP, "DENSE", 4)
    samples = {"a": "the cat sat on the mat and the rat", "b": "αβγ δεζ the αβγδ εζη θικ"}
    parser = CP.CrossParser(samples)
    for t in ["the cat", "αβγδεζ", "zebra the mat", "θικ the rat sat", "q", "on the αβγ mat"]:
        assert parser.phrases([t])[0].tolist() == [brute_phrases(samples[k], t) for k in parser.languages]


def test_neighbours_of_equal_cosine_go_by_id():
    rows = [(k % 2, ["t"], [1]) for k in range(3000)]
    model = QK.Model(rows)
    model.labels = np.array([1.0] * QK.NEIGHBOURS + [0.0] * (3000 - QK.NEIGHBOURS))
    assert model.score(np.ones((2, 1), np.float32)).tolist() == [1.0, 1.0]
    model.labels = 1 - model.labels
    assert model.score(np.ones((2, 1), np.float32)).tolist() == [0.0, 0.0]


def brute_base(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", lambda s: all(int(p) <= 255 for p in s.split("."))),
             ("card", r"[0-9](?:[\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15)]
    return sorted((m.start(), k, rules[k][0], m.end()) for k in range(4) for m in re.finditer(rules[k][1], text) if rules[k][2](m[0]))


def test_base_spans_equal_brute_force_and_many_matches_stay_cheap(spark):
    rng = np.random.default_rng(4)
    parts = ["jo@mail.example.com", "10.0.0.256", "1.2.3.4", "4111 1111 1111 1111", "4111111111111112", "+49 (170) 555-7713", "+1 2", "é",
             "x@y", "a@b.c.d", "12-34", "999.1.1.1.1", "\n", "word", "@", "+12345678901234567"]
    texts = [" ".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(120)] + ["", None]
    texts += ["".join(rng.choice(list(string.digits + " .-+()@ab"), 60)) for _ in range(200)]
    many = " ".join(f"u{k}@host{k}.example.org" for k in range(16_000))
    df = spark.createDataFrame(list(enumerate([*texts, many])), "doc_id long, text string")
    for r in PD.find(df).collect():
        t = ([*texts, many][r["doc_id"]]) or ""
        got = [(s["start"], s["order"], s["kind"], s["end"]) for s in r["spans"] if s["order"] < len(PD.BASE)]
        assert got == brute_base(t), r["doc_id"]


def test_a_benchmark_above_the_bound_is_cut_into_slices(spark, docs, monkeypatch):
    items = [(k, " ".join(prose(1, 60).split()[k:k + 16])) for k in range(0, 40, 3)] + [(None, "idiot, you STUPID"), (50, "short text"), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "item_ids", "contaminated", "clean_text")
    whole = sorted((tuple(r) for r in DC.decontaminate(docs, bench).select(*columns).collect()), key=repr)
    assert sum(r[3] for r in whole) > 20 and any(r[3] == 1 and r[4] == [] for r in whole)  # the item without id
    monkeypatch.setattr(DC, "SLICE_BYTES", 200)
    assert DC.slices_of(bench)[1] > 3
    assert sorted((tuple(r) for r in DC.decontaminate(docs, bench).select(*columns).collect()), key=repr) == whole


# ---- quality rules and pages ---------------------------------------------------------


def brute_quality(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit),
            len(words) < 20 or 100 * len(hit) > 30 * len(words))


def test_quality_counts_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    bits = ["a", "b", "été", "#", "<x>", "\n", "\n\n", " \t", "line of words here", "$5", "one two three four five six seven eight nine"]
    texts = [" ".join(rng.choice(bits, rng.integers(0, 60))) for _ in range(150)] + ["", None, "\n", prose(1, 5000)]
    df = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in LF.filter_quality(df).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_quality(texts[r["doc_id"]])
    assert LF.filter_quality(df.limit(0)).count() == 0


def test_article_lines_that_a_neighbour_also_holds_stay(spark):
    body = lambda k: f"<p>{prose(k, 14)}<p>a sentence that two pages quote<p>{prose(k + 40, 14)}" if k < 2 else f"<p>{prose(k, 14)}<p>{prose(k + 40, 14)}"
    page = lambda k: f"<p>motto</p><article><p>share this page{body(k)}</article><div>all rights reserved</div>"
    rows = [(k, f"http://h/a/{k}", page(k), 1) for k in range(9)] + [(20, None, "", 1), (21, "http://z/", "<article>" + prose(1, 30_000) + "</article>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(3)
    got = {r["page_id"]: r["text"] for r in PG.extract(df).collect()}
    for k in range(9):  # the template line of all articles goes, the quoted sentence stays
        quoted = ["a sentence that two pages quote"] if k < 2 else []
        assert got[k].split("\n\n") == [prose(k, 14), *quoted, prose(k + 40, 14)]
    assert got[20] == "" and got[21] == prose(1, 30_000)
    assert PG.extract(df.limit(0)).count() == 0


def test_pairs_do_not_depend_on_the_ranges(spark):
    rows = [(k, f"http://h{k % 3}/d{k % 5}/{k}", f"<p>motto {k % 3}</p><div>{prose(k, 8)}</div>") for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for parts in ("1", "11", "60"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out.append(sorted(tuple(r) for r in PG.extract(df).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1] == out[2] and all("motto" not in r[2] for r in out[0])


def test_digests_are_those_of_hashlib(spark):
    assert spark.sql("select sha2('abc', 256) s").first()["s"] == hashlib.sha256(b"abc").hexdigest()
