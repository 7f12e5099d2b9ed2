"""TF-IDF and latent semantic analysis as per-row transforms.

Fitting aggregates only the vocabulary: every task counts the terms of its
documents and sends (term, documents, occurrences) once, so no (document,
term) row is shuffled. Scoring is a projection of each row: the fitted state
(<= ``max_features`` terms, their idf and the vocab x k basis) travels with the
function, and no join on a document id is needed, so repeated or null ids are
rows like any other. Texts are cleaned, counted and weighed in Arrow batches,
some hundred documents at a time. The decomposition is by Spark's ``RowMatrix``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..session import ship_package

MAX_FEATURES = 1000
MIN_DF = 2
MAX_DF = 0.95
N_COMPONENTS = 20
LOCAL_SVD = 5000  # terms; 200 MB for their products
RCOND = 1e-9  # components below this share of the first are left out
ROWS = 500
HELD_TERMS = 200_000
PIECE = 1 << 21  # bytes of text whose terms are counted at once


def with_tokens(df: DataFrame, text_col: str, out: str, min_len: int = 2, ip_token: str = TX.IP_TOKEN,
                num_token: str = TX.NUM_TOKEN) -> DataFrame:
    """``df`` with the cleaned words of ``text_col`` without stop words."""
    from pyspark.ml.feature import StopWordsRemover
    raw = F.filter(F.split(F.lower(TX.clean_text(text_col, ip_token, num_token)), " "),
                   lambda x: F.length(x) >= min_len)
    remover = StopWordsRemover(inputCol=f"{out}_raw", outputCol=out, stopWords=list(TX.english_stop_words()),
                               caseSensitive=True)
    return remover.transform(df.withColumn(f"{out}_raw", raw)).drop(f"{out}_raw")


def document_terms(df: DataFrame, id_col: str, text_col: str, min_len: int = 2,
                   ngrams: bool = True, ip_token: str = TX.IP_TOKEN,
                   num_token: str = TX.NUM_TOKEN) -> DataFrame:
    """(doc_id, terms): cleaned, tokenised, stop words removed, + bigrams.

    Staged on purpose: the token array is produced once and the JVM
    transformers (hash-set stop-word removal, NGram) read that column.
    Written as one nested expression, Catalyst inlines the whole regex
    chain into every reference (measured ~9x slower on sf0.1 documents)."""
    from pyspark.ml.feature import NGram
    b = with_tokens(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), "_text", "_toks",
                    min_len, ip_token, num_token)
    if not ngrams:
        return b.select("doc_id", F.col("_toks").alias("terms"))
    c = NGram(n=2, inputCol="_toks", outputCol="_bi").transform(b)
    return c.select("doc_id", F.concat("_toks", "_bi").alias("terms"))


def split_words(tokens: str | None) -> list[str]:
    """The words of a document, joined by one space before."""
    return tokens.split(" ") if tokens else []


def _placed(split: pa.Array, place) -> tuple[np.ndarray, np.ndarray]:
    """(text, ``place(word)``) of the words of all lists, in their order, but
    for empty words and those whose place is None; a different word is asked once."""
    text = np.repeat(np.arange(len(split)), pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False))
    coded = split.flatten().dictionary_encode()
    places = [place(w) if w else None for w in coded.dictionary.to_pylist()]
    some = np.array([p is not None for p in places], bool)
    places = np.array([-1 if p is None else p for p in places], np.int64)
    term = coded.indices.to_numpy(zero_copy_only=False)
    inside = some[term]
    return text[inside], places[term[inside]]


def _spaced(texts: pa.Array, place) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts in which one space joins them."""
    return _placed(pc.split_pattern(texts, " "), place)


class Words:
    """The words of texts that :func:`with_tokens` keeps, found in Arrow: the
    patterns run over whole batches, and what holds for a word (its length,
    stop words, whole numbers) is asked once for each different word."""

    def __init__(self, min_len: int = 2, ip_token: str = TX.IP_TOKEN, num_token: str = TX.NUM_TOKEN):
        self.min_len, self.ip_token, self.num_token = min_len, ip_token, num_token
        self.plain = all(re.fullmatch(r"\w+", t) for t in (ip_token, num_token))
        self.stop = frozenset(TX.english_stop_words())

    def column(self, text_col: str) -> Column:
        """The texts to send to :meth:`found`: in lower case, without null. A
        stand-in that is not one word is put in (and split) here."""
        if self.plain:
            return F.lower(F.coalesce(F.col(text_col), F.lit("")))
        return F.lower(TX.clean_text(text_col, self.ip_token, self.num_token))

    def kept(self, word: str) -> str:
        """The word as it is counted; empty if it is not."""
        if self.plain and word.isdecimal() and word.isascii():
            word = self.num_token.lower()
        return word if len(word) >= self.min_len and word not in self.stop else ""

    def found(self, texts: pa.Array, place) -> tuple[np.ndarray, np.ndarray]:
        """(text, ``place(word)``) of the kept words, in their order."""
        clean = pc.replace_substring_regex(texts, pattern=TX.IP_PATTERN, replacement=self.ip_token.lower())
        clean = pc.replace_substring_regex(clean, pattern=TX.NON_WORD_RUN, replacement=" ")

        def kept(w):
            w = self.kept(w)
            return place(w) if w else None
        return _spaced(clean, kept)


def _cuts(texts: pa.Array):
    """(start, length) of at most ``ROWS`` texts, cut after about ``PIECE`` bytes."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < len(texts):
        full = np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE) + 1
        to = min(at + ROWS, int(full), len(texts))
        yield at, to - at
        at = to


def _pieces(texts: pa.Array):
    """Slices of at most ``ROWS`` texts, cut after about ``PIECE`` bytes."""
    return (texts.slice(*cut) for cut in _cuts(texts))


def _counted(keys: np.ndarray, docs: np.ndarray, occurrences: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, sum of docs, sum of occurrences) of the different keys."""
    if not len(keys):
        return keys, docs, occurrences
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(docs[order], first), np.add.reduceat(occurrences[order], first)


def _terms_of(texts: pa.Array, ids: dict[str, int], ngrams: bool, words=_spaced) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, documents, occurrences) in texts, whose words ``words`` finds. A
    word is its number in ``ids``, which grows; a pair is the first word's
    number + 1 in the high 32 bits and the second's in the low ones."""
    doc, term = words(texts, lambda w: ids.setdefault(w, len(ids)))
    n, v = len(texts), len(ids)
    if not len(term):
        return term, term, term
    if ngrams:
        inside = np.flatnonzero(doc[1:] == doc[:-1])
        term, doc = np.concatenate([term, (term[inside] + 1) * v + term[inside + 1]]), np.concatenate([doc, doc[inside]])
    at_doc = np.sort(term * n + doc)
    term = at_doc // n
    new = np.concatenate([[True], at_doc[1:] != at_doc[:-1]])
    first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    before, last = np.divmod(term[first], v)
    return (before << 32) + last, np.add.reduceat(new.astype(np.int64), first), np.diff(first, append=len(term))


def term_statistics(df: DataFrame, text_col: str, min_len: int = 2, ngrams: bool = True,
                    ip_token: str = TX.IP_TOKEN, num_token: str = TX.NUM_TOKEN) -> DataFrame:
    """(term, df, total_tf) over all documents. A task counts the terms of
    some documents at a time as numbers and sends a term once for about
    ``HELD_TERMS`` different terms."""
    ship_package(df.sparkSession)
    words = Words(min_len, ip_token, num_token)

    def run(batches):
        ids, held, n = {}, [], 0

        def told(keys, docs, occurrences):
            known = pa.array(list(ids), pa.string())
            one = keys < 1 << 32
            pair = pc.binary_join_element_wise(known.take(pa.array((keys[~one] >> 32) - 1)),
                                               known.take(pa.array(keys[~one] & 0xFFFFFFFF)), " ")
            terms = pa.concat_arrays([known.take(pa.array(keys[one])), pair])
            both = [pa.array(np.concatenate([c[one], c[~one]]), pa.int64()) for c in (docs, occurrences)]
            return pa.RecordBatch.from_arrays([terms, *both], ["term", "df", "tf"])

        def merged():
            return _counted(*(np.concatenate([np.zeros(0, np.int64), *(h[c] for h in held)]) for c in range(3)))

        for whole in batches:
            for texts in _pieces(whole.column(0)):
                held.append(_terms_of(texts, ids, ngrams, words.found))
                n += len(held[-1][0])
                if n >= 2 * HELD_TERMS:
                    held = [merged()]
                    n = len(held[0][0])
                    if n >= HELD_TERMS:
                        yield told(*held[0])
                        ids, held, n = {}, [], 0
        yield told(*merged())

    parts = df.select(words.column(text_col).alias("t")).mapInArrow(run, "term string, df long, tf long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("total_tf"))


def fit_vocabulary(stats: DataFrame, n_docs: int, min_df: int = MIN_DF, max_df: float = MAX_DF,
                   max_features: int = MAX_FEATURES) -> DataFrame:
    """Terms with min_df <= df <= max_df * n, the ``max_features`` most
    frequent by corpus count (ties: term), indexed alphabetically, with the
    smoothed idf ln((1+n)/(1+df)) + 1."""
    kept = stats.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n_docs)))
    top = kept.orderBy(F.col("total_tf").desc(), F.col("term")).limit(max_features)
    # <= max_features rows: ranking them in one partition is bounded by the parameter
    idx = F.row_number().over(Window.orderBy("term")) - 1
    return top.select("term", "df", "total_tf", idx.alias("term_index"),
                      (F.log(F.lit(1.0 + n_docs) / (F.col("df") + 1)) + 1).alias("idf"))


@dataclass
class TfidfModel:
    """The fitted vocabulary (<= ``max_features`` rows, held on the driver)."""

    terms: list            # (term, df, total_tf, term_index, idf) in index order
    n_docs: int
    min_len: int = 2
    ngrams: bool = True
    ip_token: str = TX.IP_TOKEN
    num_token: str = TX.NUM_TOKEN

    def vocabulary(self, spark) -> DataFrame:
        return spark.createDataFrame([tuple(t) for t in self.terms],
                                     "term string, df long, total_tf long, term_index int, idf double")

    @property
    def size(self) -> int:
        return len(self.terms)

    def tokens(self, df: DataFrame, text_col: str, out: str) -> DataFrame:
        return with_tokens(df, text_col, out, self.min_len, self.ip_token, self.num_token)

    @property
    def words(self) -> Words:
        return Words(self.min_len, self.ip_token, self.num_token)

    def weigher(self):
        """The function from texts of :meth:`Words.column` to (text, term
        index, tf, weight) of all their vocabulary terms, by text and index:
        tf * idf, L2-normalised over the terms of the text."""
        words, v, idf = self.words, self.size, np.array([t[4] for t in self.terms], float)
        alone = {t[0]: t[3] for t in self.terms if " " not in t[0]}
        pairs = [(*t[0].split(" "), t[3]) for t in self.terms if " " in t[0]] if self.ngrams else []
        ids = {w: i for i, w in enumerate(sorted({*alone, *(w for p in pairs for w in p[:2])}))}
        index_of = np.array([alone.get(w, -1) for w in ids] + [-1], np.int64)  # the last for words outside
        keys = sorted((ids[a] * len(ids) + ids[b], i) for a, b, i in pairs)
        pair_key, pair_index = (np.array([k[c] for k in keys], np.int64) for c in (0, 1))

        def weigh(texts: pa.Array):
            text, word = words.found(texts, lambda w: ids.get(w, -1))
            index = index_of[word]
            at, index = text[index >= 0], index[index >= 0]
            if keys:
                both = np.flatnonzero((text[1:] == text[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0))
                key = word[both] * len(ids) + word[both + 1]
                place = np.minimum(np.searchsorted(pair_key, key), len(keys) - 1)
                hit = pair_key[place] == key
                at, index = np.concatenate([at, text[both[hit]]]), np.concatenate([index, pair_index[place[hit]]])
            found, tf = np.unique(at * v + index, return_counts=True)
            at, index = np.divmod(found, max(v, 1))
            raw = tf * idf[index]
            return at, index, tf, raw / np.sqrt(np.bincount(at, raw * raw, len(texts)))[at]
        return weigh

    def transform(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """Long (doc_id, term, term_index, tf, weight), one row per vocabulary
        term of every row; no shuffle."""
        ship_package(df.sparkSession)
        weigh, names = self.weigher(), [t[0] for t in self.terms]
        texts = df.select(F.col(id_col).alias("doc_id"), self.words.column(text_col).alias("t"))
        schema = T.StructType([texts.schema["doc_id"], *T._parse_datatype_string(
            "term string, term_index int, tf long, weight double").fields])

        def run(batches):
            terms = pa.array(names, pa.string())
            for whole in batches:
                for batch in (whole.slice(*cut) for cut in _cuts(whole.column(1))):
                    at, index, tf, weight = weigh(batch.column(1))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), terms.take(pa.array(index)),
                         pa.array(index, pa.int32()), pa.array(tf, pa.int64()), pa.array(weight, pa.float64())], schema.names)

        return texts.mapInArrow(run, schema)

    def weight_vectors(self, df: DataFrame, text_col: str) -> DataFrame:
        """The column ``tfidf`` of :meth:`vectors` alone, from Arrow batches."""
        from pyspark.ml.linalg import VectorUDT
        ship_package(df.sparkSession)
        weigh, v = self.weigher(), self.size

        def run(batches):
            for whole in batches:
                for texts in _pieces(whole.column(0)):
                    at, index, _, weight = weigh(texts)
                    n = len(texts)
                    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))]), pa.int32())
                    fields = [pa.array(np.zeros(n), pa.int8()), pa.array(np.full(n, v), pa.int32()),  # 0: sparse
                              pa.ListArray.from_arrays(ends, pa.array(index, pa.int32())),
                              pa.ListArray.from_arrays(ends, pa.array(weight, pa.float64()))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.StructArray.from_arrays(fields, ["type", "size", "indices", "values"])], ["tfidf"])

        return df.select(self.words.column(text_col).alias("t")).mapInArrow(run, T.StructType([T.StructField("tfidf", VectorUDT())]))

    def vectors(self, df: DataFrame, text_col: str, out: str = "tfidf") -> DataFrame:
        """``df`` with the sparse TF-IDF vector (Spark ML) of every row."""
        from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer
        from pyspark.ml.linalg import Vectors
        t = self.tokens(df, text_col, "_toks")
        if self.ngrams:
            t = NGram(n=2, inputCol="_toks", outputCol="_bi").transform(t)
            t = t.withColumn("_toks", F.concat("_toks", "_bi")).drop("_bi")
        count = CountVectorizerModel.from_vocabulary([x[0] for x in self.terms], inputCol="_toks", outputCol="_tf")
        scale = ElementwiseProduct(scalingVec=Vectors.dense([x[4] for x in self.terms]), inputCol="_tf", outputCol="_raw")
        unit = Normalizer(p=2.0, inputCol="_raw", outputCol=out)
        return unit.transform(scale.transform(count.transform(t))).drop("_toks", "_tf", "_raw")


def fit_tfidf(df: DataFrame, text_col: str, min_len: int = 2, ngrams: bool = True,
              min_df: int = MIN_DF, max_df: float = MAX_DF, max_features: int = MAX_FEATURES,
              ip_token: str = TX.IP_TOKEN, num_token: str = TX.NUM_TOKEN) -> TfidfModel:
    """Fit the vocabulary: one pass over the texts, one aggregation by term."""
    n = df.count()
    stats = term_statistics(df, text_col, min_len, ngrams, ip_token, num_token)
    vocab = fit_vocabulary(stats, n, min_df, max_df, max_features).collect()  # <= max_features rows
    terms = sorted((tuple(r) for r in vocab), key=lambda r: r[3])
    return TfidfModel(terms, n, min_len, ngrams, ip_token, num_token)


# --- LSA ---------------------------------------------------------------------------

@dataclass
class LsaModel:
    components: np.ndarray          # k x V, rows = components over term_index
    singular_values: np.ndarray     # k
    explained_variance: np.ndarray  # k, population variance of projected columns
    total_variance: float           # sum of population variances of all tf-idf columns
    n_docs: int

    @property
    def k(self) -> int:
        return len(self.components)

    def basis(self, spark) -> DataFrame:
        """Long (term_index, component, loading) table, k x V rows."""
        k, v = self.components.shape
        rows = [(int(j), int(c), float(self.components[c, j])) for c in range(k) for j in range(v)]
        return spark.createDataFrame(rows, "term_index int, component int, loading double")

    @property
    def explained_variance_ratio(self) -> np.ndarray:
        return self.explained_variance / self.total_variance if self.total_variance > 0 else \
            np.zeros_like(self.explained_variance)


def lsa_scores(df: DataFrame, text_col: str, tfidf: TfidfModel, model: LsaModel, out: str = "lsa") -> DataFrame:
    """``df`` with the k component scores of every row's text (zeros for a
    text without vocabulary terms): a per-row projection, no join."""
    ship_package(df.sparkSession)
    weigh, basis = tfidf.weigher(), np.ascontiguousarray(model.components.T)

    @F.arrow_udf("array<double>")
    def project(texts: pa.Array) -> pa.Array:
        parts = [np.zeros((0, model.k))]
        for piece in _pieces(texts):
            at, index, _, weight = weigh(piece)
            scores, first = np.zeros((len(piece), model.k)), np.flatnonzero(np.diff(at, prepend=-1))
            if len(first):
                scores[at[first]] = np.add.reduceat(basis[index] * weight[:, None], first, axis=0)
            parts.append(scores)
        whole = np.concatenate(parts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1) * model.k, pa.int32()), pa.array(whole.reshape(-1)))

    return df.withColumn(out, project(tfidf.words.column(text_col)))


def fit_lsa(df: DataFrame, text_col: str, tfidf: TfidfModel, k: int = N_COMPONENTS) -> LsaModel:
    """Truncated SVD of the (uncentred) TF-IDF matrix by Spark's ``RowMatrix``.
    Up to ``LOCAL_SVD`` terms one pass over the rows gives the small matrix of
    the terms' products, whose eigenvectors are the components, and one the
    means; all variances follow from these. Larger vocabularies take
    ``computeSVD``, a pass an iteration. Sign rule: the largest-|loading| entry
    of a component (the first of equal ones) is positive."""
    from pyspark import StorageLevel
    from pyspark.mllib.linalg import Matrices
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils
    k, n, v = min(k, tfidf.size), tfidf.n_docs, tfidf.size
    if k == 0:
        return LsaModel(np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0, n)
    rows = tfidf.weight_vectors(df, text_col).persist(StorageLevel.MEMORY_AND_DISK)
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "tfidf"), n, v)
    if v <= LOCAL_SVD:
        products, mean = matrix.computeGramianMatrix().toArray(), matrix.computeColumnSummaryStatistics().mean()
        value, vector = np.linalg.eigh(products)
        first = np.argsort(-np.abs(value), kind="stable")[:k]
        sv = np.sqrt(np.abs(value[first]))
        sv = sv[sv >= RCOND * sv[0]]
        comps = vector.T[first[:len(sv)]].copy()
    else:
        svd = matrix.computeSVD(k, False, RCOND)
        comps, sv = svd.V.toArray().T[:k].copy(), np.array(svd.s.toArray())[:k]
    for c in range(len(comps)):
        size = np.abs(comps[c])
        if comps[c, np.argmax(size >= size.max() * (1 - 1e-9))] < 0:  # rounding does not choose among equal loadings
            comps[c] = -comps[c]

    def variances(m):  # Spark's variance divides by n - 1
        return m.computeColumnSummaryStatistics().variance() * ((n - 1) / n) if n > 1 else np.zeros(1)

    if v <= LOCAL_SVD:
        total = float((np.diag(products) / n - mean * mean).sum()) if n > 1 else 0.0
        scores = np.maximum(np.einsum("kv,vw,kw->k", comps, products, comps, optimize=True) / n - np.square(comps @ mean), 0.0)
    else:
        total = float(variances(matrix).sum())
        scores = variances(matrix.multiply(Matrices.dense(v, len(comps), comps.reshape(-1))))
    rows.unpersist()
    return LsaModel(comps, sv, scores if n > 1 else np.zeros(len(sv)), total, n)


def similar_terms(tfidf: TfidfModel, model: LsaModel, term: str, n: int = 10) -> list[tuple[str, float]]:
    """The ``n`` terms whose loadings have the highest cosine with those of
    ``term`` (ties: term); none for a term outside the vocabulary. Works on
    the fitted V x k basis alone."""
    place = {t[0]: t[3] for t in tfidf.terms}
    if term not in place:
        return []
    load = model.components.T
    norm = np.linalg.norm(load, axis=1)
    dots = load @ load[place[term]]
    ok = (norm > 0) & (norm[place[term]] > 0)
    ok[place[term]] = False
    cos = [(t[0], float(dots[t[3]] / (norm[t[3]] * norm[place[term]]))) for t in tfidf.terms if ok[t[3]]]
    return sorted(cos, key=lambda x: (-x[1], x[0]))[:n]


def term_similarity(spark, tfidf: TfidfModel, model: LsaModel, asked: DataFrame, term_col: str = "term",
                    n: int = 10) -> DataFrame:
    """(term, similar_term, cosine, rank) for every row of ``asked``; a term
    outside the vocabulary has no row."""
    ship_package(spark)

    @F.pandas_udf("array<struct<similar_term:string,cosine:double>>")
    def nearest(terms):
        known = {t: similar_terms(tfidf, model, t, n) for t in set(terms)}
        return type(terms)([[{"similar_term": s, "cosine": c} for s, c in known[t]] for t in terms])

    rows = asked.select(F.col(term_col).alias("term")).where("term is not null")
    return rows.select("term", F.posexplode(nearest("term")).alias("place", "s")) \
        .select("term", "s.similar_term", "s.cosine", (F.col("place") + 1).alias("rank"))


def document_topics(scored: DataFrame, keep: list[str], lsa_col: str = "lsa", n: int = 3) -> DataFrame:
    """The ``n`` components with the largest |score| of every row (ties: the
    smaller component), per row and without a shuffle."""
    pairs = F.transform(lsa_col, lambda x, i: F.struct((-F.abs(x)).alias("o"), i.alias("component"), x.alias("score")))
    top = F.slice(F.array_sort(pairs), 1, n)
    return scored.select(*keep, F.posexplode(top).alias("place", "t")) \
        .select(*keep, "t.component", "t.score", (F.col("place") + 1).alias("rank"))


def top_terms_per_component(model: LsaModel, tfidf: TfidfModel, spark, n: int = 10) -> DataFrame:
    """n largest-|loading| terms per component, with sign."""
    b = model.basis(spark).join(F.broadcast(tfidf.vocabulary(spark).select("term", "term_index")), "term_index")
    w = Window.partitionBy("component").orderBy(F.abs("loading").desc(), "term")
    return b.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def cluster_term_profile(df: DataFrame, text_col: str, tfidf: TfidfModel, cluster_col: str = "cluster",
                         n: int = 10) -> DataFrame:
    """Mean TF-IDF weight of each term inside each cluster (documents
    without the term count as 0), top ``n`` terms, cluster size. The weights
    meet only in the aggregate of (cluster, term)."""
    w = tfidf.transform(df.select(F.struct(F.col(cluster_col)).alias("_c"), F.col(text_col).alias("_text")), "_c", "_text")
    sums = w.groupBy(F.col(f"doc_id.{cluster_col}").alias(cluster_col), "term").agg(F.sum("weight").alias("sum_w"))
    sizes = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n_samples"))
    s = sums.join(sizes, sums[cluster_col].eqNullSafe(sizes[cluster_col])).select(
        sums[cluster_col], "term", (F.col("sum_w") / F.col("n_samples")).alias("mean_weight"), "n_samples")
    top = Window.partitionBy(cluster_col).orderBy(F.col("mean_weight").desc(), "term")
    return (s.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= n)
            .select(cluster_col, "rank", "term", "mean_weight", "n_samples"))


def rank_terms(df: DataFrame, id_col: str, text_col: str, tfidf: TfidfModel, n: int = 5) -> DataFrame:
    """Top ``n`` terms of every row by |weight| (ties: term), per row."""
    ship_package(df.sparkSession)
    weigh, terms = tfidf.weigher(), [t[0] for t in tfidf.terms]
    order = np.argsort(np.argsort(np.array(terms, object), kind="stable"), kind="stable")  # a term's place by name
    texts = df.select(F.col(id_col).alias("doc_id"), tfidf.words.column(text_col).alias("t"))
    schema = T.StructType([texts.schema["doc_id"], *T._parse_datatype_string("term string, weight double, rank int").fields])

    def run(batches):
        names = pa.array(terms, pa.string())
        for whole in batches:
            for batch in (whole.slice(*cut) for cut in _cuts(whole.column(1))):
                at, index, _, weight = weigh(batch.column(1))
                by = np.lexsort((order[index], -np.abs(weight), at))
                at, index, weight = at[by], index[by], weight[by]
                first = np.flatnonzero(np.diff(at, prepend=-1))
                rank = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at))) + 1
                top = rank <= n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at[top])), names.take(pa.array(index[top])),
                     pa.array(weight[top], pa.float64()), pa.array(rank[top], pa.int32())], schema.names)

    return texts.mapInArrow(run, schema)
