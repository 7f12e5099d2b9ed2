"""Queries for text cleaning, n-grams, TF-IDF and LSA (documents, events)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import text as X
from ..session import spread
from ..sources import tables as T
from .registry import NET_EVENTS_CTE, query, with_ctes

SW = ", ".join("'" + w.replace("'", "''") + "'" for w in TX.english_stop_words())


@query("clean_log_text", f"""{with_ctes(NET_EVENTS_CTE)}
SELECT event_id, {TX.duck_clean_sql('log_message')} AS clean_text FROM net_events""")
def q_clean_log_text(spark, sf):
    return T.net_events(spark, sf).select("event_id", TX.clean_text("log_message").alias("clean_text"))


@query("clean_document_text", f"""
SELECT doc_id, {TX.duck_clean_sql('text')} AS clean_text FROM documents""")
def q_clean_document_text(spark, sf):
    """The cleaner on whole multilingual documents (accents, digits, IPs)."""
    d = T.read_table(spark, sf, "documents")
    return d.select("doc_id", TX.clean_text("text").alias("clean_text"))


# DuckDB twin of the whole TF-IDF fit on `documents`
DOC_TERMS = f"""WITH c AS (SELECT doc_id, {TX.duck_clean_sql('text')} AS ct FROM documents),
tk AS (SELECT doc_id, list_filter(string_split(lower(ct), ' '),
                                  lambda x: length(x) >= 2 AND NOT list_contains([{SW}], x)) AS t FROM c),
terms AS (SELECT doc_id, len(t) AS n_unigrams,
                 list_concat(t, CASE WHEN len(t) >= 2
                                     THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
                                     ELSE [] END) AS terms FROM tk),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM terms)
       GROUP BY doc_id, term),
nd AS (SELECT count(*) AS n FROM documents),
st AS (SELECT term, count(*) AS df, sum(tf) AS total_tf FROM tf GROUP BY term),
top AS (SELECT term, df, total_tf FROM st, nd
        WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * n ORDER BY total_tf DESC, term LIMIT 1000),
vocab AS (SELECT term, df, total_tf, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index,
                 ln((1.0 + n) / (df + 1)) + 1 AS idf FROM top, nd),
raw AS (SELECT doc_id, tf.term, term_index, tf, tf * idf AS raw FROM tf JOIN vocab ON tf.term = vocab.term),
w AS (SELECT doc_id, term, term_index, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight
      FROM raw)"""


def _docs(spark, sf):
    return spread(T.read_table(spark, sf, "documents"))


def _fit_docs(spark, sf):
    d = _docs(spark, sf)
    return d, X.fit_tfidf(d, "text")


@query("tokenize_ngrams", f"""{DOC_TERMS}
SELECT doc_id, CAST(n_unigrams AS INTEGER) AS n_unigrams, CAST(len(terms) AS INTEGER) AS n_terms,
       array_to_string(terms, ' | ') AS terms FROM terms""")
def q_tokenize_ngrams(spark, sf):
    """Unigrams (stop words removed) and bigrams per document."""
    d = X.document_terms(_docs(spark, sf), "doc_id", "text")
    n_uni = F.size(F.filter("terms", lambda t: ~F.contains(t, F.lit(" "))))
    return d.select("doc_id", n_uni.alias("n_unigrams"), F.size("terms").alias("n_terms"),
                    F.array_join("terms", " | ").alias("terms"))


@query("tfidf_vocab", f"""{DOC_TERMS}
SELECT term, df, CAST(total_tf AS BIGINT) AS total_tf, term_index, round(idf, 9) AS idf FROM vocab""")
def q_tfidf_vocab(spark, sf):
    """Vocabulary: df bounds, 1,000 most frequent terms, smoothed idf."""
    _, model = _fit_docs(spark, sf)
    return model.vocabulary(spark).withColumn("idf", F.round("idf", 9))


@query("tfidf_weights", f"""{DOC_TERMS}
SELECT doc_id, term, term_index, tf, round(weight, 6) AS weight FROM w""", headline=True)
def q_tfidf_weights(spark, sf):
    """L2-normalised tf-idf weights, long form."""
    d, model = _fit_docs(spark, sf)
    return model.transform(d, "doc_id", "text").withColumn("weight", F.round("weight", 6))


@query("rank_terms", f"""{DOC_TERMS}
SELECT doc_id, term, round(weight, 6) AS weight, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(weight) DESC, term) AS rank FROM w)
WHERE rank <= 5""")
def q_rank_terms(spark, sf):
    """Top 5 terms per document by weight."""
    d, model = _fit_docs(spark, sf)
    r = X.rank_terms(d, "doc_id", "text", model, 5)
    return r.select("doc_id", "term", F.round("weight", 6).alias("weight"), "rank")


@query("cluster_term_profile", f"""{DOC_TERMS},
sizes AS (SELECT lang AS cluster, count(*) AS n_samples FROM documents GROUP BY lang),
s AS (SELECT lang AS cluster, term, sum(weight) AS sum_w FROM w JOIN documents USING (doc_id)
      GROUP BY lang, term),
m AS (SELECT s.cluster, term, sum_w / n_samples AS mean_weight, n_samples FROM s JOIN sizes USING (cluster))
SELECT cluster, CAST(rank AS INTEGER) AS rank, term, round(mean_weight, 6) AS mean_weight, n_samples FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY mean_weight DESC, term) AS rank FROM m)
WHERE rank <= 10""")
def q_cluster_term_profile(spark, sf):
    """Mean TF-IDF weight per (language, term), top 10 terms per language."""
    d, model = _fit_docs(spark, sf)
    p = X.cluster_term_profile(d.withColumnRenamed("lang", "cluster"), "text", model, "cluster", 10)
    return p.withColumn("mean_weight", F.round("mean_weight", 6))


def _lsa(spark, sf):
    d, model = _fit_docs(spark, sf)
    return d, model, X.fit_lsa(d, "text", model, X.N_COMPONENTS)


@query("lsa_fit")
def q_lsa_fit(spark, sf):
    """Truncated SVD (20 components) of the document TF-IDF matrix."""
    _, _, lsa = _lsa(spark, sf)
    rows = [(i, float(lsa.singular_values[i]), float(lsa.explained_variance[i]),
             float(lsa.explained_variance_ratio[i])) for i in range(len(lsa.singular_values))]
    return spark.createDataFrame(rows, "component int, singular_value double, "
                                       "explained_variance double, explained_variance_ratio double")


@query("lsa_transform")
def q_lsa_transform(spark, sf):
    """The 20 component scores of every document."""
    d, model, lsa = _lsa(spark, sf)
    out = X.lsa_scores(d.select("doc_id", "text"), "text", model, lsa)
    return out.select("doc_id", *[F.col("lsa")[c].alias(f"lsa_{c}") for c in range(lsa.k)])


@query("explained_variance")
def q_explained_variance(spark, sf):
    _, _, lsa = _lsa(spark, sf)
    ratio = lsa.explained_variance_ratio
    rows = [(i, float(lsa.explained_variance[i]), float(ratio[i])) for i in range(len(ratio))]
    df = spark.createDataFrame(rows, "component int, explained_variance double, ratio double")
    return df.withColumn("cumulative", F.sum("ratio").over(
        Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("total_ratio", F.sum("ratio").over(Window.partitionBy()))


@query("top_terms_per_component")
def q_top_terms_per_component(spark, sf):
    _, model, lsa = _lsa(spark, sf)
    return X.top_terms_per_component(lsa, model, spark, 10)


# ---- LSA of the log messages: words of one character count, own stand-in tokens ------

def log_lsa(spark, sf):
    ev = spread(T.net_events(spark, sf).select("event_id", "log_message"))
    tfidf = X.fit_tfidf(ev, "log_message", min_len=1, ip_token=TX.LSA_IP_TOKEN, num_token=TX.LSA_NUM_TOKEN)
    return ev, tfidf, X.fit_lsa(ev, "log_message", tfidf, X.N_COMPONENTS)


@query("term_similarity_lsa")
def q_term_similarity_lsa(spark, sf):
    """The 10 terms most similar to each word of the log messages, by cosine
    of their loadings. The asked words are all distinct words of the table;
    one outside the vocabulary has no row."""
    ev, tfidf, lsa = log_lsa(spark, sf)
    asked = tfidf.tokens(ev, "log_message", "w").select(F.explode("w").alias("term")).distinct()
    return X.term_similarity(spark, tfidf, lsa, asked)


@query("document_topics_lsa")
def q_document_topics_lsa(spark, sf):
    """The 3 dominant components of every event's log message."""
    ev, tfidf, lsa = log_lsa(spark, sf)
    return X.document_topics(X.lsa_scores(ev, "log_message", tfidf, lsa), ["event_id"])
