"""Queries of the training-data operators and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cross_parsing as CP
from . import decontaminate as DC
from . import difference_cover as DV
from . import interval_search as IS
from . import line_frequency as LF
from . import mixing as MX
from . import page_difference as PG
from . import personal_data as PD
from . import quality_knn as QK
from . import shingle_join as SJ
from . import threshold_negatives as TN
from . import token_planes as TP
from . import toxicity as TX
from .common import fold, held_out, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return keep


def queries() -> dict:
    import corpus_pipeline
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


@register("op4_token_planes")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids through the plane files and back."""
    import public_tokenizers
    return TP.token_planes(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of every document against the whole benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = DC.decontaminate(docs, table(spark, sf_dir, "benchmark"), clean=False)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@register("op8_cross_parsing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    parser = CP.learn(docs, fold("doc_id", 3) != 1)
    out = CP.identify(docs.select("doc_id", "text"), parser)
    return out.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


@register("op10_quality_knn")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = QK.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    out = QK.score_quality(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = TX.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    out = TX.score_toxicity(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


@register("op5_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken of each."""
    m = MX.mix(table(spark, sf_dir, "documents"))
    rows = m.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * MX.copies_of(F.col("row"))).alias("taken"))


@register("op6_line_frequency")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every document, its source being the host."""
    out = LF.filter_quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = PD.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["order"] < len(PD.BASE))
    counts = [F.size(PD.of_kind(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in PD.BASE]
    return found.select("doc_id", *counts, F.sha2(PD.joined(base), 256).alias("base_sha256"),
                        PD.joined(F.col("spans")).alias("spans"))


@register("op9_page_difference")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return PG.extract(table(spark, sf_dir, "pages"))


@register("op7_shingle_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of Jaccard 0.75 or more."""
    return SJ.near_duplicates(table(spark, sf_dir, "documents"))


SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * totals.docs) // totals.words)))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

NEGATIVES_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a, usable b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
windows AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 10
"""


@register("op11_interval_search", SEARCH_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return IS.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_threshold_negatives", NEGATIVES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return TN.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


@register("op13_difference_cover")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeated 400-byte strings cover."""
    out = DV.remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
