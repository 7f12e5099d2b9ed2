"""Quality rules with cross-document line frequency, natively.

Rules on one text (``base``): word characters, symbols, repeated lines, and
words inside repeated windows of eight words; too few words or too many
repeated ones fail. The cross-document rule: a line, lower-cased with white
space and digits levelled, is boilerplate of its host when more than
``MIN_DOCS`` documents of the host hold it, and also more than ``MAX_SHARE`` of
the host's documents or more than ``MAX_DOCS``; without its boilerplate lines a
document must keep ``MIN_WORDS`` words and ``MIN_KEPT`` of its words, or it is
depleted.

The text is read once; what goes on is one narrow row per document with the
hashes of its lines. Line counts aggregate before they shuffle, a very common
line is one counted row per task.

Defined cases: a null or empty text has no words and fails; a null host is a
host; repeated rows are documents of their own; extra columns pass by unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, stored, unused

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MIN_DOCS = 10
MAX_SHARE = 0.05
MAX_DOCS = 1000
MIN_KEPT = 0.3


def bound(value: Column, use) -> Column:
    """``use(x)`` with ``value`` computed once a row, whatever use does."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more. Windows are compared by
    a 64-bit hash; places of equal windows are neighbours once sorted."""
    def windows(hashes: Column) -> Column:
        return F.when(F.size(hashes) > window, F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (window - 1)), lambda i: F.xxhash64(F.slice(hashes, i, window)))) \
            .otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        n = F.size(places)
        gaps = F.transform(places, lambda p, i: F.when(i + 1 < n, F.least(F.get(places, i + 1) - p, F.lit(window)))
                           .otherwise(window))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def same(pairs: Column) -> Column:
        again = F.filter(pairs, lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]))
        return bound(F.array_sort(F.transform(again, lambda x: x["i"])), covered)

    def places(h: Column) -> Column:
        sorted_pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), bound(sorted_pairs, same)).otherwise(0)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return bound(bound(hashed, windows), places)


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]+", "0"), r"[\x20\x09-\x0D]+", " "))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One narrow row per document: the base counts and its lines' hashes."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")

    def counts(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))

    def by_line(found: Column) -> Column:
        return F.struct(
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
            F.transform(found, lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"),
                                                  F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))).alias("lines"))

    return docs.select(
        F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(host_col)).alias("host"), bound(words_of(text), counts).alias("w"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bound(lines, by_line).alias("l")) \
        .select("doc_id", "host", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.lines")


def common_lines(rows: DataFrame, min_docs: int, max_share: float, max_docs: int) -> DataFrame:
    """(of, same): the hosts and their boilerplate lines' hashes."""
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > min_docs)
    common = (rows.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
              .groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs))
    return stored(common.join(hosts.withColumnRenamed("host", "of"), common["host"].eqNullSafe(F.col("of")))
                  .where((F.col("n") > max_docs) | (F.col("n") > max_share * F.col("docs")))
                  .select(F.col("host").alias("of"), F.col("h").alias("same")), "common")


def filter_quality(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
                   min_words: int = MIN_WORDS, min_kept: float = MIN_KEPT, max_docs: int = MAX_DOCS, **columns) -> DataFrame:
    """doc_id, host, the base counts, words in boilerplate lines, base_failed,
    depleted and kept."""
    rows = stored(measure(docs, **columns).withColumn("row", F.monotonically_increasing_id()), "lines")
    common = common_lines(rows, min_docs, max_share, max_docs)
    lines = rows.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.h", "x.words")
    lost = (lines.join(common, lines["host"].eqNullSafe(common["of"]) & (lines["h"] == common["same"]))
            .groupBy(F.col("row").alias("in_row")).agg(F.sum("words").alias("lost_words")))
    out = rows.drop("lines").join(lost, F.col("row") == F.col("in_row"), "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("lost_words")
    depleted = F.col("lost_words").isNotNull() & ((left < min_words) | (left < min_kept * F.col("n_words")))
    return (out.withColumn("boilerplate_words", F.coalesce("lost_words", F.lit(0)).cast("long"))
            .withColumn("base_failed", failed).withColumn("depleted", depleted)
            .withColumn("kept", ~failed & ~depleted).drop("row", "in_row", "lost_words"))


def without_boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_docs: int = MAX_DOCS,
                        id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` with each text left without its host's boilerplate lines. The
    lines of a host are few, as each is in many of its documents. Null texts
    stay null, a null host is one host, all columns keep their names."""
    rows = stored(measure(docs, id_col, text_col, host_col).select("host", "lines"), "host-lines")
    of, same = unused(docs.columns, "of", "same")
    sets = (common_lines(rows, min_docs, max_share, max_docs).groupBy(F.col("of").alias(of))
            .agg(F.collect_set("same").alias(same)))
    text = F.col(quoted(text_col))
    left = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(same, F.xxhash64(normal_line(x))))
    out = docs.join(sets, F.col(quoted(host_col)).eqNullSafe(F.col(of)), "left")
    return out.select(*[F.when(F.col(same).isNull(), text).otherwise(F.array_join(left, "\n")).alias(c) if c == text_col
                        else F.col(quoted(c)) for c in docs.columns])
