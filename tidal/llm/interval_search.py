"""Ranked lexical search by best-first document intervals.

Every task turns its documents into posting lists whose entries are impacts
(the term's part of the document's score) and puts a range-maximum sparse
table over each list. For an item, an interval of documents can score at most
the sum of its terms' range maxima. The interval with the highest bound is
split at the document that holds the largest of these maxima: that document
is scored exactly and the two remaining intervals get their own bounds.
Intervals whose bound can't reach the item's k-th best document are dropped.

Terms: maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]``,
A-Z lower-cased. A score is exact integer arithmetic (see ``impacts``).

Nothing grows with the documents in one place: a task holds ``SHARD``
postings at a time and k documents an item; only the items, in slices of
``ITEM_BYTES``, and their terms' weights are broadcast.

Defined cases: null or termless documents are in no count and no result;
null or termless items get no rows; equal items (repeated rows too) each get
their rows; every document row counts, also with a repeated or null id (null
ids come last among equal scores); no documents or items: no rows. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, slices, stored, text_bytes

TOP = 10
SHARD = 1_000_000
ITEM_BYTES = 8_000_000
BATCH = 48
TEXT_PIECE = 4_000_000
#: Weights of a term's frequency and a document's length in an impact.
FREQUENCY, LENGTH, SHARE = 1_000_000_000, 8, 90
NO_ID = np.iinfo(np.int64).max
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                 for b in range(256))


def terms_of(text: bytes):
    """The terms of a text, a few megabytes at a time."""
    text, at = text.translate(TO_TERMS), 0
    while at < len(text):
        end = text.find(b" ", at + TEXT_PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _counted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs): the length of every document that has terms
    and the frequencies of the items' terms in it."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        number = known.value.get
        for batch in (part for whole in batches for part in slices(whole, 2000)):
            rows = [[], [], [], []]
            ids = batch.column(0).to_pylist()
            for doc_id, raw in zip(ids, text_bytes(batch, "text")):
                n, seen = 0, Counter()
                for words in terms_of(raw):
                    n += len(words)
                    seen.update(map(number, words))
                if n:
                    seen.pop(None, None)
                    for col, v in zip(rows, (doc_id, n, list(seen), list(seen.values()))):
                        col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], ["doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def impacts(tf, n, weight, total: int, length: int):
    """A term's part of a document's score: 64-bit integers, division
    rounding down. ``total`` documents hold ``length`` terms together."""
    if SHARE * int(n.max(initial=0)) * total < 1 << 63:
        m = 100 - SHARE + (SHARE * n * total) // length
    else:
        m = np.array([100 - SHARE + (SHARE * int(x) * total) // length for x in n], np.int64)
    return weight * ((FREQUENCY * tf) // (1000 * tf + LENGTH * m))


class Shard:
    """Posting lists of some documents, in the order of their ids, with a
    sparse table of range maxima over each list."""

    def __init__(self, ids, term, doc, impact):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.docs = ids[order], len(ids)
        key = term.astype(np.int64) * self.docs + place[doc]
        by_key = np.argsort(key, kind="stable")
        self.keys, self.impact = key[by_key], impact[by_key]
        longest = int(np.bincount(term).max(initial=1))
        levels = max(1, longest.bit_length())
        self.table = np.empty((levels, len(key)), np.int32)
        self.table[0] = np.arange(len(key))
        for j in range(1, levels):
            half = 1 << (j - 1)
            self.table[j] = self.table[j - 1]
            left, right = self.table[j - 1][:-half], self.table[j - 1][half:]
            self.table[j][:-half] = np.where(self.impact[right] > self.impact[left], right, left)

    def _maxima(self, a, b):
        """The places of the largest impacts in the ranges [a, b) of the lists."""
        j = np.frexp((b - a).astype(np.float64))[1] - 1
        left, right = self.table[j, a], self.table[j, b - (1 << j)]
        return np.where(self.impact[right] > self.impact[left], right, left)

    def _bounds(self, base, a, b):
        """What intervals, given by their terms' ranges [a, b) of postings,
        can score at most, and the document at which each is split."""
        held = b > a
        top = np.zeros(a.shape, np.int64)
        where = np.zeros(a.shape, np.int64)
        where[held] = self._maxima(a[held], b[held])
        top[held] = self.impact[where[held]]
        pick = top.argmax(1)
        return top.sum(1), self.keys[where[np.arange(len(a)), pick]] - base[pick]

    def search(self, terms, k: int, best: tuple[np.ndarray, np.ndarray]):
        """``best`` (scores, ids) after the documents of this shard."""
        if not len(self.keys):
            return best
        base = terms.astype(np.int64) * self.docs
        batch = max(4, min(BATCH, 65536 // len(terms)))
        lo = np.zeros(1, np.int64)
        a, b = (np.searchsorted(self.keys, base + x)[None, :] for x in (0, self.docs))
        bound, split = self._bounds(base, a, b)
        while True:
            keep = bound > 0
            if len(best[0]) == k:
                keep = (bound > best[0][-1]) | ((bound == best[0][-1]) & (self.ids[lo] < best[1][-1]))
            lo, a, b, bound, split = lo[keep], a[keep], b[keep], bound[keep], split[keep]
            if not len(lo):
                return best
            order = np.lexsort((lo, -bound))
            now, later = order[:batch], order[batch:]
            wanted = base + split[now][:, None]
            at = np.searchsorted(self.keys, wanted)
            here = np.minimum(at, len(self.keys) - 1)
            hit = self.keys[here] == wanted
            best = merged(best, ((self.impact[here] * hit).sum(1), self.ids[split[now]]), k)
            new_a, new_b = np.concatenate([a[now], at + hit]), np.concatenate([at, b[now]])
            new_lo = np.concatenate([lo[now], split[now] + 1])
            some = (new_b > new_a).any(1)
            new_a, new_b, new_lo = new_a[some], new_b[some], new_lo[some]
            new_bound, new_split = self._bounds(base, new_a, new_b)
            lo, a, b = np.concatenate([lo[later], new_lo]), np.concatenate([a[later], new_a]), np.concatenate([b[later], new_b])
            bound, split = np.concatenate([bound[later], new_bound]), np.concatenate([split[later], new_split])


def merged(a, b, k: int):
    """The k best of two lists: highest score first, then the smallest id."""
    score, ids = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.lexsort((ids, -score))
    order = order[score[order] > 0][:k]
    return score[order], ids[order]


def _found(counted: DataFrame, items: list[np.ndarray], weights: np.ndarray, total: int, length: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of every task and item."""
    known = counted.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches):
        items, weights = known.value
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(items)
        held, size = [], 0

        def search():
            ids = np.concatenate([h[0] for h in held])
            n = np.concatenate([h[1] for h in held])
            count = np.concatenate([h[2] for h in held])
            term = np.concatenate([h[3] for h in held])
            tf = np.concatenate([h[4] for h in held])
            doc = np.repeat(np.arange(len(ids)), count)
            shard = Shard(ids, term, doc, impacts(tf, n[doc], weights[term], total, length))
            for q, terms in enumerate(items):
                best[q] = shard.search(terms, k, best[q])

        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(2)
            held.append((batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(),
                         np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()))
            size += len(held[-1][3])
            if size >= SHARD:
                search()
                held, size = [], 0
        if held:
            search()
        q = np.repeat(np.arange(len(items)), [len(b[0]) for b in best])
        scores, ids = (np.concatenate([b[x] for b in best]) if best else np.empty(0, np.int64) for x in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, pa.int64(), mask=ids == NO_ID),
                                          pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return counted.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item
    with a score above 0; equal scores by ascending id."""
    spark = docs.sparkSession
    asked = items.select(F.col(quoted(item_col)).alias("item_id"), F.col(quoted(item_text_col)).cast("binary").alias("t")) \
        .where("t is not null").withColumn("key", F.sha2("t", 256))
    queries = asked.groupBy("key").agg(F.first("t").alias("t"))
    parts = 1 + (queries.agg(F.sum(F.length("t"))).first()[0] or 0) // ITEM_BYTES
    out = None
    for part in range(parts):
        rows = queries.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).collect()
        vocabulary: dict[bytes, int] = {}
        keys, wanted = [], []
        for r in sorted(rows, key=lambda r: r["key"]):
            ids = {vocabulary.setdefault(w, len(vocabulary)) for words in terms_of(bytes(r["t"])) for w in words}
            if ids:
                keys.append(r["key"])
                wanted.append(np.array(sorted(ids), np.int64))
        counted = stored(_counted(docs, vocabulary, id_col, text_col), f"term-counts-{part}")
        total, length, postings = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
        df = np.zeros(max(1, len(vocabulary)), np.int64)
        for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[r["t"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        found = _found(counted.coalesce(max(1, math.ceil(postings / (SHARD // 2)))), wanted, weights, total, length, k)
        best = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(
            F.col("score").desc(), F.col("doc_id").asc_nulls_last()))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, key) for i, key in enumerate(keys)], "item int, key string")
        best = best.join(names, "item").select("key", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return out.join(asked.select("item_id", "key"), "key").select("item_id", "rank", "doc_id", "score")
