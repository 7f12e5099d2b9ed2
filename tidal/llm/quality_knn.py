"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Terms are word shapes (letter case, digits, the punctuation around them) and
counts of repetition (a word that equals the one before, word triples seen
earlier in the text), so texts of any language share a vocabulary. TF-IDF
vectors of labelled documents give, by singular value decomposition,
``DIMENSIONS`` latent axes. The labelled vectors are broadcast; every
document is projected, its exact cosines with all of them are one blocked
matrix product, and the ``NEIGHBOURS`` nearest vote with their similarity.

``TRAIN_ROWS`` bounds the labelled sample, and with it the broadcast
(``TRAIN_ROWS x DIMENSIONS`` floats) and the driver's matrix.

Defined cases: null and empty texts score like any other (their only term is
their length); without labels, or with no positive cosine, the score is the
labelled share of 1 (0.5 if there is none); ties in similarity go to the
smaller id; repeated rows get equal results; extra columns pass through,
those named like a result are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import labelled_sample, text_bytes, with_computed

TRAIN_ROWS = 6_000
VOCABULARY = 1_500
MIN_DF = 3
DIMENSIONS = 32
NEIGHBOURS = 25
SHARPNESS = 8
BLOCK = 256
KINDS = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 57 if 48 <= b <= 57 else b
              for b in range(256))
RUNS = re.compile(rb"([aA9])\1+")
LONG = re.compile(rb"([^aA9\s])\1{3,}")


def shapes_of(raw: bytes) -> list[bytes]:
    """The shape of every word: runs of lower-case letters (and of all
    letters beyond ASCII) as a, of capitals as A, of digits as 9; other
    characters stay, three of a kind standing for more."""
    return RUNS.sub(rb"\1", LONG.sub(rb"\1\1\1", raw.translate(KINDS))).split()


def word_numbers(raw: bytes) -> np.ndarray:
    """A number for each word, equal for equal words of the text."""
    words = raw.split()
    return np.fromiter(map(hash, words), np.int64, len(words))


def structure(ids: np.ndarray) -> dict[str, int]:
    """Repetition and length of a text's word numbers."""
    n = len(ids)
    out = {f"words:{n.bit_length()}": 1}
    if n > 1:
        out["again"] = int((ids[1:] == ids[:-1]).sum())
    if n > 2:
        triples = (ids[:-2] * 1_000_003 + ids[1:-1]) * 1_000_003 + ids[2:]
        out["triples"] = n - 2 - len(np.unique(triples))
    return {k: v for k, v in out.items() if v}


class Model:
    """Fitted vocabulary, idf, axes and labelled vectors."""

    def __init__(self, rows: list[tuple[int, list[str], list[int]]]):
        labels = np.array([r[0] for r in rows], np.float64)
        self.prior = float(labels.mean()) if len(rows) else 0.5
        df: dict[str, int] = {}
        for _, terms, _ in rows:
            for t in terms:
                df[t] = df.get(t, 0) + 1
        kept = sorted((t for t in df if df[t] >= min(MIN_DF, max(1, len(rows) // 50))),
                      key=lambda t: (-df[t], t))[:VOCABULARY]
        self.index = {t: k for k, t in enumerate(kept)}
        self.idf = np.array([np.log((1 + len(rows)) / (1 + df[t])) + 1 for t in kept], np.float32)
        x = np.zeros((len(rows), len(kept)), np.float32)
        for i, (_, terms, counts) in enumerate(rows):
            for t, c in zip(terms, counts):
                if t in self.index:
                    x[i, self.index[t]] = c
        x = self.weigh(x)
        _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
        self.axes = np.ascontiguousarray(axes[:, ::-1][:, :DIMENSIONS].astype(np.float32))
        self.vectors, self.labels = self.project(x), labels

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)

    def project(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.axes
        return z / np.maximum(np.sqrt((z * z).sum(axis=1, keepdims=True)), 1e-9)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted vote of the nearest labelled vectors."""
        if not len(self.labels) or not len(self.index):
            return np.full(len(counts), self.prior)
        cosines = self.project(self.weigh(counts)) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        least = np.partition(cosines, -k, axis=1)[:, -k][:, None]
        above, equal = cosines > least, cosines == least
        room = k - above.sum(axis=1, keepdims=True)  # of equal cosines the smallest ids (rows are in their order)
        near = np.nonzero(above | (equal & (np.cumsum(equal, axis=1) <= room)))[1].reshape(-1, k)
        weights = np.maximum(np.take_along_axis(cosines, near, 1).astype(np.float64), 0) ** SHARPNESS
        total = weights.sum(axis=1)
        vote = (weights * self.labels[near]).sum(axis=1)
        return np.clip(np.where(total > 0, vote / np.maximum(total, 1e-12), self.prior), 0, 1)


def sample_terms(batches):
    for batch in batches:
        out = {"doc_id": [], "label": [], "terms": [], "counts": []}
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), text_bytes(batch))
        for i, label, raw in rows:
            counts = {"shape:" + k.decode("utf-8", "replace"): v for k, v in Counter(shapes_of(raw)).items()}
            counts |= structure(word_numbers(raw))
            for k, v in zip(out, (i, label, list(counts), list(counts.values()))):
                out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, pa.schema([("doc_id", pa.int64()), ("label", pa.int32()),
                                                         ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32()))]))


def learn(documents: DataFrame, labels: DataFrame, train, label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled training documents."""
    sample = labelled_sample(documents, labels, label, train, rows)
    got = sample.select("doc_id", "label", "text").mapInArrow(
        sample_terms, "doc_id long, label int, terms array<string>, counts array<int>").collect()
    return Model([(r["label"], r["terms"], r["counts"]) for r in sorted(got, key=lambda r: (r["doc_id"], r["terms"]))])


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` with score (likelihood of label 1) and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        known = {t[6:].encode(): k for t, k in m.index.items() if t.startswith("shape:")}

        def work(batch):
            found, scores = text_bytes(batch, text_col), []
            for a in range(0, len(found), BLOCK):
                block = found[a:a + BLOCK]
                x = np.zeros((len(block), len(m.index)), np.float32)
                for row, raw in zip(x, block):
                    for s, n in Counter(shapes_of(raw)).items():
                        if s in known:
                            row[known[s]] = n
                    for t, n in structure(word_numbers(raw)).items():
                        if t in m.index:
                            row[m.index[t]] = n
                scores += m.score(x).tolist()
            return [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
        return work

    return with_computed(docs, "score double, predicted int", make)
