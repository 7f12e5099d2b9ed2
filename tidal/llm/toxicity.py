"""Toxicity by weak supervision.

1. Lexicons. From a bounded labelled sample, words and word beginnings that
   occur almost only in toxic documents form one lexicon per kind of key; a
   fixed list of insults is another.
2. Voters. Every lexicon votes with one match and, as a second voter, with
   two different matches; patterns (lower-case sentence starts, shouting,
   insults close together) vote too. A voter says 1, 0, or abstains.
3. Label model. The votes of all documents, counted by vote pattern, feed
   expectation maximisation, which estimates the class share and every
   voter's accuracy without labels. Correlations of voters given the class
   are measured under the model, and a voter's evidence is divided by the
   correlated voters beside it. The sample's labels only set which class is
   which and the starting point.
4. Classifier. A logistic regression over lexicon keys is trained on the
   sample's posterior labels and scores every document; it is linear, so a
   document's score is a sum over its different words.

Bounds: ``TRAIN_ROWS`` sample rows, ``KEYS_PER_KIND`` keys a kind; the vote
patterns are at most 3 to the power of the voters, whatever the corpus.

Defined cases: null and empty texts get the intercept's score; without labels
only the fixed list votes and the score is its share of evidence; repeated
rows get equal scores; extra columns pass through, those named like a result
are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, labelled_sample, stored, texts, with_computed

TRAIN_ROWS = 10_000
KEYS_PER_KIND = 400
LENGTHS = (3, 4, 5, 6)
LEAST_TOXIC = 3
PURITY = 0.9
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")
CAPITALS = re.compile(r"[A-Z]{4,}")
LOWER_START = re.compile(r"[.!?]\s+(?=[^\W\d_A-Z])(\w)")
# fixed values: insults that vote whatever the sample says
INSULTS = ["idiot", "stupid", "moron", "loser", "pathetic", "disgusting", "worthless", "scum", "trash", "clown"]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def keys_of(words: set[str]) -> set[str]:
    """All lexicon keys of a document: whole words and word beginnings."""
    out = {"w:" + w for w in words}
    for n in LENGTHS:
        out |= {f"{n}:" + w[:n] for w in words if len(w) >= n}
    return out


class Lexicons:
    """Keys by kind with their classifier weights; finds a text's matches."""

    def __init__(self, keys: list[str]):
        self.kinds = {"w": set(), **{str(n): set() for n in LENGTHS}}
        for k in keys:
            kind, _, body = k.partition(":")
            self.kinds[kind].add(body)
        self.insults = set(INSULTS)

    def matches(self, words: set[str]) -> list[set[str]]:
        """The document's words that match each lexicon."""
        out = [words & self.insults, words & self.kinds["w"]]
        for n in LENGTHS:
            known = self.kinds[str(n)]
            out.append({w for w in words if w[:n] in known} if known else set())
        return out

    def votes(self, text: str) -> tuple[int, ...]:
        """1 toxic, 0 not, -1 abstains. Lexicons never speak against."""
        found = self.matches(words_of(text))
        out = [v for m in found for v in (1 if m else -1, 1 if len(m) > 1 else -1)]
        hits = len(set().union(*found))
        starts, capitals = len(LOWER_START.findall(text)), len(CAPITALS.findall(text))
        out.append(0 if hits == 0 else -1)                         # nothing matches
        out.append(1 if hits >= 3 else -1)                         # insults close together
        out.append(1 if hits > 1 and starts > 1 else 0 if not starts and hits < 2 else -1)
        out.append(1 if hits > 1 and capitals > 2 else -1)
        out.append(0 if hits < 2 else 1)                           # one match may be chance
        return tuple(out)


class LabelModel:
    """Two-class generative model of vote patterns: each voter that speaks is
    right with its own accuracy; what correlated voters say together is
    divided by their company."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], start: np.ndarray, rounds: int = 50):
        votes = np.array([p for p, _ in patterns], np.int8)
        n = np.array([c for _, c in patterns], np.float64)
        post = np.clip(start, 0.02, 0.98)
        self.correlations = np.zeros((votes.shape[1],) * 2)
        for r in range(rounds):
            self.prior = float(np.clip((n @ post) / max(n.sum(), 1), 1e-3, 1 - 1e-3))
            right = np.where(votes == 1, post[:, None], np.where(votes == 0, 1 - post[:, None], 0.0))
            self.accuracy = np.clip((n @ right + 1.5) / (n @ (votes >= 0) + 2.0), 0.05, 0.995)
            if r in (5, 15, 30):
                self.correlations = self._correlate(votes == 1, np.stack([n * (1 - post), n * post]))
            post = self.posterior(votes)

    @staticmethod
    def _correlate(says: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Mean absolute correlation of voters given the class (0 below 0.2)."""
        x, total = says.astype(np.float64), np.zeros((says.shape[1],) * 2)
        for row in w:
            if row.sum() > 1:
                d = x - (row @ x) / row.sum()
                cov = (d * row[:, None]).T @ d / row.sum()
                s = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                total += np.abs(cov / np.outer(s, s)) / len(w)
        np.fill_diagonal(total, 0)
        return np.where(total > 0.2, total, 0)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        weight = np.log(self.accuracy / (1 - self.accuracy))
        for_toxic, against = votes == 1, votes == 0
        company = 1 + np.where(for_toxic, for_toxic @ self.correlations, against @ self.correlations)
        evidence = np.where(for_toxic, weight, np.where(against, -weight, 0.0)) / company
        logit = evidence.sum(axis=1) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_linear(rows: list[dict[int, float]], target: np.ndarray, width: int, ridge: float = 1e-5, steps: int = 1500):
    """Logistic regression on soft labels by accelerated gradient descent;
    equal rows are one weighted row."""
    groups: dict[tuple, list[float]] = {}
    for r, t in zip(rows, target):
        groups.setdefault(tuple(sorted(r.items())), []).append(float(t))
    x = np.zeros((len(groups), width + 1), np.float32)
    x[:, width] = 1
    for i, r in enumerate(groups):
        for k, v in r:
            x[i, k] = v
    n = np.array([len(t) for t in groups.values()]) / len(rows)
    target = np.array([np.mean(t) for t in groups.values()])
    step = 4 / max(float((x * x).sum(axis=1).max()), 1e-9)
    b = last = np.zeros(width + 1)
    for t in range(1, steps + 1):
        ahead = b + (t - 1) / (t + 2) * (b - last)
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        grad = x.T @ (n * (p - target)) + ridge * np.append(ahead[:-1], 0)
        last, b = b, ahead - step * grad
    return b


class Model:
    """The linear classifier: weights of keys and of each lexicon's matches
    (one, two, and up to six different words)."""

    def __init__(self, lexicons: Lexicons, weights: dict[str, float], bias: float):
        self.lexicons, self.weights, self.bias = lexicons, weights, bias

    @staticmethod
    def features(lexicons: Lexicons, text: str) -> dict[str, float]:
        words = words_of(text)
        out: dict[str, float] = {}
        for name, m in zip(("i", "w", *map(str, LENGTHS)), lexicons.matches(words)):
            if m:
                out |= {f"some {name}": 1.0, f"many {name}": min(len(m), 6) / 2}
                if len(m) > 1:
                    out[f"two {name}"] = 1.0
                out |= {("w:" + w if name in "iw" else f"{name}:" + w[:int(name)]): 1.0 for w in m}
        return out

    def score(self, text: str) -> float:
        logit = self.bias + sum(self.weights.get(k, 0.0) * v for k, v in self.features(self.lexicons, text).items())
        return float(1 / (1 + np.exp(-min(max(logit, -30.0), 30.0))))


def _keys(batches):
    for batch in batches:
        counts: Counter = Counter()
        for label, t in zip(batch.column("label").to_pylist(), texts(batch)):
            counts.update((k, int(label)) for k in keys_of(words_of(t)))
        yield pa.RecordBatch.from_pydict(
            {"key": [k for k, _ in counts], "label": [v for _, v in counts], "n": list(counts.values())},
            pa.schema([("key", pa.string()), ("label", pa.int32()), ("n", pa.int64())]))


def lexicon_keys(sample: DataFrame) -> list[str]:
    """The keys that occur almost only in toxic documents, by kind."""
    counts = stored(sample.mapInArrow(_keys, "key string, label int, n long").groupBy("key")
              .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum("n").alias("n"))
              .where((F.col("toxic") >= LEAST_TOXIC) & (F.col("toxic") >= PURITY * F.col("n"))), "keys")
    out = []
    for kind in ("w", *map(str, LENGTHS)):
        top = counts.where(F.col("key").startswith(kind + ":")).orderBy(F.desc("toxic"), "n", "key")
        out += [r["key"] for r in top.limit(KEYS_PER_KIND).collect()]
    return out


def learn(documents: DataFrame, labels: DataFrame, train, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Lexicons from the labelled sample, the label model from the votes on
    all documents, the classifier from the sample's posterior labels."""
    sample = labelled_sample(documents, labels, label, train, rows).select("doc_id", "label", "text").persist()
    lexicons = Lexicons(lexicon_keys(sample))
    shared = documents.sparkSession.sparkContext.broadcast(lexicons)

    def count_votes(batches):
        counts: Counter = Counter()
        for batch in batches:
            counts.update(map(shared.value.votes, texts(batch)))
        yield pa.RecordBatch.from_pydict({"votes": list(counts), "n": list(counts.values())},
                                         pa.schema([("votes", pa.list_(pa.int32())), ("n", pa.int64())]))

    def sample_rows(batches):
        for batch in batches:
            found = [Model.features(shared.value, t) for t in texts(batch)]
            yield pa.RecordBatch.from_pydict(
                {"keys": [list(f) for f in found], "values": [list(f.values()) for f in found],
                 "label": batch.column("label").to_pylist(), "votes": [list(shared.value.votes(t)) for t in texts(batch)]},
                pa.schema([("keys", pa.list_(pa.string())), ("values", pa.list_(pa.float64())),
                           ("label", pa.int32()), ("votes", pa.list_(pa.int32()))]))

    patterns = (documents.select("text").mapInArrow(count_votes, "votes array<int>, n long")
                .groupBy("votes").agg(F.sum("n").alias("n")).collect())  # one row per vote pattern
    got = sample.mapInArrow(sample_rows, "keys array<string>, values array<double>, label int, votes array<int>").collect()
    sample.unpersist()
    if not patterns:
        return Model(lexicons, {"many i": 2.0}, -2.0)
    seen = {tuple(r["votes"]): [] for r in got}
    for r in got:
        seen[tuple(r["votes"])].append(r["label"])
    majority = {tuple(r["votes"]): sum(v == 1 for v in r["votes"]) / max(1, sum(v >= 0 for v in r["votes"]))
                for r in patterns}
    start = np.array([float(np.mean(seen[p])) if seen.get(p) else m for p, m in majority.items()])
    model = LabelModel([(tuple(r["votes"]), r["n"]) for r in patterns], start)
    if not got:
        return Model(lexicons, {"many i": 2.0}, -2.0)
    got.sort(key=lambda r: (r["votes"], r["keys"]))
    number = {k: i for i, k in enumerate(sorted({k for r in got for k in r["keys"]}))}
    target = model.posterior(np.array([r["votes"] for r in got], np.int8))
    b = fit_linear([{number[k]: v for k, v in zip(r["keys"], r["values"])} for r in got], target, len(number))
    return Model(lexicons, {k: float(b[i]) for k, i in number.items()}, float(b[-1]))


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` with score (likelihood of toxic) and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(batch):
            scores = [shared.value.score(t) for t in texts(batch, text_col)]
            return [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
        return work

    return with_computed(docs, "score double, predicted int", make)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: the documents that are not predicted toxic."""
    scored = score_toxicity(docs, learn(docs, labels, fold("doc_id", 3) != 1))
    return scored.where("predicted = 0").drop("score", "predicted")
