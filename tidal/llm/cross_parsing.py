"""Language identification by cross-parsing entropy.

A suffix automaton is built over the same amount of training text of every
language. A document is parsed greedily against each: the longest match from
the current place is one phrase (a symbol that the language lacks belongs to
the phrase that follows it). The fewer phrases a language needs per
letter, the closer it is; the fewest win (ties: code point order).

Texts are lower-cased and every run of non-letters becomes one space. Texts
are parsed whole, in segments of ``SEGMENT`` symbols (a phrase ends with its
segment), so that one array step advances all segments of a batch at once.

The fit reads at most ``DOCS_PER_LANGUAGE`` labelled documents of each
language and ``CHARS_PER_LANGUAGE`` letters (fewer when languages are many,
``TOTAL_CHARS``); these bound the broadcast. Every character of the samples
has its symbol: the commonest have a column each in a dense transition table,
all others are looked up in a sorted list of transitions.

Defined cases: null texts and texts without a letter are ``und`` with score
0; so is everything when no labelled text exists; null languages are never
learned; repeated rows get equal results; extra columns pass through, those
named like a result are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import texts, with_computed

SEGMENT = 1024
DOCS_PER_LANGUAGE = 80
CHARS_PER_LANGUAGE = 48_000
TOTAL_CHARS = 1_000_000
#: Symbols with a column in the dense table; the others' transitions are a list.
DENSE = 255
SALTS = 32
UNDETERMINED = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    return NOT_LETTERS.sub(" ", text.lower()).strip()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def suffix_transitions(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of one symbol sequence."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                new = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[cur] = new
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = new
                    p = link[p]
        last = cur
    return nxt


class CrossParser:
    """Counts phrases of many texts against all languages at once."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        counts: dict[str, int] = {}
        for s in samples.values():
            for ch in s:
                counts[ch] = counts.get(ch, 0) + 1
        known = sorted(counts, key=lambda ch: (-counts[ch], ch))
        self.width = min(len(known), DENSE) + 1  # symbol 0: a character of no sample
        self.symbols = len(known) + 1
        self.symbol = np.zeros(0x110000, np.uint16 if self.symbols <= 1 << 16 else np.uint32)
        for k, ch in enumerate(known, 1):
            self.symbol[ord(ch)] = k
        tables, roots, rare, at = [], [], [], 0
        for lang in self.languages:
            nxt = suffix_transitions(self.encode(samples[lang]).tolist())
            t = np.full((len(nxt), self.width), -1, np.int32)
            for s, row in enumerate(nxt):
                for c, to in row.items():
                    if 0 < c < self.width:
                        t[s, c] = (at + to) * self.width
                    elif c:
                        rare.append(((at + s) * self.width * self.symbols + c, (at + to) * self.width))
            tables.append(t)
            roots.append(at * self.width)
            at += len(nxt)
        self.table = np.concatenate(tables).reshape(-1)
        rare.sort()
        self.rare_keys = np.array([k for k, _ in rare], np.int64)
        self.rare_to = np.array([to for _, to in rare], np.int32)
        self.root = np.array(roots, np.int32)[:, None]
        every = np.arange(self.symbols)
        first = self._next(np.repeat(self.root, self.symbols, axis=1), every)
        self.restart = np.where(first < 0, self.root, first).astype(np.int32)  # a new phrase's first symbol
        self.bits = np.log2(max(map(len, samples.values())) + 1)

    def _next(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states after symbol ``c`` (one per column), -1 without one."""
        common = c < self.width
        to = self.table[state + np.where(common, c, 0)]
        if not common.all():
            cols = np.flatnonzero(~common)
            keys = state[:, cols].astype(np.int64) * self.symbols + c[cols]
            at = np.minimum(np.searchsorted(self.rare_keys, keys), len(self.rare_keys) - 1)
            to[:, cols] = np.where(self.rare_keys[at] == keys, self.rare_to[at], -1)
        return to

    def encode(self, s: str) -> np.ndarray:
        return self.symbol[np.frombuffer(s.encode("utf-32-le", "replace"), np.uint32)]

    def phrases(self, docs: list[str]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        coded = [self.encode(d) for d in docs]
        owner, pieces = [], []
        for i, c in enumerate(coded):
            for a in range(0, len(c), SEGMENT):
                owner.append(i)
                pieces.append(c[a:a + SEGMENT])
        out = np.zeros((len(docs), len(self.languages)), np.int64)
        order = np.argsort([-len(p) for p in pieces], kind="stable")
        for a in range(0, len(order), 8192):
            group = order[a:a + 8192]
            np.add.at(out, [owner[k] for k in group], self._parse([pieces[k] for k in group]).T)
        return out

    def _parse(self, pieces: list[np.ndarray]) -> np.ndarray:
        """``pieces`` from long to short, one array step per symbol."""
        sizes = np.array([len(p) for p in pieces])
        grid = np.zeros((sizes[0], len(pieces)), self.symbol.dtype)
        for k, p in enumerate(pieces):
            grid[:len(p), k] = p
        alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
        state = np.repeat(self.root, len(pieces), axis=1)
        count = np.ones((len(self.languages), len(pieces)), np.int64)
        for step, n in enumerate(alive):
            c = grid[step, :n]
            to = self._next(state[:, :n], c)
            dead = to < 0
            if step:
                count[:, :n] += dead
            state[:, :n] = np.where(dead, self.restart[:, c], to)
        return count


def _shortened(batches):
    """The letters of sample texts, no more than a sample takes."""
    for batch in batches:
        cut = [letters(t)[:CHARS_PER_LANGUAGE] for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cut, pa.string())], ["lang", "k", "letters"])


def learn(documents: DataFrame, train, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> CrossParser | None:
    """The parser of the labelled training rows (``train``: their condition)."""
    order = (F.xxhash64(id_col), F.col(id_col))
    ids = (documents.where(train & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(id_col).agg(F.min(lang_col).alias("lang"))  # without texts
           .withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), F.col(id_col)), F.lit(SALTS))))
    for keys in (["lang", "salt"], ["lang"]):  # first inside salted parts of a language
        ids = ids.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("k") <= DOCS_PER_LANGUAGE)
    ids = ids.select(F.col(id_col).alias("i"), "lang", "k")
    rows = (documents.select(F.col(id_col).alias("i"), F.col(text_col).alias("text"))
            .where("text is not null").join(F.broadcast(ids), "i"))
    found: dict[str, list[str]] = {}
    short = rows.select("lang", "k", "text").mapInArrow(_shortened, "lang string, k int, letters string")
    for r in short.orderBy("lang", "k", "letters").toLocalIterator():  # at most DOCS_PER_LANGUAGE ids a language
        kept = found.setdefault(r["lang"], [])
        if sum(map(len, kept)) < CHARS_PER_LANGUAGE:
            kept.append(r["letters"])
    joined = {lang: " ".join(v) for lang, v in found.items() if has_letter("".join(v))}
    if not joined:
        return None
    least = min(CHARS_PER_LANGUAGE, TOTAL_CHARS // len(joined))
    usual = min(max(len(s) for s in joined.values()), least)
    # a language with less text than the others has a smaller automaton, and so needs more phrases
    return CrossParser({lang: s[:usual] for lang, s in joined.items()})


def identify(docs: DataFrame, parser: CrossParser | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, its score (posterior when a phrase costs the
    bits of a place in the training text) and phrases per letter."""
    model = docs.sparkSession.sparkContext.broadcast(parser)

    def make():
        p = model.value

        def work(batch):
            n = batch.num_rows
            lang, score, rate = [UNDETERMINED] * n, [0.0] * n, [None] * n
            if p is not None:
                clean = [letters(t) for t in texts(batch, text_col)]
                real = [i for i in range(n) if clean[i] and has_letter(clean[i])]
                counts = p.phrases([clean[i] for i in real])
                for i, row in zip(real, counts):
                    best = int(np.argmin(row))
                    lang[i] = p.languages[best]
                    rate[i] = float(row[best]) / len(clean[i])
                    score[i] = float(1 / np.exp2(np.maximum((row[best] - row) * p.bits, -1000.0)).sum())
            return [pa.array(lang), pa.array(score, pa.float64()), pa.array(rate, pa.float64())]
        return work

    return with_computed(docs, "lang_pred string, score double, phrase_rate double", make)
