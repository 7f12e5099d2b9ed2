"""Benchmark decontamination with a generalised suffix automaton.

The automaton over the normalised words of all benchmark items is built and
broadcast; ``SLICE_BYTES`` bounds it: a larger benchmark is cut into slices by
a hash of the items, one automaton and pass over the documents each, and a
document's spans and items are merged. Each document's words stream through it and
the longest match that ends at each word is tracked: a match of at least
``window`` words, or one that ends in a whole shorter item, marks its words.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.
Spans of marked words are cut from ``clean_text``; a document whose marked
share reaches ``max_coverage`` is ``contaminated``.

Defined cases: null or empty texts have no words and are clean; null or
wordless items match nothing; an item with a null id marks words and counts as
one item, but has no id to name; items may repeat; an empty benchmark marks
nothing; repeated rows get equal results; extra columns pass through, those
named like a result are replaced.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, stored, text_bytes, unused, with_computed

WINDOW = 13
MAX_COVERAGE = 0.05
SLICE_BYTES = 8_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                 for b in range(256))
ADDED = ("n_words long, n_hit long, n_items long, item_ids array<string>, "
         "spans array<struct<start:long,end:long>>, clean_text string, contaminated boolean")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class Automaton:
    """Suffix automaton of several word sequences (word ids from 1)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        ends: dict[int, set[str]] = {}
        whole: dict[int, list[tuple[int, str]]] = {}
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            last = 0
            for c in ids:
                last = self._extend(last, c)
        for name, words in items:
            state = 0
            for k, w in enumerate(words, 1):
                state = self.next[state][self.vocabulary[w]]
                if k >= window:  # the state of the item's prefix: its window ends here
                    ends.setdefault(self._of_length(state, window), set()).add(name)
            if 0 < len(words) < window:
                whole.setdefault(self._of_length(state, len(words)), []).append((len(words), name))
        n = len(self.next)
        order = sorted(range(n), key=self.length.__getitem__)
        #: state -> state of its suffix of ``window`` words; -> the whole short items that are suffixes
        self.window_state, self.short = [-1] * n, [()] * n
        for v in order[1:]:
            p = self.link[v]
            self.window_state[v] = v if self.length[p] < window <= self.length[v] else self.window_state[p]
            own = tuple(whole.get(v, ()))
            self.short[v] = own + self.short[p] if own else self.short[p]
        self.items_of = {v: frozenset(s) for v, s in ends.items()}
        sizes = [min(len(w), window) for _, w in items if w]
        self.shortest = min(sizes, default=0)
        pairs = {(self.vocabulary[a], self.vocabulary[b]) for _, ws in items for a, b in zip(ws, ws[1:])}
        base = len(self.vocabulary) + 1
        self.base, self.pairs = base, np.array(sorted(a * base + b for a, b in pairs), np.int64)

    def _of_length(self, state: int, n: int) -> int:
        """The suffix of length ``n`` of a state's words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
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
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = new
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [start, end) word spans of all occurrences, and their items."""
        if not words or not self.shortest:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, ZEROS), np.int64, len(words))
        spans: list[list[int]] = []
        found: set[str] = set()
        for a, b in self._runs(ids):
            self._follow(ids[a:b].tolist(), a, spans, found)
        return [tuple(s) for s in spans], found

    def _runs(self, ids: np.ndarray):
        """Stretches in which every neighbouring pair stands in some item and
        that are long enough for a match; all others can't hold one."""
        if self.shortest == 1:
            linked = (ids[:-1] > 0) & (ids[1:] > 0)
        else:
            keys = ids[:-1] * self.base + ids[1:]
            if not len(self.pairs):
                return
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            linked = self.pairs[at] == keys
        breaks = np.flatnonzero(~linked) + 1
        starts, stops = np.concatenate(([0], breaks)), np.concatenate((breaks, [len(ids)]))
        for k in np.flatnonzero(stops - starts >= self.shortest):
            if ids[starts[k]]:
                yield int(starts[k]), int(stops[k])

    def _follow(self, ids: list[int], offset: int, spans: list[list[int]], found: set[str]) -> None:
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        for i, c in enumerate(ids, offset + 1):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                matched += 1
            start = i
            if matched >= self.window:
                start = i - matched
                found |= self.items_of.get(self.window_state[state], frozenset())
            for size, name in self.short[state]:
                if size <= matched:
                    start = min(start, i - size)
                    found.add(name)
            if start < i:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i])


class _Zeros:
    """An endless supply of zeros for ``map``."""

    def __iter__(self):
        return self

    def __next__(self):
        return 0


ZEROS = _Zeros()


def slices_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", limit: int | None = None) -> tuple[DataFrame, int]:
    """The distinct items as (i, t) and the number of slices they make. The
    name of an item is its id after ``=``, or empty for a null id."""
    rows = benchmark.select(F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("i"),
                            F.col(text_col).cast("binary").alias("t")).where("t is not null").distinct()
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    return rows, 1 + size // (limit or SLICE_BYTES)


def build(items: DataFrame, parts: int, part: int, window: int) -> Automaton:
    """The automaton of one slice of the items."""
    mine = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part)
    return Automaton([(r["i"], words_of(bytes(r["t"]))) for r in mine.orderBy("i", "t").toLocalIterator()], window)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(re.sub("[A-Z]", lambda m: m[0].lower(), text))]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return "".join([*out, text[last:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                  text_col: str = "text", clean: bool = True) -> DataFrame:
    """``docs`` with hit counts, items, marked word spans, the text without
    them (``clean=False``: null) and the verdict."""
    items, parts = slices_of(benchmark)
    for part in range(parts):
        docs = _with_hits(docs, build(items, parts, part, window), part > 0, part + 1 == parts, max_coverage, text_col, clean)
        if part + 1 < parts:
            docs = stored(docs, f"hits-{part}")
    return docs


def _with_hits(docs: DataFrame, automaton: Automaton, more: bool, last: bool, max_coverage: float, text_col: str, clean: bool) -> DataFrame:
    """``docs`` with what one slice marks, beside what earlier slices marked
    (``more``); ids and verdict are made after the last one."""
    model = docs.sparkSession.sparkContext.broadcast(automaton)
    earlier = unused(docs.columns, "earlier_spans", "earlier_items")
    if more:
        docs = docs.withColumnsRenamed(dict(zip(("spans", "item_ids"), earlier)))

    def make():
        automaton = model.value

        def work(batch):
            cols = [[] for _ in range(7)]
            before = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in earlier)) if more \
                else itertools.repeat(([], []))
            for raw, (old, known) in zip(text_bytes(batch, text_col), before):
                words = words_of(raw)
                spans, names = automaton.hits(words)
                if old:
                    spans = merged([*spans, *((s["start"], s["end"]) for s in old)])
                names = sorted(names.union(known))
                n_hit = sum(b - a for a, b in spans)
                cut = (cut_words(raw.decode("utf-8"), spans) if spans else raw.decode("utf-8")) if clean and last else None
                ids = [n[1:] for n in names if n] if last else names
                row = (len(words), n_hit, len(names), ids, [{"start": a, "end": b} for a, b in spans], cut,
                       n_hit > 0 and n_hit >= max_coverage * len(words) - 1e-9)
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.bool_())
            return [pa.array(c, k) for c, k in zip(cols, kinds)]
        return work

    return with_computed(docs, ADDED, make).drop(*earlier)


def cleaned(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: contaminated documents go, the marked spans of the
    others are cut from their text (and n_chars, where it is kept, follows)."""
    out = decontaminate(docs, benchmark).where("not contaminated")
    changed = F.size("spans") > 0
    result = {"text": F.when(changed, F.col("clean_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        result["n_chars"] = F.when(changed, F.length("clean_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[result.get(c, F.col(quoted(c))).alias(c) for c in docs.columns])
