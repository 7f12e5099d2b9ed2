"""Repeated passages by distributed difference-cover sorting.

A string of ``width`` bytes that starts at two places, of one text or of two,
is repeated; every byte covered by such a string goes. The suffixes that can
start one are sorted by names, not by their bytes:

1. Sampled places, those whose offset lies in a difference cover modulo
   ``v``, get the name of the ``length`` bytes that start there. Two equal
   strings of ``width = length + v - 1`` bytes have, wherever they start,
   sampled places at the same distance below ``v`` from their starts. So a
   sampled name that no other sampled place has is unique, and a start with
   only unique names ahead is settled.
2. What is left recurses with a smaller ``v`` (``COVERS``): a name of the
   next level is the triple of the names of three places a level below.
3. The last level merges all remaining starts, sampled or not, by the triple
   that spans ``width`` bytes; equal neighbours in the order are repeated.

Each level is a sort by name over hash ranges (buckets). Chunks of texts send
every name of theirs once with a mark whether they hold it twice, and get one
bit per name back; so a passage in a third of all texts is one entry a chunk.
Names of the first levels are 64 bits and only sift; those of the last level
have 96 bits, so that even 10**13 remaining starts give fewer than 0.001
expected false matches.

Equal texts are sorted as one; all their bytes go if they have ``width``.
Texts above ``PIECE`` bytes are sorted in overlapping pieces.

Defined cases: a null text is empty; texts shorter than ``width`` and empty
tables keep everything; repeated rows are equal texts; other columns pass
through, those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, quoted, slices, stored

WIDTH = 400
#: Orders of the planes that give the covers: v = q * q + q + 1, q + 1 places.
COVERS = (17, 11)
CHUNK, PIECE = 2_000_000, 4_000_000
BUCKET, MAX_BUCKETS = 500_000, 20_000
SEEN = 200_000
FAMILIES = ((0x9E3779B97F4A7C15, 1), (0xC2B2AE3D27D4EB4F, 2))
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93))
CHUNKS = ("chunk long, fps array<binary>, copies array<long>, offsets array<long>, owned array<long>, sizes array<long>, "
          "starts array<long>, ends array<long>, n_open long, blob binary")
FOUND = "fp binary, n_removed long, starts array<long>, ends array<long>, kept_sha256 string"


@cache
def cover(q: int) -> tuple[int, tuple[int, ...]]:
    """(v, places): for a prime ``q`` the points of a line in the projective
    plane of order q, as powers of a generator of the cubic field extension.
    Every difference modulo v occurs between two places."""
    v = q * q + q + 1
    for a, b, c in itertools.product(range(q), range(q), range(1, q)):
        x, places = (1, 0, 0), []
        for k in range(v):
            if x[2] == 0:
                places.append(k)
            x = (c * x[2] % q, (x[0] + b * x[2]) % q, (x[1] + a * x[2]) % q)
        if len(places) == q + 1 and len({(i - j) % v for i in places for j in places}) == v:
            return v, tuple(places)
    raise ValueError(f"no difference cover of order {q}")


def lengths(width: int, covers=COVERS) -> list[int]:
    """Bytes under the names of each level."""
    return [width - cover(q)[0] + 1 for q in covers] + [width]


@cache
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k = 1
    while k < n:
        out[k:2 * k] = out[:min(k, n - k)] * np.uint64(pow(base, k, 1 << 64))
        k *= 2
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


class Names:
    """Names of the strings that start at places of a text, one family."""

    def __init__(self, text: np.ndarray, family: int, spans: list[int]):
        base, seed = FAMILIES[family]
        size = 1 << max(16, len(text).bit_length())
        table = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(table[text] * _powers(base, size)[:len(text)], out=self.sums[1:])
        self.back, self.spans = _powers(pow(base, -1, 1 << 64), size), spans

    def at(self, places: np.ndarray, level: int) -> np.ndarray:
        if level == 0:
            n = self.spans[0]
            return _mixed((self.sums[places + n] - self.sums[places]) * self.back[places])
        rest = self.spans[level] - self.spans[level - 1]
        x = self.at(places, level - 1)
        for ahead in (rest // 2, rest):
            x = _mixed(x * MIX[2] + self.at(places + ahead, level - 1))
        return x


class Chunk:
    """Pieces of texts one after the other; ``open`` marks the starts that
    may be repeated."""

    def __init__(self, row: dict):
        self.id, self.fps, self.copies = row["chunk"], row["fps"], row["copies"]
        self.offsets, self.owned, self.sizes = (np.array(row[c], np.int64) for c in ("offsets", "owned", "sizes"))
        raw = zstandard.ZstdDecompressor().decompress(row["blob"])
        self.text = np.frombuffer(raw, np.uint8)
        self.first = np.cumsum(self.sizes) - self.sizes
        edge = np.zeros(len(raw) + 1, np.int8)
        edge[np.array(row["starts"], np.int64)] = 1
        edge[np.array(row["ends"], np.int64)] = -1
        self.open = np.cumsum(edge[:-1], dtype=np.int8).view(bool)

    def places(self, level: int, covers, width: int) -> np.ndarray:
        """The places whose names decide at this level."""
        if level == len(covers):
            return np.flatnonzero(self.open)
        v, residues = cover(covers[level])
        sampled = np.zeros(v, bool)
        sampled[list(residues)] = True
        first = np.repeat(self.first, self.sizes)
        at = np.arange(len(self.text))
        here = np.flatnonzero(sampled[(at - first + np.repeat(self.offsets, self.sizes)) % v])
        opened = np.concatenate([[0], np.cumsum(self.open)])
        ahead = opened[here + 1] - opened[np.maximum(first[here], here - v + 1)] > 0
        fits = here + (width - v + 1) <= first[here] + np.repeat(self.sizes, self.sizes)[here]
        return here[ahead & fits]

    def keep(self, repeated: np.ndarray, level: int, covers) -> None:
        """Close the starts without a repeated name ahead."""
        marked = np.zeros(len(self.text), bool)
        marked[repeated] = True
        if level < len(covers):
            v = cover(covers[level])[0]
            n = np.concatenate([[0], np.cumsum(marked)])
            last = np.minimum(np.arange(len(self.text)) + v, np.repeat(self.first + self.sizes, self.sizes))
            marked = n[last] - n[:-1] > 0
        self.open = self.open & marked

    def intervals(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs of open starts; none spans two pieces, whose last bytes start
        no string."""
        edge = np.diff(np.concatenate([[0], self.open.view(np.int8), [0]]))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def row(self) -> dict | None:
        """What is left of the chunk: pieces with an open start."""
        n = np.add.reduceat(self.open, self.first, dtype=np.int64)
        kept = np.flatnonzero(n > 0)
        if not len(kept):
            return None
        inside = np.repeat(n > 0, self.sizes)
        self.open, self.text, self.sizes = self.open[inside], self.text[inside], self.sizes[kept]
        self.first = np.cumsum(self.sizes) - self.sizes
        starts, ends = self.intervals()
        return {"chunk": self.id, "fps": [self.fps[k] for k in kept], "copies": [self.copies[k] for k in kept],
                "offsets": self.offsets[kept].tolist(), "owned": self.owned[kept].tolist(), "sizes": self.sizes.tolist(),
                "starts": starts, "ends": ends, "n_open": int(n.sum()),
                "blob": zstandard.ZstdCompressor(level=1).compress(self.text.tobytes())}


ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(),
         "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def _rows(schema: str):
    """The function from rows to a record batch of a flat DDL schema."""
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    arrow = pa.schema([(name, ARROW[kind]) for name, kind in fields])
    return lambda rows: pa.RecordBatch.from_pylist(rows, schema=arrow)


def _packed(df: DataFrame, width: int) -> DataFrame:
    """Chunks of distinct texts of at least ``width`` bytes."""
    def once(batches):
        out = _rows("fp binary, copies long, text binary")
        again: dict[bytes, int] = {}

        def counts():
            return out([{"fp": f, "copies": n, "text": None} for f, n in again.items() if n])
        for batch in (part for whole in batches for part in slices(whole, 200)):
            rows = []
            for fp, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if fp in again:
                    again[fp] += 1
                else:
                    again[fp] = 0
                    rows.append({"fp": fp, "copies": 1, "text": text})
            yield out(rows)
            if len(again) >= SEEN:
                yield counts()
                again.clear()
        yield counts()

    def pack(batches):
        out, part = _rows(CHUNKS), TaskContext.get().partitionId() << 32
        held, size, numbers = [], 0, itertools.count(part)
        fp, copies, text = None, 0, None

        def pieces():
            for at in range(0, max(1, len(text) - width + 1), PIECE):
                yield {"fp": fp, "copies": copies, "offset": at, "text": text[at:at + PIECE + width - 1]}

        def chunk():
            sizes = np.array([len(p["text"]) for p in held])
            first = np.cumsum(sizes) - sizes
            starts = sizes - width + 1
            return out([{"chunk": next(numbers), "fps": [p["fp"] for p in held], "copies": [p["copies"] for p in held],
                         "offsets": [p["offset"] for p in held], "owned": starts, "sizes": sizes,
                         "starts": first, "ends": first + starts, "n_open": int(starts.sum()),
                         "blob": zstandard.ZstdCompressor(level=1).compress(b"".join(p["text"] for p in held))}])

        for batch in itertools.chain((part for whole in batches for part in slices(whole, 100)), [None]):
            rows = zip(*(batch.column(c).to_pylist() for c in range(3))) if batch is not None else [(None, 0, None)]
            for f, n, t in rows:
                if f == fp:
                    copies += n
                    continue
                if fp is not None:
                    for piece in pieces():
                        held.append(piece)
                        size += len(piece["text"])
                        if size >= CHUNK:
                            yield chunk()
                            held, size = [], 0
                fp, copies, text = f, n, t
        if held:
            yield chunk()

    texts = df.where(F.length("text") >= width).mapInArrow(once, "fp binary, copies long, text binary")
    return texts.repartition("fp").sortWithinPartitions("fp", F.col("text").isNull()).mapInArrow(pack, CHUNKS)


def _chunk_names(chunk: Chunk, level: int, covers, width: int):
    """(places, order, runs, hi, lo): the names of a chunk's places in
    ascending order; ``runs`` are the starts of equal ones."""
    places = chunk.places(level, covers, width)
    spans = lengths(width, covers)
    hi = Names(chunk.text, 0, spans).at(places, level)
    lo = (Names(chunk.text, 1, spans).at(places, level) if level == len(covers) else hi).astype(np.uint32)
    order = _name_order(hi, lo)
    hi, lo = hi[order], lo[order]
    return places, order, _runs(hi, lo), hi, lo


def _name_order(hi, lo):
    order = np.argsort(hi, kind="stable")
    h, low = hi[order], lo[order]
    if ((h[1:] == h[:-1]) & (low[1:] != low[:-1])).any():
        order = np.lexsort((lo, hi))
    return order


def _runs(hi, lo):
    return np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])) if len(hi) else np.empty(0, np.int64)


def _bucket_of(hi, buckets: int):
    return ((hi >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _planes(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def _from_planes(raw: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _bits(x) -> bytes:
    return np.packbits(x).tobytes()


def _from_bits(raw: bytes, n: int):
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).view(bool)


def _repeated_names(chunks: DataFrame, level: int, buckets: int, covers, width: int) -> DataFrame:
    """(chunk, bucket, bits): which of a chunk's names in a bucket, in
    ascending order, are held twice over all chunks."""
    last = level == len(covers)
    packet = "bucket int, chunk long, n int, names binary, low binary, twice binary"

    def send(batches):
        out = _rows(packet)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            chunk = Chunk(batch.to_pylist()[0])
            _, order, runs, hi, lo = _chunk_names(chunk, level, covers, width)
            if not len(runs):
                continue
            twice = np.diff(np.append(runs, len(order))) > 1
            hi, lo = hi[runs], lo[runs]
            bucket = _bucket_of(hi, buckets)
            cut = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(hi))
            yield out([{"bucket": int(bucket[a]), "chunk": chunk.id, "n": int(b - a),
                        "names": _planes(np.diff(hi[a:b], prepend=np.uint64(0))), "low": _planes(lo[a:b]) if last else b"",
                        "twice": _bits(twice[a:b])} for a, b in zip(cut[:-1], cut[1:])])

    def decide(batches):
        out = _rows("chunk long, bucket int, bits binary")

        def answer(held):
            n = [h["n"] for h in held]
            hi = np.concatenate([np.cumsum(_from_planes(h["names"], np.uint64), dtype=np.uint64) for h in held])
            lo = np.concatenate([_from_planes(h["low"], np.uint32) for h in held]) if last else hi.astype(np.uint32)
            weight = np.concatenate([_from_bits(h["twice"], h["n"]) for h in held]).astype(np.int64) + 1
            order = _name_order(hi, lo)
            runs = _runs(hi[order], lo[order])
            total = np.add.reduceat(weight[order], runs)
            more = np.empty(len(hi), bool)
            more[order] = np.repeat(total > 1, np.diff(np.append(runs, len(hi))))
            return out([{"chunk": h["chunk"], "bucket": h["bucket"], "bits": _bits(x)}
                        for h, x in zip(held, np.split(more, np.cumsum(n)[:-1])) if x.any()])

        held: list = []
        for batch in (part for whole in batches for part in slices(whole, 50)):
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield answer(held)
                    held = []
                held.append(row)
        if held:
            yield answer(held)

    packets = chunks.mapInArrow(send, packet)
    return packets.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(decide, "chunk long, bucket int, bits binary")


def _with_answers(chunks: DataFrame, answers: DataFrame, level: int, buckets: int, covers, width: int, finish, schema: str) -> DataFrame:
    """Every chunk with its answers: ``finish(chunk)`` gives its rows."""
    def settle(batches):
        out, chunk, bits = _rows(schema), None, {}

        def settled():
            places, order, runs, hi, _ = _chunk_names(chunk, level, covers, width)
            bucket = _bucket_of(hi[runs], buckets)
            repeated = np.zeros(len(runs), bool)
            for b, raw in bits.items():
                a, z = np.searchsorted(bucket, [np.uint64(b), np.uint64(b + 1)])
                repeated[a:z] = _from_bits(raw, z - a)
            chunk.keep(places[order[np.repeat(repeated, np.diff(np.append(runs, len(order))))]], level, covers)
            return out(list(finish(chunk)))

        for batch in (part for whole in batches for part in slices(whole, 1)):
            row = batch.to_pylist()[0]
            if row["blob"] is None:
                if chunk is not None and row["chunk"] == chunk.id:
                    bits[row["bucket"]] = row["bits"]
                continue
            if chunk is not None and bits:
                yield settled()
            chunk, bits = Chunk(row), {}
        if chunk is not None and bits:
            yield settled()

    both = chunks.unionByName(answers, allowMissingColumns=True)
    return both.repartition("chunk").sortWithinPartitions("chunk", F.col("blob").isNull(), "bucket").mapInArrow(settle, schema)


def _next_chunk(chunk: Chunk):
    row = chunk.row()
    return [row] if row else []


def _covered(starts, ends, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of bytes covered by strings that start in [start, end)."""
    if not len(starts):
        return starts, ends
    ends = ends + width - 1
    new = np.concatenate([[True], starts[1:] > np.maximum.accumulate(ends)[:-1]])
    at = np.flatnonzero(new)
    return starts[at], np.maximum.reduceat(ends, at)


def _result(fp: bytes, text: bytes, starts, ends) -> dict:
    kept, at = hashlib.sha256(), 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        kept.update(text[at:a])
        at = b
    kept.update(text[at:])
    return {"fp": fp, "n_removed": int((ends - starts).sum()), "starts": starts, "ends": ends, "kept_sha256": kept.hexdigest()}


PIECES = FOUND + ", offset long, text binary"


def _results(width: int):
    """Rows of ``FOUND`` for texts of one piece; pieces of longer texts with
    their starts and own bytes, to be joined."""
    def rows(chunk: Chunk):
        starts, ends = chunk.intervals()
        for k, first in enumerate(chunk.first.tolist()):
            if chunk.copies[k] > 1:
                continue
            end = first + int(chunk.sizes[k])
            a, z = np.searchsorted(starts, [first, end])
            s, e, offset = starts[a:z] - first, ends[a:z] - first, int(chunk.offsets[k])
            text = chunk.text[first:end].tobytes()
            if offset == 0 and chunk.owned[k] < PIECE:
                if len(s):
                    yield _result(chunk.fps[k], text, *_covered(s, e, width)) | {"offset": None, "text": None}
            else:
                yield {"fp": chunk.fps[k], "n_removed": None, "starts": s + offset, "ends": e + offset, "kept_sha256": None,
                       "offset": offset, "text": text}
    return rows


def repeated_spans(texts: DataFrame, width: int = WIDTH, covers=COVERS) -> DataFrame:
    """``FOUND`` rows for the distinct texts of (fp, text) that lose bytes:
    covered byte ranges and the SHA-256 of what stays."""
    chunks = stored(_packed(texts, width), "chunks-0")
    twins = chunks.select(F.explode(F.arrays_zip("fps", "copies")).alias("d")).where("d.copies > 1").select("d.fps").distinct()
    first, found = chunks, None
    for level in range(len(covers) + 1):
        n = chunks.agg(F.sum("n_open")).first()[0] or 0
        share = (covers[level] + 1) / cover(covers[level])[0] if level < len(covers) else 1
        buckets = min(MAX_BUCKETS, math.ceil(n * share / BUCKET) or 1)
        answers = stored(_repeated_names(chunks, level, buckets, covers, width), f"answers-{level}")
        if level < len(covers):
            smaller = stored(_with_answers(chunks, answers, level, buckets, covers, width, _next_chunk, CHUNKS), f"chunks-{level + 1}")
            discard(answers, *([chunks] if chunks is not first else []))
            chunks = smaller
        else:
            found = stored(_with_answers(chunks, answers, level, buckets, covers, width, _results(width), PIECES), "found")
            discard(answers, chunks)
    whole = found.where("offset is null").select("fp", "n_removed", "starts", "ends", "kept_sha256")
    gone = twins.select(F.col("fps").alias("fp"), F.lit(None).cast("long").alias("n_removed"), F.lit(None).cast("array<long>").alias("starts"),
                        F.lit(None).cast("array<long>").alias("ends"), F.sha2(F.lit(b""), 256).alias("kept_sha256"))
    return whole.unionByName(_long_texts(found, first, width)).unionByName(gone)


def _long_texts(found: DataFrame, chunks: DataFrame, width: int) -> DataFrame:
    """Results of texts of several pieces, put together in their order."""
    def missing(batches):
        out = _rows(PIECES)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            chunk = Chunk(batch.to_pylist()[0])
            for k, first in enumerate(chunk.first.tolist()):
                if chunk.copies[k] == 1 and (chunk.offsets[k] > 0 or chunk.owned[k] >= PIECE):
                    yield out([{"fp": chunk.fps[k], "n_removed": None, "starts": [], "ends": [], "kept_sha256": None,
                                "offset": int(chunk.offsets[k]), "text": chunk.text[first:first + int(chunk.sizes[k])].tobytes()}])

    def join(batches):
        out, state = _rows(FOUND), None

        def done():
            return [] if state is None or not state["ends"] else \
                [out([_result(state["fp"], b"".join(state["text"]), *_covered(*(np.concatenate(state[c]) for c in ("starts", "ends")), width))])]

        for batch in (part for whole in batches for part in slices(whole, 1)):
            row = batch.to_pylist()[0]
            if state is None or state["fp"] != row["fp"]:
                yield from done()
                state = {"fp": row["fp"], "text": [], "size": 0, "starts": [], "ends": []}
            if row["starts"]:
                state["starts"].append(np.array(row["starts"]))
                state["ends"].append(np.array(row["ends"]))
            state["text"].append(row["text"][state["size"] - row["offset"]:])
            state["size"] = row["offset"] + len(row["text"])
        yield from done()

    long_ = chunks.where(F.exists("owned", lambda x: x >= PIECE)).mapInArrow(missing, PIECES)
    pieces = found.where("offset is not null").unionByName(long_)
    return pieces.repartition("fp").sortWithinPartitions("fp", "offset").mapInArrow(join, FOUND)


def remove_repeated(docs: DataFrame, text_col: str = "text", width: int = WIDTH, covers=COVERS) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, the byte ranges removed
    (``spans``) and kept_sha256."""
    raw = F.coalesce(F.col(quoted(text_col)).cast("binary"), F.lit(b""))
    fp = F.unhex(F.sha2(raw, 256))
    found = repeated_spans(docs.select(fp.alias("fp"), raw.alias("text")), width, covers)
    names = {"n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"}
    own = [c for c in docs.columns if c.lower() not in names]
    left = docs.select(F.struct(*[F.col(quoted(c)) for c in own]).alias("row"), fp.alias("fp"), F.octet_length(raw).cast("long").alias("n_bytes"))
    out = left.join(found, "fp", "left")
    gone = F.col("found_sha").isNotNull() & F.col("starts").isNull()
    lists = F.when(gone, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))) \
        .when(F.col("starts").isNotNull(), F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end"))) \
        .otherwise(F.array().cast("array<struct<start:long,end:long>>"))
    return out.withColumnRenamed("kept_sha256", "found_sha").select(
        *[F.col(f"row.{quoted(c)}").alias(c) for c in own], "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.size(lists).cast("long").alias("n_spans"), lists.alias("spans"),
        F.coalesce("found_sha", F.lower(F.hex("fp"))).alias("kept_sha256"))
