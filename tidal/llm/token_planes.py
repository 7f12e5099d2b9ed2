"""Token ids as compressed byte or bit planes with a chunk index.

``write_token_planes`` encodes every text in ascending id order, appends the
end id to each document, cuts the id stream of each part into fixed-size
blocks, transposes a block into planes, compresses each plane with zstandard
and writes one record per block. ``read_token_planes`` streams the blocks
back, document by document.

File format: a Parquet folder ``chunks`` whose records are
``part, chunk, n_ids, plane_bytes, planes, doc_ids, doc_ids_null, doc_lengths``: the block's
planes (least significant first) and the documents that begin in it; and a
folder ``index`` with ``part, chunk, first_id, n_ids, n_docs, plane_bytes,
compressed_bytes``, where ``first_id`` counts from the start of the corpus.
Spark's committer writes both, so a task that runs twice leaves one copy.

Defined cases: a null text is empty and yields the end id alone; a null id
sorts first; repeated rows are repeated in the file; an empty table writes an
empty file; extra columns are not written.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder, slices, text_bytes

BLOCK_IDS = 1 << 16
CACHED_WORDS = 1_000_000
CHUNKS = ("part int, chunk int, n_ids long, plane_bytes array<int>, planes array<binary>, "
          "doc_ids array<long>, doc_lengths array<long>")
READ = "part int, seq long, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"


class Pieces(dict):
    """piece -> its ids; forgets all when ``most`` are known."""

    def __init__(self, encode, most: int):
        super().__init__({"": b""})
        self.encode, self.most = encode, most

    def __missing__(self, piece):
        if len(self) >= self.most:
            self.clear()
        self[piece] = ids = self.encode(piece) if piece else b""
        return ids


def splits_by_bytes(tokenizer) -> bool:
    """Whether the tokenizer is byte-level BPE with the usual pattern, without
    a prefix space, a normaliser or added tokens that match inside texts."""
    said = json.loads(tokenizer.to_str())
    pre = said.get("pre_tokenizer") or {}
    added = [t for t in said.get("added_tokens") or [] if not t.get("special")]
    return (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True) and pre.get("use_regex", True)
            and not said.get("normalizer") and not added and (said.get("model") or {}).get("type", "BPE") == "BPE")


class WordCache:
    """Encodes a text by its pieces and remembers the pieces' ids.

    Byte-level BPE never joins what stands on both sides of these places, so
    the pieces' ids, one after the other, are the ids of the whole text:
    before a space between two non-spaces (GAP); between a letter and
    punctuation or a line end, and between a single line end and a letter
    (SEAM). Texts whose letters, marks and spaces never stand in a doubtful
    order (DOUBTFUL) are cut before every space, comma, stop and line end
    by replacement, which is the same and faster. A word of letters goes to
    the library's BPE model directly. All this holds for a byte-level
    tokenizer that splits by its usual pattern and normalises nothing; with
    any other one, texts are encoded whole."""

    GAP = re.compile(r"(?<=\S) (?=\S)")
    LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
    SEAM = re.compile(rf"(?<=[{LETTER}])(?=[!-/:-@\[-`{{-~\n])|(?<=\S\n)(?=[{LETTER}])")
    WORD = re.compile(rf" ?[{LETTER}]+")
    # the byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on
    PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
    ALPHABET = {b: b for b in PLAIN} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(PLAIN)))}

    CLASSES = bytes(32 if b == 32 else 10 if b == 10 else 116 if b < 33 or b == 127 else
                    97 if chr(b).isalnum() or b >= 128 else 112 for b in range(256))
    DOUBTFUL = (b"t", b"pp", b" p", b"  ", b"\n\n", b" \n", b"\n ")
    ASCII = bytes(range(128))
    BEYOND = re.compile(rf"[{LETTER}]*")

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.by_pieces = splits_by_bytes(tokenizer)
        self.whole = [t.content for t in tokenizer.get_added_tokens_decoder().values()]  # texts that name one aren't cut
        self.pieces = Pieces(self._encode, CACHED_WORDS)

    def _encode(self, piece: str) -> bytes:
        if self.WORD.fullmatch(piece):
            mapped = piece.encode().decode("latin-1").translate(self.ALPHABET)
            return np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain_order(self, raw: bytes) -> bool:
        classes = raw.translate(self.CLASSES)
        return (not any(d in classes for d in self.DOUBTFUL)
                and (raw.isascii() or bool(self.BEYOND.fullmatch(raw.translate(None, self.ASCII).decode()))))

    def ids(self, text: str) -> bytes:
        if not self.by_pieces or any(t in text for t in self.whole):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        raw = text.encode("utf-8", "replace")
        if self._plain_order(raw):
            for mark in " ,.\n":
                text = text.replace(mark, "\0" + mark)
            return b"".join(map(self.pieces.__getitem__, text.split("\0")))
        head, *rest = self.GAP.split(text)
        return b"".join(map(self.pieces.__getitem__,
                            (x for p in (head, *map(" ".__add__, rest)) for x in self.SEAM.split(p))))


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The block's four byte planes, or its 32 bit planes."""
    by_byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if not bits:
        return [p.tobytes() for p in by_byte]
    return [np.packbits((p >> k) & 1).tobytes() for p in by_byte for k in range(8)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 32:
        flat = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes]
        rows = [sum((flat[8 * b + k] << k for k in range(8)), np.zeros(n, np.uint8)) for b in range(4)]
    else:
        rows = [np.frombuffer(p, np.uint8) for p in planes]
    return np.ascontiguousarray(np.stack(rows).T).reshape(-1).view("<u4")


def write_token_planes(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, block: int = BLOCK_IDS,
                       bits: bool = False, level: int = 3, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` with the tokenizers file ``tokenizer`` (present on
    every machine) and write chunks and index under ``folder``."""
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # the hash and the number spread rows of one id (or without id) over several ranges
    order = (F.col("doc_id").asc_nulls_first(), "h", "k")
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .withColumn("h", F.xxhash64("text")).withColumn("k", F.monotonically_increasing_id())
               .repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text"))

    def encode(batches):
        import zstandard
        from tokenizers import Tokenizer
        cache, squeeze = WordCache(Tokenizer.from_file(tokenizer)), zstandard.ZstdCompressor(level=level).compress
        part, chunk, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        stream, begun, lengths = bytearray(), [], []

        def record(n: int):
            nonlocal chunk
            planes = [squeeze(p) for p in to_planes(np.frombuffer(bytes(stream[:4 * n]), "<u4"), bits)]
            del stream[:4 * n]
            out = {"part": part, "chunk": chunk, "n_ids": n, "plane_bytes": [len(p) for p in planes],
                   "planes": planes, "doc_ids": begun[:], "doc_lengths": lengths[:]}
            begun.clear()
            lengths.clear()
            chunk += 1
            return out

        for batch in batches:
            rows = []
            for i, t in held_rows(batch):
                ids = cache.ids(t.decode("utf-8", "replace")) + end
                begun.append(i)
                lengths.append(len(ids) // 4)
                stream += ids
                while len(stream) >= 4 * block:
                    rows.append(record(block))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)
        if stream:
            yield pa.RecordBatch.from_pylist([record(len(stream) // 4)], SCHEMA)

    ordered.mapInArrow(encode, CHUNKS).write.option("compression", "none").parquet(f"{folder}/chunks")
    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")
    sizes = chunks.select("part", "chunk", "n_ids", F.size("doc_ids").cast("long").alias("n_docs"), "plane_bytes")
    ends = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    index = (sizes.join(part_offsets(chunks), "part")
             .withColumn("first_id", F.col("before") + F.coalesce(F.sum("n_ids").over(ends), F.lit(0)))
             .withColumn("compressed_bytes", F.expr("aggregate(plane_bytes, 0L, (a, x) -> a + x)"))
             .select("part", "chunk", "first_id", "n_ids", "n_docs", "plane_bytes", "compressed_bytes"))
    index.write.parquet(f"{folder}/index")


def held_rows(batch: pa.RecordBatch):
    """(id, UTF-8 text) row by row; only the texts of a slice are copied at a time."""
    for part in slices(batch):
        yield from zip(part.column(0).to_pylist(), text_bytes(part))


SCHEMA = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()),
                    ("plane_bytes", pa.list_(pa.int32())), ("planes", pa.list_(pa.binary())),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64()))])


def part_offsets(chunks: DataFrame) -> DataFrame:
    """Ids before each part: one row per part, so one task can sum them."""
    sums = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def read_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, decoded from the planes: doc_id, start, n_tokens
    and the crc32 of its ids as little-endian unsigned 32-bit integers. The
    blocks of a part stream through one task in order, a block at a time."""
    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")
    starts = (spark.read.parquet(f"{folder}/index").where("chunk = 0")
              .select(F.col("part").alias("at"), F.col("first_id").alias("before")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def decode(batches):
        import zstandard
        expand = zstandard.ZstdDecompressor().decompress
        now, state = None, None
        for batch in batches:
            out = {k: [] for k in ("part", "seq", "doc_id", "start_in_part", "n_tokens", "ids_crc32")}
            for r in batch.to_pylist():
                if r["part"] != now:
                    now, state = r["part"], {"open": deque(), "left": 0, "crc": 0, "seq": 0, "at": 0}
                data = from_planes([expand(p) for p in r["planes"]], r["n_ids"]).tobytes()
                state["open"] += zip(r["doc_ids"], r["doc_lengths"])
                at = 0
                while at < len(data):
                    if not state["left"]:
                        state["doc"] = state["open"].popleft()
                        state["left"], state["crc"] = 4 * state["doc"][1], 0
                    take = min(state["left"], len(data) - at)
                    state["crc"] = zlib.crc32(data[at:at + take], state["crc"])
                    state["left"] -= take
                    at += take
                    if not state["left"]:
                        for k, v in zip(out, (now, state["seq"], state["doc"][0], state["at"], state["doc"][1], state["crc"])):
                            out[k].append(v)
                        state["seq"] += 1
                        state["at"] += state["doc"][1]
            yield pa.RecordBatch.from_pydict(out, READ_SCHEMA)

    rows = (chunks.repartition(parts, "part").sortWithinPartitions("part", "chunk").mapInArrow(decode, READ))
    return (rows.join(F.broadcast(starts), rows["part"] == starts["at"])  # one row per part
            .select("doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"))


READ_SCHEMA = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()),
                         ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def token_planes(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write ``docs`` into a fresh shared folder and read the result back."""
    folder = shared_folder(docs.sparkSession, "token-planes")
    write_token_planes(docs, folder, tokenizer, **options)
    return read_token_planes(docs.sparkSession, folder)
