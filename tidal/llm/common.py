"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores as none of ``columns`` has."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder of
    ``spark.checkpoint.dir`` and read it back: lineage ends there, a lost
    executor costs no earlier stage, and the shuffle files of ``df`` go."""
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidal-llm/{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checked_broadcast(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A stored table of a few narrow columns, to be broadcast if it has at
    most ``rows`` rows; otherwise Spark shuffles it."""
    return F.broadcast(df) if df.count() <= rows else df


def shared_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidal-llm/{uuid.uuid4().hex}/{name}"


def fold(col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null ids: null)."""
    return F.crc32(F.col(quoted(col)).cast("string")) % modulus


def held_out(col: str, modulus: int, remainder: int):
    return F.coalesce(fold(col, modulus) == remainder, F.lit(False))


def with_computed(df: DataFrame, added: str, make: Callable[[], Callable[[pa.RecordBatch], list]]) -> DataFrame:
    """``df`` with the columns of the DDL string ``added`` appended by a
    map-only Arrow pass. ``make()`` runs once per task and returns the
    function from a record batch to the added arrays. Columns of ``df`` that
    clash with an added name are replaced; all others pass through."""
    new = T._parse_datatype_string(added)
    names = {f.name.lower() for f in new.fields}
    base = df.select(*[quoted(c) for c in df.columns if c.lower() not in names])
    schema = T.StructType([*base.schema.fields, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in (part for whole in batches for part in slices(whole, 1000)):
            work = work or make()
            yield pa.RecordBatch.from_arrays([*batch.columns, *work(batch)], [f.name for f in schema.fields])

    return base.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; null is the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's UTF-8 bytes without decoding them; null is empty."""
    arr = batch.column(batch.schema.get_field_index(column))
    return [t or b"" for t in arr.cast(pa.binary()).to_pylist()]


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, train, limit: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, label, text) of at most ``limit`` labelled training rows, taken by
    a hash of the id. ``limit`` bounds the classifier's fit and the broadcast
    of the chosen ids; ``train`` is the condition on the id column."""
    ids = (labels.where(train & F.col(label).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(id_col).agg(F.max(label).cast("int").alias("label"))
           .orderBy(F.xxhash64(id_col), id_col).limit(limit))
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return docs.join(F.broadcast(ids.withColumnRenamed(id_col, "doc_id")), "doc_id")


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batch in pieces, so that Python objects exist for a few rows only."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
