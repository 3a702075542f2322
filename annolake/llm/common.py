"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
CACHE_ENTRIES = 300_000   # distinct words a task remembers; the cache only saves time
CACHE_WORD = 64           # longer words are computed anew each time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows: the rows may be whole long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Arrow batches of at most ``most`` bytes, or of one row: a batch of long texts stays as small as one of short ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now > most:
        spark.conf.set(key, str(most))


def per_worker(key: tuple, make: Callable):
    """What ``make`` gives, made once in a worker process: its later tasks find it there. (Functions travel by value,
    so their own module is a new one for each task.)"""
    held = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def with_text_columns(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]],
                      make: Callable[[], Callable[[list[bytes]], list[pa.Array]]]) -> DataFrame:
    """``df`` with ``fields`` appended, computed from the whole texts of column ``text``.

    ``make`` runs once a task and gives the function from a batch's texts to the new columns.
    """
    small_batches(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in fields]])
    added = [n for n, _ in fields]

    def run(batches: Iterable[pa.RecordBatch]):
        f = make()
        for b in batches:
            cols = f(texts_of(b, text))
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *added])

    return df.mapInArrow(run, schema)


def text_columns(df: DataFrame, text: str, fields, make) -> DataFrame:
    """As ``with_text_columns``, without the text itself in the result."""
    small_batches(df.sparkSession)
    rest = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*rest, *[T.StructField(n, t) for n, t in fields]])
    keep = [f.name for f in rest]
    added = [n for n, _ in fields]

    def run(batches: Iterable[pa.RecordBatch]):
        f = make()
        for b in batches:
            cols = f(texts_of(b, text))
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(k)) for k in keep], *cols],
                                             names=[*keep, *added])

    return df.mapInArrow(run, schema)


def word_count(text: str):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
