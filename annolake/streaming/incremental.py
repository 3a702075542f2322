"""Incremental corpus building over Structured Streaming.

New corpora arrive as files (annotation / recording batches). Each micro-batch
is written once, under its batch id, to an append-only log (``foreachBatch``
with an overwrite of ``batch_id=<n>``: a retried batch rewrites the same folder,
so the sink is idempotent and exactly-once with the checkpoint). The current
corpus is a view over the log:

* ``append``  (U1): all rows, whole-row distinct;
* ``replace`` (U2): for every key (set, child...) only the rows of the latest
  batch that carried the key, then distinct.

The view is a group-by on the key plus a join, so no batch and no key is ever
gathered on the driver or in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from annolake.operators.island_store import IslandStore
from annolake.session import checkpoint_dir

BATCH = "batch_id"


def start_batch_log(spark: SparkSession, source: str, schema: StructType, log_path: str,
                    checkpoint: str | None = None, fmt: str = "parquet",
                    available_now: bool = True) -> StreamingQuery:
    """Stream files from ``source`` into the batch log at ``log_path``."""
    # stable across restarts (Python's hash() is salted per process)
    tag = hashlib.sha1(log_path.rstrip("/").encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/batch-log-{tag}"

    def write_batch(df: DataFrame, batch_id: int) -> None:
        (df.withColumn(BATCH, F.lit(batch_id).cast("long"))
           .write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/{BATCH}={batch_id}"))

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.parquet(log_path)


def corpus_view(log: DataFrame, key: str | Sequence[str] | None = None) -> DataFrame:
    """Current corpus from the batch log: append (key=None) or replace by key."""
    cols = [c for c in log.columns if c != BATCH]
    if key is None:
        return log.select(*cols).distinct()
    keys = [key] if isinstance(key, str) else list(key)
    latest = log.groupBy(*keys).agg(F.max(BATCH).alias("_latest"))
    cur = log.join(latest, keys, "inner").filter(F.col(BATCH) == F.col("_latest"))
    return cur.select(*cols).distinct()


def start_island_store(stream: DataFrame, store: IslandStore, checkpoint: str, start: str = "start", end: str = "end",
                       available_now: bool = True) -> StreamingQuery:
    """Stream annotations (``by``, start, end) into an ``IslandStore``; a micro-batch is stored under its id, so a
    retried one does not count twice."""
    w = (stream.writeStream.foreachBatch(lambda df, batch_id: store.add(df, batch_id, start, end))
               .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
