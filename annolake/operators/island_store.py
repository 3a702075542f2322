"""Islands of annotated stretches kept up to date as batches of annotations come in (I4, I5 with U1).

The state is a table of partial islands: for each batch the islands of every
(key, time chunk) alone. Support is associative, so the islands of everything so far are those
of the stored partial islands; the annotations themselves are not read again. A
batch touches some recordings; only the buckets (folders) and keys of these are
read to renew their islands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.operators.intervals import DEFAULT_CHUNK, join_islands, partial_islands
from annolake.operators.scan import CHUNK, KEY

BUCKETS = 64


class IslandStore:
    """Partial islands under ``path``: ``batch=<id>/bucket=<hash of the key>``.

    A batch is written under its id with overwrite, so a retried batch (a lost
    job, a restarted stream) does not count twice, and a corrected batch replaces the first one. ``by``,
    ``collar``, ``chunk`` and ``buckets`` belong to the store and must stay the same.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = ("recording",), collar: int = 0,
                 chunk: int = DEFAULT_CHUNK, buckets: int = BUCKETS):
        self.spark, self.path, self.by = spark, path.rstrip("/"), list(by)
        self.collar, self.chunk, self.buckets = collar, chunk, buckets

    def _bucket(self, *cols: str | Column) -> Column:
        return F.pmod(F.xxhash64(*cols), F.lit(self.buckets)).cast("int")

    def add(self, batch: DataFrame, batch_id: int, start: str = "start", end: str = "end") -> DataFrame:
        """Store a batch; returns the keys that it touches."""
        part = partial_islands(batch, self.by, start, end, self.collar, self.chunk)
        flat = part.select(*[F.col(f"{KEY}.{b}").alias(b) for b in self.by], F.col(f"{CHUNK}.c").alias("chunk"), "_ps", "_pe")
        folder = f"{self.path}/batch={batch_id}"
        (flat.withColumn("bucket", self._bucket(*self.by)).repartition("bucket", *self.by, "chunk")
             .write.mode("overwrite").partitionBy("bucket").parquet(folder))
        return self._read(folder).select(*self.by).distinct()

    def _read(self, folder: str) -> DataFrame:
        kinds = "bucket int"
        known = {f.name: f.dataType.simpleString() for f in self.spark.read.option("mergeSchema", "false").parquet(folder).schema.fields}
        cols = ", ".join(f"`{b}` {known[b]}" for b in self.by)
        more = ", batch bigint" if folder == self.path else ""
        return self.spark.read.schema(f"{cols}, chunk bigint, _ps bigint, _pe bigint, {kinds}{more}").parquet(folder)

    def partials(self, keys: DataFrame | None = None) -> DataFrame:
        """The stored partial islands, of ``keys`` or of all: the keys' buckets choose the folders
        (at most ``buckets`` numbers come to the driver), a semi-join the rows."""
        stored = self._read(self.path)
        if keys is None:
            return stored
        touched = sorted(r[0] for r in keys.select(self._bucket(*self.by)).distinct().collect())
        same = [F.col(f"s.{b}").eqNullSafe(F.col(f"k.{b}")) for b in self.by]
        return stored.where(F.col("bucket").isin(touched)).alias("s").join(keys.select(*self.by).distinct().alias("k"), same, "left_semi")

    def islands(self, keys: DataFrame | None = None, start: str = "start", end: str = "end") -> DataFrame:
        """``by`` + [start, end]: the islands of ``keys``, or of all."""
        part = partial_islands(self.partials(keys).withColumnsRenamed({"_ps": start, "_pe": end}), self.by, start, end, self.collar, self.chunk)
        return join_islands(part, self.by, start, end, self.collar)

    def renew(self, batch: DataFrame, batch_id: int, start: str = "start", end: str = "end") -> DataFrame:
        """``add``, then the islands of the touched keys."""
        return self.islands(self.add(batch, batch_id, start, end), start, end)

    def compact(self, path: str) -> IslandStore:
        """A new store at ``path`` that holds everything as one batch."""
        out = IslandStore(self.spark, path, self.by, self.collar, self.chunk, self.buckets)
        out.add(self.partials(), 0, "_ps", "_pe")
        return out
