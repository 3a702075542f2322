"""Label profiles kept up to date (A1-A5 with U2).

The state counts each value: one row for each (corpus, set, label column, value) with its
milliseconds and segments. It is stored in one folder for each corpus and set, so replacing a set
rewrites its folder and nothing else, and profiles are made from the state without reading any segment.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.operators.profile import CATEGORICAL_CUTOFF, profile_of_values, sampled_duration, value_counts
from annolake.sources.sinks import replace_partitions

KEYS = ("dataset", "set_name")


class ProfileStore:
    """Value counts under ``path``, partitioned by corpus and set (both text, not null)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def replace(self, labels: DataFrame) -> None:
        """Put the sets of ``labels`` in place of what is stored of them; a rerun changes nothing."""
        counts = value_counts(labels, KEYS).select(*[F.col(k).cast("string").alias(k) for k in KEYS], "label", "value", "_ms", "_n")
        replace_partitions(counts, self.path, KEYS)

    def values(self, sets: Iterable[tuple[str, str]] | None = None) -> DataFrame:
        """The stored counts, of the (corpus, set) pairs ``sets`` or of all; only their folders are read."""
        schema = "label string, value string, _ms bigint, _n bigint, dataset string, set_name string"
        stored = self.spark.read.schema(schema).parquet(self.path)
        if sets is not None:
            chosen = F.lit(False)
            for d, s in sets:
                chosen = chosen | ((F.col("dataset") == d) & (F.col("set_name") == s))
            stored = stored.where(chosen)
        return stored

    def profile(self, sets: Iterable[tuple[str, str]] | None = None, cutoff: int = CATEGORICAL_CUTOFF, with_values: bool = True) -> DataFrame:
        """``label_profile`` of what is stored."""
        return profile_of_values(self.values(sets), KEYS, cutoff=cutoff, with_values=with_values)

    def build_profile(self, files: DataFrame, sidecars: DataFrame, cutoff: int = CATEGORICAL_CUTOFF) -> DataFrame:
        """``build_profile`` (A1-A4) with the label part from the store."""
        return self.profile(cutoff=cutoff, with_values=False).join(sampled_duration(files, sidecars, KEYS), list(KEYS)).select(
            *KEYS, "column", "categorical", F.col("annotated_ms").alias("annotated_duration_ms"),
            "duration_from_samples_ms", "number_of_samples", F.col("num_non_empty").alias("num_of_non_empty_segments"))
