"""Ingest: read every corpus's CSV index tables, segment files and sidecars once
and store them as Parquet partitioned by corpus (S1, S2, S3 -> S8).

Later plans read the Parquet tables: column pruning and filter pushdown reach
the files, and selecting corpora prunes whole folders (PartitionFilters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annolake.session import temporary_tables
from annolake.sources.index import scan_index, scan_segments
from annolake.sources.sidecars import scan_sidecars
from annolake.sources.sinks import write_table

TABLES = ("children", "recordings", "annotations")


def ingest(spark: SparkSession, root: str, out: str, datasets=None) -> dict[str, str]:
    """Write children / recordings / annotations / segments / sidecars under ``out``."""
    paths = {}
    with temporary_tables(spark):
        for t in TABLES:
            paths[t] = write_table(scan_index(spark, root, t, datasets), f"{out}/{t}", partition_by=["dataset"])
        paths["segments"] = write_table(scan_segments(spark, root, datasets=datasets), f"{out}/segments", partition_by=["dataset"])
    sidecars = scan_sidecars(spark, root)
    if datasets:
        sidecars = sidecars.filter(sidecars["dataset"].isin(list(datasets)))
    paths["sidecars"] = write_table(sidecars, f"{out}/sidecars", partition_by=["dataset"])
    return paths


def read_ingested(spark: SparkSession, out: str, table: str, datasets=None) -> DataFrame:
    df = spark.read.parquet(f"{out}/{table}")
    return df.filter(df["dataset"].isin(list(datasets))) if datasets else df
