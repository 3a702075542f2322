"""Table sinks. Parquet by default (columnar, pushdown on re-read);
CSV for hand-off. ``partition_by=['dataset']`` gives one folder per corpus, which
later reads prune by corpus (PartitionFilters)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                mode: str = "overwrite", suffix: str | None = None) -> str:
    """Write ``df``; ``suffix`` appends to the folder name (e.g. the category flag)."""
    if suffix:
        path = f"{path.rstrip('/')}_{suffix}"
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> str:
    """U2 at the sink: the rows of ``df`` replace those stored under the same ``keys`` (folders); no other folder is
    touched, and a rerun leaves the same rows. ``df`` must not be read from ``path`` itself. A key that ``df`` lacks keeps its rows."""
    (df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))
    return path
