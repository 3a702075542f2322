"""Index tables (one CSV per corpus) and segment tables (many small CSVs
whose columns differ by set).

Files differ in their headers, so rows are maps from column name to value
(``csv_records``: big files are read in byte ranges by many tasks, each file once). Only distinct column
names ever come to the driver (S1, whose result has a column for each); the list
of files never does. Paths, selections and the sets of an annotation index choose the files before
they are opened. Cells may hold line breaks. Paths go through Spark's own
reader, so any store that Spark reads will do. What is scanned is stored once as a table in the shared
folder: plans over it read its columns, not the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.operators.curate import STANDARD_COLUMNS
from annolake.session import cut_lineage
from annolake.sources.csv_records import csv_records, header_names, stored_lines

# Columns of the index tables that are not text.
LONG_COLUMNS = ("time_seek", "range_onset", "range_offset", "duration", "segment_onset", "segment_offset")
DATE_COLUMNS = ("date_iso", "child_dob")


def _typed(name: str):
    v = F.col("row")[name]
    return (v.try_cast("long") if name in LONG_COLUMNS else v.try_cast("date") if name in DATE_COLUMNS else v).alias(name)


def scan_index(spark: SparkSession, root: str, table: str, datasets: Sequence[str] | None = None, layout: str | None = None) -> DataFrame:
    """``<root>/<dataset>/metadata/<table>.csv`` of every corpus, tagged with ``dataset``;
    the union of all columns (missing -> null), times as longs and dates as dates.

    ``layout``: another place of the files, a pattern of their paths whose group is the corpus
    (``r"/dataset=([^/]+)/[^/]+\\.csv$"`` for a partitioned table).
    """
    rx = layout or rf"/([^/]+)/metadata/{table}\.csv$"
    keep = F.col("_metadata.file_path").rlike(rx)
    if datasets:
        keep = keep & F.regexp_extract("_metadata.file_path", rx, 1).isin(list(datasets))
    lines = stored_lines(spark, root, "*.csv" if layout else f"{table}.csv", keep)
    out = csv_records(lines).select(*[_typed(n) for n in header_names(lines) if n != "dataset"], F.regexp_extract("path", rx, 1).alias("dataset"))
    return cut_lineage(out, f"scan_{table}")


def scan_segments(spark: SparkSession, root: str, index: DataFrame | None = None,
                  onset: str = "segment_onset", offset: str = "segment_offset",
                  datasets: Sequence[str] | None = None, layout: str | None = None) -> DataFrame:
    """Segment CSVs under ``<root>/<dataset>/annotations/<set>/converted/``.

    Label columns (all but the standard ones, F6) are folded into
    ``labels MAP<STRING,STRING>`` (a header column that is all null stays a key
    with null values). ``datasets`` and the sets of an annotation ``index`` choose the files that are
    opened, its file names (semi-join on dataset, set, annotation_filename) the lines that are parsed.
    ``layout``: another place, a pattern whose groups are corpus, set and file.
    """
    rx = layout or r"/([^/]+)/annotations/(.+)/converted/([^/]+)$"
    names = ("dataset", "set", "annotation_filename")

    def part(path):
        return {n: F.regexp_extract(path, rx, k + 1) for k, n in enumerate(names)}

    opened = part("_metadata.file_path")
    keep = F.col("_metadata.file_path").rlike(rx)
    if datasets:
        keep = keep & opened["dataset"].isin(list(datasets))
    if index is not None:
        sets = index.select("dataset", "set").distinct().collect()      # as many as there are annotation sets
        keep = keep & F.concat_ws("/", opened["dataset"], opened["set"]).isin([f"{r[0]}/{r[1]}" for r in sets])
    lines = stored_lines(spark, root, "*.csv", keep)
    if index is not None:
        wanted = index.select(*names).distinct()
        chosen = lines.where("of_head and head is not null").select("path", *[c.alias(n) for n, c in part("path").items()])
        lines = lines.join(chosen.join(wanted, list(names), "left_semi").select("path"), "path", "left_semi")
    standard = F.array(*[F.lit(c) for c in STANDARD_COLUMNS])
    return cut_lineage(csv_records(lines).select(
        *[c.alias(n) for n, c in part("path").items()],
        F.col("row")[onset].try_cast("long").alias(onset), F.col("row")[offset].try_cast("long").alias(offset),
        F.map_filter("row", lambda k, v: ~F.array_contains(standard, k)).alias("labels")), "scan_segments")


def segments_long(segments: DataFrame, fill_set_columns: bool = True) -> DataFrame:
    """Segments -> long label map (one row per segment and label; null values kept).

    With ``fill_set_columns`` every segment gets a row for every label column
    that any file of its set has (null when its own file lacks the column), as a
    row-wise concat of the set's files would give. The per-set column list is
    tiny (distinct label names of a set); segments are joined to it on the set
    and exploded, so nothing grows beyond the output itself.
    """
    keys = ["dataset", "set"]
    seg_cols = [*keys, "annotation_filename", "segment_onset", "segment_offset"]
    base = segments.select(*seg_cols, "labels")
    if not fill_set_columns:
        return base.select(*seg_cols, F.explode("labels").alias("label", "value"))
    cols = (base.select(*keys, F.explode(F.map_keys("labels")).alias("label")).distinct()
                .groupBy(*keys).agg(F.array_sort(F.collect_list("label")).alias("_cols")))
    return (base.join(cols, keys, "inner")
                .select(*seg_cols, "labels", F.explode("_cols").alias("label"))
                .withColumn("value", F.element_at(F.col("labels"), F.col("label")))
                .drop("labels"))
