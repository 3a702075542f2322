"""Curation: pick corpora, filter by expression, build the file index, keep only
files that carry labels of a category, propagate the selection, namespace keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.functions.columns import age_months, drop_discarded, path_for, store_without_null_columns
from annolake.functions.expressions import FilterError, translate

# Columns every annotation / segment table has; the rest are labels.
STANDARD_COLUMNS = (
    "segment_onset", "segment_offset", "raw_filename", "set", "recording_filename", "time_seek",
    "range_onset", "range_offset", "format", "filter", "annotation_filename", "imported_at",
    "package_version", "error", "merged_from", "duration",
)
# The four label categories and the index list holding each.
CATEGORY_LISTS = {
    "addressee": "addressee_cols",
    "vcm": "vcm_cols",
    "vtc": "vtc_cols",
    "transcription": "transcription_cols",
}

# --- S9 ---------------------------------------------------------------------------

def select_datasets(df: DataFrame, names: Iterable[str] | None, col: str = "dataset",
                    known: DataFrame | None = None) -> DataFrame:
    """Keep the named corpora (all when ``names`` is empty); unknown names raise."""
    names = list(names or [])
    if not names:
        return df
    if known is not None:
        have = {r[0] for r in known.select(col).distinct().where(F.col(col).isin(names)).collect()}
        missing = sorted(set(names) - have)
        if missing:
            raise ValueError(f"unknown corpora: {missing}")
    return df.filter(F.col(col).isin(names))


# --- F2 / F3 / F6 ---------------------------------------------------------------------

def filter_expr(df: DataFrame, expr: str | None, on_error: str = "raise", syntax: str = "query",
                given: Mapping[str, Any] | None = None) -> DataFrame:
    """keep the rows that pass the user's filter.

    ``syntax='query'`` is the data-frame query language (``functions.expressions``; ``given``
    holds the values of its ``@names``), ``'sql'`` a Spark SQL predicate. A bad
    expression raises, or with ``on_error='ignore'`` means no filter (as the source tool did).
    """
    if not expr or not expr.strip():
        return df
    try:
        out = df.filter(translate(df, expr, given) if syntax == "query" else expr)
        out.schema  # analyse now
        return out
    except (FilterError, AnalysisException, ParseException):
        if on_error == "ignore":
            return df
        raise


def gold_sets(sidecars: DataFrame, method_col: str = "method") -> DataFrame:
    """manual sets only; without a ``method`` column every set counts."""
    if method_col not in sidecars.columns:
        return sidecars
    return sidecars.filter(F.col(method_col) == "manual")


def in_sets(rows: DataFrame, sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ``rows`` whose ``keys`` are among those of ``sets``. A set may hold most of the rows, so they are not shuffled
    by set: the keys, one small row a set, go to every task. A null key matches nothing."""
    return rows.join(F.broadcast(sets.select(*keys).distinct()), list(keys), "left_semi")


def label_columns(columns: Sequence[str]) -> list[str]:
    """non-standard (label) columns of a segment table."""
    return [c for c in columns if c not in STANDARD_COLUMNS]


# --- F4 category filter -----------------------------------------------------------------

def category_columns(index_long: DataFrame, category: str) -> DataFrame:
    """(dataset, set_name, column) mapped to ``category`` in the long index."""
    lst = CATEGORY_LISTS.get(category, category)
    return index_long.filter(F.col("category").isin(category, lst)).select("dataset", "set_name", "column")


def filter_category(files: DataFrame, labels: DataFrame, index_long: DataFrame, category: str,
                    file_key: Sequence[str] = ("dataset", "set_name", "file_key")) -> DataFrame:
    """keep a file iff its set maps columns to ``category`` and the file has a
    non-null value in one of them.

    ``labels`` is the long label map (file key, label, value). Non-null label
    rows are semi-joined with the category's columns (one row per set and
    column: AQE broadcasts it once measured small, with no extra job), the
    distinct file keys then semi-join the files.
    """
    keys = list(file_key)
    cols = category_columns(index_long, category)
    hit = (labels.filter(F.col("value").isNotNull())
                 .join(cols, (labels["dataset"] == cols["dataset"]) & (labels["set_name"] == cols["set_name"])
                       & (labels["label"] == cols["column"]), "left_semi")
                 .select(*keys).distinct())
    return files.join(hit, keys, "left_semi")


def unmapped_sets(files: DataFrame, index_long: DataFrame) -> DataFrame:
    """Sets with files but absent from the category index (an error in the source tool)."""
    sets = index_long.select("dataset", "set_name").distinct()
    return files.select("dataset", "set_name").distinct().join(sets, ["dataset", "set_name"], "left_anti")


# --- J1 / J2 / J3 / J5 --------------------------------------------------------------------

def build_file_index(annotations: DataFrame, recordings: DataFrame, children: DataFrame,
                     sidecars: DataFrame, rec_key: Sequence[str] = ("dataset", "recording_filename"),
                     child_key: Sequence[str] = ("dataset", "child_id"),
                     set_key: Sequence[str] = ("dataset", "set")) -> DataFrame:
    """Annotations joined to their (kept) recording and child, restricted to sets
    with a sidecar. Discarded children / recordings are dropped first (F1).

    A left join followed by the valid-child test is an inner join, so inner joins
    it is; the sidecar and child tests are semi-joins (no fan-out).
    """
    rk, ck, sk = list(rec_key), list(child_key), list(set_key)
    rec = drop_discarded(recordings)
    rec_cols = [c for c in rec.columns if c not in annotations.columns or c in rk]
    a = in_sets(annotations, sidecars, sk)
    j = a.join(rec.select(*rec_cols), rk, "inner")
    return j.join(drop_discarded(children).select(*ck), ck, "left_semi")


def propagate(selection: DataFrame, table: DataFrame, keys: Sequence[str], drop_empty: bool = True) -> DataFrame:
    """Rows of ``table`` whose key occurs in the selection; then P9 (drop all-null columns).

    P9 needs a census of the result before the result itself: the selected rows
    are written once (shared checkpoint folder) and counted on the way, the output reads
    only the kept columns of that table."""
    out = table.join(selection.select(*keys), list(keys), "left_semi")
    return store_without_null_columns(out, "propagated") if drop_empty else out


def split_input(annotations: DataFrame, recordings: DataFrame, children: DataFrame,
                rec_key: str = "recording", child_key: str = "child_id", root: str = "datasets",
                paths: bool = True) -> DataFrame:
    """Annotations LEFT JOIN recordings LEFT JOIN children (null child kept),
    with corpus, age (P13), duration (P10) and file paths (P3).

    The children meet the recordings first: annotations pass through one join only, and those
    without a child do not gather on a null key. ``paths=False`` leaves the paths to ``with_split_paths``.
    """
    rec = drop_discarded(recordings).select(rec_key, child_key, "date_iso")
    ch = drop_discarded(children).select(child_key, "dataset", "child_dob")
    j = annotations.join(rec.join(ch, child_key, "left"), rec_key, "left").select(
        rec_key, "set_name", "line", child_key, "dataset",
        age_months("date_iso", "child_dob").alias("age_months"),
        "range_onset", "range_offset", (F.col("range_offset") - F.col("range_onset")).alias("duration_ms"))
    return with_split_paths(j, rec_key, root) if paths else j


def with_split_paths(df: DataFrame, rec_key: str = "recording", root: str = "datasets") -> DataFrame:
    """The annotation and recording paths (P3) of ``split_input`` rows."""
    ann_name = F.concat(F.col(rec_key).cast("string"), F.lit("_"), F.col("range_onset").cast("string"), F.lit("_"),
                        F.col("range_offset").cast("string"), F.lit(".csv"))
    return df.withColumns({
        "annotation_path": path_for(root, F.col("dataset"), "annotations", F.col("set_name"), "converted", ann_name),
        "recording_path": path_for(root, F.col("dataset"), "recordings", "converted", "standard",
                                   F.concat(F.col(rec_key).cast("string"), F.lit(".mp3")))})


def child_segments(children: DataFrame, recordings: DataFrame, segments: DataFrame,
                   child_key: str = "child_id", rec_key: str = "recording") -> DataFrame:
    """Child x recording x segment (inner joins, discarded rows dropped)."""
    cr = drop_discarded(children).join(drop_discarded(recordings).drop(*[c for c in ("discard",)
                                                                       if c in recordings.columns]),
                                       child_key, "inner")
    return cr.join(segments, rec_key, "inner")


# --- P1 namespacing -------------------------------------------------------------------------

def namespace_keys(children: DataFrame, recordings: DataFrame, annotations: DataFrame,
                   dataset: str = "dataset") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Make keys unique across corpora before the union.

    children.child_id -> ``<dataset>_<child_id>``; annotations.set and
    .recording_filename -> ``<dataset>/<value>``; every recordings column ending
    in ``_filename`` -> ``<dataset>/<value>``, recordings.child_id as children.
    The ``dataset`` column is dropped. Null stays null.
    """
    def pre(sep, c):
        return F.concat(F.col(dataset).cast("string"), F.lit(sep), F.col(c).cast("string"))

    ch = children.withColumn("child_id", pre("_", "child_id")).drop(dataset)
    an = annotations
    for c in ("set", "recording_filename"):
        if c in an.columns:
            an = an.withColumn(c, pre("/", c))
    an = an.drop(dataset)
    rc = recordings
    for c in rc.columns:
        if c.endswith("_filename"):
            rc = rc.withColumn(c, pre("/", c))
    if "child_id" in rc.columns:
        rc = rc.withColumn("child_id", pre("_", "child_id"))
    rc = rc.drop(dataset)
    return ch, rc, an


def file_split_input(annotations: DataFrame, recordings: DataFrame, children: DataFrame,
                     root: str = "datasets", paths: bool = True) -> DataFrame:
    """J3 over the standard column names: annotations LEFT JOIN recordings on
    (dataset, recording_filename) LEFT JOIN children on (dataset, child_id), the children
    joined to the recordings first; adds the age at recording when dates exist (P13), the
    duration (P10) and, unless ``paths`` is false, the annotation / standard recording paths (P3)."""
    rec_cols = [c for c in ("dataset", "recording_filename", "child_id", "date_iso") if c in recordings.columns]
    ch_cols = [c for c in ("dataset", "child_id", "child_dob") if c in children.columns]
    rc = drop_discarded(recordings).select(*rec_cols).join(
        drop_discarded(children).select(*ch_cols), ["dataset", "child_id"], "left")
    j = annotations.join(rc, ["dataset", "recording_filename"], "left")
    age = age_months("date_iso", "child_dob") if {"date_iso", "child_dob"} <= set(j.columns) \
        else F.lit(None).cast("double")
    j = j.withColumn("age_months", age).withColumn("duration_ms", F.col("range_offset") - F.col("range_onset"))
    return with_file_paths(j, "set", root) if paths else j


def with_file_paths(df: DataFrame, set_col: str = "set", root: str = "datasets") -> DataFrame:
    """The annotation and standard recording paths (P3) of ``file_split_input`` rows."""
    return df.withColumns({
        "annotation_path": path_for(root, F.col("dataset"), "annotations", F.col(set_col), "converted",
                                    F.col("annotation_filename")),
        "recording_path": path_for(root, F.col("dataset"), "recordings", "converted", "standard",
                                   F.col("recording_filename"))})
