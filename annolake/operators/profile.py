"""Label coverage profiles and category summaries.

Input is the long label map: one row per (segment, label column) with the
value, null included (a column that exists but is all null is data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.functions.columns import span_duration_from_name, to_minutes
from annolake.operators.curate import category_columns
from annolake.sources.sidecars import CATEGORY_FLAG

# Fixed value: at most this many distinct values (null counts as one) is categorical.
CATEGORICAL_CUTOFF = 20


def label_profile(labels: DataFrame, by: Sequence[str] = ("dataset", "set_name"), label: str = "label",
                  value: str = "value", onset: str = "onset", offset: str = "offset_ms",
                  cutoff: int = CATEGORICAL_CUTOFF, with_values: bool = True) -> DataFrame:
    """A1 + A2: per (by.., column): annotated ms and count over non-null values,
    number of distinct values (null counts as one), categorical flag and, for
    categorical columns, the sorted non-null values.

    Two aggregation levels: (group, value) first, then group. A hot column with
    millions of distinct values is spread over the (group, value) hash, never
    collected; value lists are only built for groups at or under the cutoff.
    """
    counts = value_counts(labels, by, label, value, onset, offset)
    return profile_of_values(counts, by, label, value, cutoff, with_values)


def value_counts(labels: DataFrame, by: Sequence[str] = ("dataset", "set_name"), label: str = "label", value: str = "value",
                 onset: str = "onset", offset: str = "offset_ms") -> DataFrame:
    """The first level of ``label_profile``: (by.., label, value, _ms, _n), milliseconds and segments of each value."""
    return labels.groupBy(*by, label, value).agg(
        F.sum((F.col(offset) - F.col(onset)).cast("long")).alias("_ms"),
        F.count(F.lit(1)).alias("_n"))


def profile_of_values(lvl1: DataFrame, by: Sequence[str] = ("dataset", "set_name"), label: str = "label", value: str = "value",
                      cutoff: int = CATEGORICAL_CUTOFF, with_values: bool = True) -> DataFrame:
    """The second level of ``label_profile``, from ``value_counts``."""
    keys = list(by) + [label]
    lvl2 = lvl1.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("_ms"))), F.lit(0).cast("long")).alias("annotated_ms"),
        F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("_n"))), F.lit(0).cast("long")).alias("num_non_empty"),
        F.count(F.lit(1)).alias("n_values"))
    out = lvl2.withColumn("categorical", F.col("n_values") <= F.lit(cutoff))
    if with_values:
        small = lvl2.filter(F.col("n_values") <= F.lit(cutoff)).select(*keys)
        vals = (lvl1.filter(F.col(value).isNotNull()).join(small, keys, "left_semi")
                    .groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("values")))
        out = out.join(vals, keys, "left").withColumn(
            "values", F.when(F.col("categorical"), F.coalesce(F.col("values"), F.array().cast("array<string>"))))
    return out.withColumnRenamed(label, "column")


def sampled_duration(files: DataFrame, sidecars: DataFrame, by: Sequence[str] = ("dataset", "set_name"),
                     file_name: str = "annotation_filename") -> DataFrame:
    """A3 + A4 per set.

    Sampled ms = sampling_count * sampling_unit_duration when both are set and
    non-zero, else the sum of the spans written in the file names. Number of
    samples = sampling_count when set (0 stays 0), else the number of files.
    Sets without a sidecar give no row.
    """
    by = list(by)
    per_set = files.groupBy(*by).agg(
        F.sum(span_duration_from_name(F.col(file_name))).alias("_span_ms"),
        F.count(F.lit(1)).alias("_n_files"))
    sc = sidecars.select(*by, "sampling_count", "sampling_unit_duration")
    j = sc.join(per_set, by, "left")
    use_sidecar = (F.coalesce(F.col("sampling_count"), F.lit(0)) != 0) & \
                  (F.coalesce(F.col("sampling_unit_duration"), F.lit(0)) != 0)
    return j.select(
        *by,
        F.when(use_sidecar, F.col("sampling_count") * F.col("sampling_unit_duration"))
         .otherwise(F.coalesce(F.col("_span_ms"), F.lit(0).cast("long"))).cast("long").alias("duration_from_samples_ms"),
        F.coalesce(F.col("sampling_count"), F.col("_n_files"), F.lit(0).cast("long")).cast("long")
         .alias("number_of_samples"))


def build_profile(labels: DataFrame, files: DataFrame, sidecars: DataFrame,
                  by: Sequence[str] = ("dataset", "set_name"), cutoff: int = CATEGORICAL_CUTOFF) -> DataFrame:
    """Generated profile, one row per (dataset, set, column); only sets with a sidecar."""
    lp = label_profile(labels, by, cutoff=cutoff, with_values=False)
    sd = sampled_duration(files, sidecars, by)
    return lp.join(sd, list(by), "inner").select(
        *by, "column", "categorical", F.col("annotated_ms").alias("annotated_duration_ms"),
        "duration_from_samples_ms", "number_of_samples", F.col("num_non_empty").alias("num_of_non_empty_segments"))


def profile_columns(labels: DataFrame, sidecars: DataFrame, by: Sequence[str] = ("dataset", "set_name"), label: str = "label") -> DataFrame:
    """The (by.., column) rows that ``build_profile`` has, without its figures: enough for V2 and V3."""
    return labels.select(*by, F.col(label).alias("column")).distinct().join(sidecars.select(*by).distinct(), list(by), "left_semi")


def category_summary(profile: DataFrame, index_long: DataFrame, category: str,
                     by: Sequence[str] = ("dataset", "set_name")) -> DataFrame:
    """A5 + O1: per set, over the category's columns: sum of annotated ms, max of
    sampled ms, sum of non-empty segments, the (per-set constant) sample count;
    sets with nothing annotated are dropped; minutes with 3 digits; sorted."""
    by = list(by)
    cols = category_columns(index_long, category)
    j = profile.join(cols, by + ["column"], "left_semi")
    agg = j.groupBy(*by).agg(
        F.sum("annotated_duration_ms").alias("_ann"),
        F.max("duration_from_samples_ms").alias("_smp"),
        F.sum("num_of_non_empty_segments").alias("num_of_segments_non_empty"),
        F.max("number_of_samples").alias("num_of_samples"))
    return (agg.filter(F.col("_ann") != 0)
               .select(*by, to_minutes("_ann", 3).alias("annotated_total_duration_min"),
                       to_minutes("_smp", 3).alias("sampled_total_duration_min"),
                       F.col("num_of_segments_non_empty").cast("long").alias("num_of_segments_non_empty"),
                       F.col("num_of_samples").cast("long").alias("num_of_samples"))
               .orderBy(*by))


def corpora_info(profile: DataFrame, sidecars: DataFrame, index_long: DataFrame, category: str,
                 by: Sequence[str] = ("dataset", "set_name"), on: str = "set_name") -> DataFrame:
    """A6 + J4: per set, sampled and annotated minutes (2 digits) of the category's
    columns, for sets whose sidecar flag for the category is Y (any case).

    ``on`` names the sidecar column matched to the set (``segmentation`` gives the
    source tool's join)."""
    by = list(by)
    cols = category_columns(index_long, category)
    sets = profile.groupBy(*by).agg(F.max("duration_from_samples_ms").alias("_smp"))
    ann = profile.join(cols, by + ["column"], "left_semi").groupBy(*by) \
                 .agg(F.sum("annotated_duration_ms").alias("_ann"))
    flag = CATEGORY_FLAG[category]
    sc = sidecars.select(F.col(by[0]), F.col(on).alias(by[1]), F.col("raw")[flag].alias("_flag")) \
        if "raw" in sidecars.columns else sidecars.select(F.col(by[0]), F.col(on).alias(by[1]), F.col(flag).alias("_flag"))
    yes = sc.filter(F.upper(F.col("_flag")) == "Y").select(*by).distinct()
    j = sets.join(yes, by, "left_semi").join(ann, by, "left")
    return j.select(*by, to_minutes("_smp", 2).alias("sampled_duration_minutes"),
                    to_minutes(F.coalesce(F.col("_ann"), F.lit(0)), 2).alias("duration_annotated_minutes"))
