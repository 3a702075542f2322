"""Describe flow: one duration metric of a corpus collection along one axis.

Segment metrics use manual sets only; recording metrics use every kept recording. Ages are those at
a child's first kept recording (D9). Mean and standard deviation of segments are in
milliseconds, everything else in hours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolake.functions.columns import drop_discarded
from annolake.operators import stats as S
from annolake.operators.curate import child_segments, gold_sets, in_sets

ALL = "all datasets"
HOUR_MS = 3_600_000


def bin_label(bin_: str) -> Column:
    """``NN (lo, hi]``: the number first, so that the labels sort as the bins do; a single value's bin has no edges."""
    edge = lambda c: F.format_string("%.2f", F.floor(c * 100 + 0.5) / 100)
    edges = F.concat(F.lit(" ("), edge(F.col(f"{bin_}_lo")), F.lit(", "), edge(F.col(f"{bin_}_hi")), F.lit("]"))
    return F.concat(F.lpad(F.col(bin_).cast("string"), 2, "0"),
                    F.when(F.col(f"{bin_}_lo").isNotNull(), edges).otherwise(F.lit("")))


def describe(children: DataFrame, recordings: DataFrame, segments: DataFrame, sidecars: DataFrame, x_axis: str,
             y_axis: str = "segment", metric: str = "duration_total", sort_by_y: bool | None = None,
             aggregate: bool = False, bins: int = 10, set_keys: Sequence[str] = ("set_name",),
             rec_key: str = "recording") -> DataFrame:
    """(dataset, x_axis, metric, count); with ``aggregate`` (x_axis, metric) over all corpora, and the corpus named ``ALL``.

    ``segments`` has the recording key, the ``set_keys``, ``segment_onset`` and ``segment_offset`` and the speaker columns.
    Ages of recordings fall into ``bins`` equal-width bins, a corpus' own or, with ``aggregate``, common ones;
    ages of segments are labels rounded to one digit. Sorting is by corpus, then the axis or the metric.
    """
    S.check_axes(x_axis, y_axis)
    if x_axis not in S.CHILD_AXES + S.SEGMENT_AXES:
        raise ValueError(f"unknown x axis {x_axis}")
    if metric not in S.METRICS:
        raise ValueError(f"unknown metric {metric}")
    ch, rec = drop_discarded(children), drop_discarded(recordings)
    if x_axis == "child_age":
        ch = S.child_age(rec, ch).withColumnRenamed("age_months", "child_age")
    ch = ch.select(*dict.fromkeys(["dataset", "child_id", *([x_axis] if x_axis in S.CHILD_AXES else [])]))
    if y_axis == "segment":
        seg = in_sets(segments, gold_sets(sidecars), set_keys).select(
            rec_key, (F.col("segment_offset") - F.col("segment_onset")).alias("duration"),
            *([x_axis] if x_axis in S.SEGMENT_AXES else []))
        d = child_segments(ch, rec.select(rec_key, "child_id"), seg, rec_key=rec_key)
    else:
        d = rec.select("child_id", "duration").join(ch, "child_id", "inner")
        if x_axis == "child_age":
            d = S.equal_width_bins(d, "child_age", bins, by=[] if aggregate else ["dataset"], out="_bin") \
                 .withColumn("child_age", bin_label("_bin"))
    in_ms = y_axis == "segment" and metric in ("duration_mean", "duration_std")
    unit = 1 if in_ms or metric == "count" else HOUR_MS
    out = S.distribution(d, x_axis, "duration", by=["dataset"], metrics=[metric], total_unit=unit, digits=6,
                         sort_by_y=None if aggregate else sort_by_y)
    if unit != 1 and metric in ("duration_mean", "duration_std"):
        out = out.withColumn(metric, F.col(metric) / F.lit(float(unit)))
    if not aggregate:
        return out
    out = S.pooled(out, x_axis, metric).withColumn("dataset", F.lit(ALL)).select("dataset", x_axis, metric)
    if sort_by_y is None:
        return out
    return out.orderBy(F.col(metric).desc_nulls_last(), x_axis) if sort_by_y else out.orderBy(x_axis)


def describe_all(children: DataFrame, recordings: DataFrame, segments: DataFrame, sidecars: DataFrame,
                 axes: Sequence[str] = S.CHILD_AXES + S.SEGMENT_AXES, set_keys: Sequence[str] = ("set_name",), rec_key: str = "recording") -> DataFrame:
    """Every segment metric along every axis, of each corpus and of all together, from one pass over the segments:
    (dataset, axis, x, count, duration_total in hours, duration_mean, duration_std in ms, pooled_std).

    Rows of the corpus ``ALL`` have the true deviation of all segments and, as ``pooled_std``, the one that the per-corpus
    deviations give (A9); other rows have none. The result can be stored as states instead: see ``operators.moments``.
    """
    from annolake.operators.moments import merge_moments, metrics_of, moments, pooled_std
    from annolake.session import cut_lineage

    ch, rec = drop_discarded(children), drop_discarded(recordings)
    ch = S.child_age(rec, ch).withColumnRenamed("age_months", "child_age").select("dataset", "child_id", "child_sex", "child_age")
    seg = in_sets(segments, gold_sets(sidecars), set_keys).select(
        rec_key, (F.col("segment_offset") - F.col("segment_onset")).alias("duration"), *[a for a in S.SEGMENT_AXES if a in axes])
    rows = child_segments(ch, rec.select(rec_key, "child_id"), seg, rec_key=rec_key)
    states = cut_lineage(moments(rows, list(axes), "duration"), "moments")
    keys = ["axis", "x"]
    every = (metrics_of(merge_moments(states, keys), keys, HOUR_MS).join(pooled_std(states, keys), keys)
             .select(F.lit(ALL).alias("dataset"), *keys, "count", "duration_total", "duration_mean", "duration_std", "pooled_std"))
    each = metrics_of(states, ["dataset", *keys], HOUR_MS).withColumn("pooled_std", F.lit(None).cast("double"))
    return each.unionByName(every)
