"""Descriptive statistics: subject summaries, grouped duration metrics and
metrics pooled over corpora.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolake.functions.columns import age_months, drop_discarded

# Metric names.
METRICS = ("duration_mean", "duration_std", "duration_total", "count")
CHILD_AXES = ("child_id", "child_age", "child_sex")
SEGMENT_AXES = ("speaker_type", "speaker_id")


def check_axes(x_axis: str, y_axis: str) -> None:
    """segment-level axes cannot be aggregated over recordings."""
    if x_axis in SEGMENT_AXES and y_axis == "recording":
        raise ValueError("segment-level axis cannot be aggregated over recordings")
    if y_axis not in ("segment", "recording"):
        raise ValueError(f"unknown y axis {y_axis}")


def with_age(recordings: DataFrame, children: DataFrame, keys: Sequence[str] = ("child_id",),
             digits: int | None = 2) -> DataFrame:
    """Age in months at each recording (join by child, not by row position)."""
    ch = children.select(*keys, "child_dob")
    return recordings.join(ch, list(keys), "left").withColumn(
        "age_months", age_months("date_iso", "child_dob", digits)).drop("child_dob")


# Columns of the children table that the subject table keeps.
SUBJECT_COLUMNS = ("child_id", "child_sex", "normative", "normative_criterion", "dob_criterion", "dob_accuracy")


def subject_table(children: DataFrame, recordings: DataFrame, dataset: str = "dataset") -> DataFrame:
    """A7's other table: one row per kept child with its age in months and those of SUBJECT_COLUMNS that are there."""
    ch = drop_discarded(children)
    keep = [c for c in SUBJECT_COLUMNS if c in ch.columns]
    return child_age(drop_discarded(recordings), ch).select(dataset, *keep, "age_months")


def child_age(recordings: DataFrame, children: DataFrame, keys: Sequence[str] = ("child_id",)) -> DataFrame:
    """Age of a child = age at the first recording."""
    r = with_age(recordings, children, keys, digits=None)
    first = r.groupBy(*keys).agg(F.min("age_months").alias("_age"))
    return children.join(first, list(keys), "left").withColumn("age_months", F.round("_age", 2)).drop("_age")


def equal_width_bins(df: DataFrame, col: str, n: int = 10, by: Sequence[str] = (), out: str = "bin") -> DataFrame:
    """``n`` equal-width, right-closed bins between the min and max of ``col``
    (per ``by`` group); the first bin also holds the min. Adds ``out`` (1..n) and
    the bin edges ``out_lo``/``out_hi``. Min/max come from an aggregate joined back.
    """
    by = list(by)
    mm = df.groupBy(*by).agg(F.min(col).cast("double").alias("_mn"), F.max(col).cast("double").alias("_mx"))
    if by:
        d = df.join(mm, by, "left")
    else:  # one global row: a size-bounded broadcast on a constant key
        d = df.withColumn("_one", F.lit(1)).join(F.broadcast(mm.withColumn("_one", F.lit(1))), "_one").drop("_one")
    w = (F.col("_mx") - F.col("_mn")) / F.lit(n)
    x = F.col(col).cast("double")
    k = F.when(w > 0, F.least(F.greatest(F.ceil((x - F.col("_mn")) / w), F.lit(1)), F.lit(n))) \
         .otherwise(F.lit((n + 1) // 2))
    k = F.when(x.isNotNull(), k.cast("int"))
    return (d.withColumn(out, k)
             .withColumn(f"{out}_lo", F.when(w > 0, F.col("_mn") + (F.col(out) - 1) * w))
             .withColumn(f"{out}_hi", F.when(w > 0, F.col("_mn") + F.col(out) * w))
             .drop("_mn", "_mx"))


def label_axis_col(c: Column, is_float: bool) -> Column:
    """Float labels rounded to one digit, ties to even; null -> 'N/A' (applied before grouping)."""
    c = F.bround(c, 1) if is_float else c
    return F.coalesce(c.cast("string"), F.lit("N/A"))


def distribution(df: DataFrame, axis: str, value: str = "duration", by: Sequence[str] = ("dataset",),
                 metrics: Sequence[str] = METRICS, digits: int = 6, total_unit: float | None = None,
                 sort_by_y: bool | None = None) -> DataFrame:
    """A8 + J8: mean / sample std / total / count of ``value`` per (corpus, axis).

    A null axis is a group of its own. Metric and count come from one aggregate.
    The total is summed exactly in the input unit and divided once by
    ``total_unit`` (e.g. 3600000 for ms -> hours); only the std is rounded.
    O2: ``sort_by_y`` sorts by the (first) metric descending, ``False`` by the axis (by value, not by label),
    ``None`` leaves the order to the sink.
    """
    is_float = dict(df.dtypes).get(axis) in ("double", "float")
    d = df.withColumn("_x", label_axis_col(F.col(axis), is_float))
    aggs = {
        "duration_mean": F.avg(value).alias("duration_mean"),
        "duration_std": F.round(F.stddev_samp(value), digits).alias("duration_std"),
        "duration_total": (F.sum(value).cast("double") / F.lit(float(total_unit or 1))).alias("duration_total"),
        "count": F.count(value).alias("count"),
    }
    sel = [aggs[m] for m in metrics]
    if "count" not in metrics:
        sel.append(F.count(value).alias("count"))
    sel += [F.min(axis).alias("_at")] if sort_by_y is not None else []
    out = d.groupBy(*by, "_x").agg(*sel)
    if sort_by_y is not None:
        at = F.col("_at").asc_nulls_last()
        out = out.orderBy(*by, *([F.col(metrics[0]).desc_nulls_last(), at] if sort_by_y else [at])).drop("_at")
    return out.withColumnRenamed("_x", axis)


def pooled(metrics: DataFrame, axis: str, metric: str, count: str = "count", digits: int = 6) -> DataFrame:
    """Combine per-corpus metrics per axis value: totals and counts add up,
    means are count-weighted, std is sqrt(sum(n s^2) / sum(n)) (groups of one
    count in n but have no s)."""
    if metric in ("duration_total", "count"):
        agg = F.sum(metric)
    elif metric == "duration_mean":
        agg = F.sum(F.col(metric) * F.col(count)) / F.sum(count)
    elif metric == "duration_std":
        agg = F.sqrt(F.sum(F.col(metric) * F.col(metric) * F.col(count)) / F.sum(count))
    else:
        raise ValueError(metric)
    out = metrics.groupBy(axis).agg(agg.alias(metric))
    if metric != "count":
        out = out.withColumn(metric, F.round(F.col(metric).cast("double"), digits))
    return out


def subject_summary(children: DataFrame, recordings: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Per corpus: children, min/max age (months, over recordings), languages,
    mono/multilingual, normative/non-normative, male/female counts."""
    ch = drop_discarded(children)
    rec = with_age(drop_discarded(recordings), ch.select("child_id", "child_dob"), digits=None)
    ages = rec.join(ch.select("child_id", dataset), "child_id", "inner").groupBy(dataset).agg(
        F.round(F.min("age_months"), 2).alias("min_age_months"),
        F.round(F.max("age_months"), 2).alias("max_age_months"))

    def has(c):
        return c in ch.columns

    langs = F.split(F.col("languages"), r"\s*[;,]\s*") if has("languages") else None
    sex = F.upper(F.trim(F.col("child_sex"))) if has("child_sex") else None
    norm = F.upper(F.trim(F.col("normative"))) if has("normative") else None
    zero = F.lit(0).cast("long")
    per = ch.groupBy(dataset).agg(
        F.count(F.lit(1)).alias("n_children"),
        (F.count_if(F.size(langs) == 1) if langs is not None else zero).alias("monolingual"),
        (F.count_if(F.size(langs) > 1) if langs is not None else zero).alias("multilingual"),
        (F.count_if(norm == "Y") if norm is not None else zero).alias("normative"),
        (F.count_if(norm == "N") if norm is not None else zero).alias("non_normative"),
        (F.count_if(sex.isin("M", "MALE")) if sex is not None else zero).alias("male"),
        (F.count_if(sex.isin("F", "FEMALE")) if sex is not None else zero).alias("female"),
    )
    out = per.join(ages, dataset, "left")
    if langs is not None:  # distinct (corpus, language) pairs, counted: no per-corpus list
        n_lang = (ch.select(dataset, F.explode(langs).alias("_l")).filter(F.col("_l") != "").distinct()
                    .groupBy(dataset).agg(F.count(F.lit(1)).alias("languages")))
        out = out.join(n_lang, dataset, "left").withColumn("languages", F.coalesce("languages", F.lit(0).cast("long")))
    else:
        out = out.withColumn("languages", F.lit(None).cast("long"))
    return out

