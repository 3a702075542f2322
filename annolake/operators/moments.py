"""Duration statistics along many axes from one pass, as states that can be merged.

A state is (count, total, mean, m2) of a value, m2 the sum of squared differences from the mean. States of parts
of the rows combine to the state of all of them, so one aggregate over the rows
serves every corpus, every axis, all corpora together and later additions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.operators.stats import label_axis_col


def moments(df: DataFrame, axes: Sequence[str] | Mapping[str, Column], value: str, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """``by`` + (axis, x, n, total, mean, m2): one row for each group and value of each axis, P15 labels, null is 'N/A'.

    A row meets each of its groups (as with grouping sets) and is folded on the map side, so the rows are read
    once and what is shuffled is one state a task and group. Null values of ``value`` count in no statistic.
    """
    floats = {n for n, t in df.dtypes if t in ("double", "float")}
    labels = {a: label_axis_col(c, False) for a, c in axes.items()} if isinstance(axes, Mapping) \
        else {a: label_axis_col(F.col(a), a in floats) for a in axes}
    each = df.select(*by, F.col(value).alias("_v"), F.explode(F.array(*[
        F.struct(F.lit(a).alias("axis"), c.alias("x")) for a, c in labels.items()])).alias("_g"))
    return each.groupBy(*by, "_g.axis", "_g.x").agg(
        F.count("_v").alias("n"), F.sum("_v").alias("total"), F.avg("_v").cast("double").alias("mean"),
        (F.var_pop("_v") * F.count("_v")).alias("m2"))


def merge_moments(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States with equal ``keys`` combined: ``keys`` + (n, total, mean, m2). A key has one state for each part (a corpus, a
    batch), so its window is as small as their number; differences are taken from the common mean, so nothing cancels."""
    w = Window.partitionBy(*keys)
    n, mean = F.col("n"), F.coalesce("mean", F.lit(0.0))
    common = F.sum(n * mean).over(w) / F.nullif(F.sum(n).over(w), F.lit(0))
    kind = dict(states.dtypes)["total"]
    return (states.withColumn("_all", common)
            .withColumn("_part", F.coalesce("m2", F.lit(0.0)) + n * (mean - F.col("_all")) * (mean - F.col("_all")))
            .groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").cast(kind).alias("total"), F.max("_all").alias("mean"), F.sum("_part").alias("m2")))


def std(n: Column, m2: Column) -> Column:
    """Sample standard deviation; a single value has none."""
    return F.when(n > 1, F.sqrt(m2 / (n - 1)))


def metrics_of(states: DataFrame, keys: Sequence[str], total_unit: float = 1.0, digits: int = 6) -> DataFrame:
    """``keys`` + (count, duration_total, duration_mean, duration_std) of states."""
    n = F.col("n")
    return states.select(*keys, n.alias("count"), (F.col("total").cast("double") / F.lit(float(total_unit))).alias("duration_total"),
                         F.when(n > 0, F.round("mean", digits)).alias("duration_mean"), F.round(std(n, F.col("m2")), digits).alias("duration_std"))


def pooled_std(states: DataFrame, keys: Sequence[str], digits: int = 6) -> DataFrame:
    """A9's pooled deviation over the parts, sqrt(sum(n s^2) / sum(n)): ``keys`` + pooled_std (parts of one value count in n
    but have no s; null if no part has one)."""
    n, s = F.col("n"), std(F.col("n"), F.col("m2"))
    return states.groupBy(*keys).agg(F.round(F.sqrt(F.sum(s * s * n) / F.sum(n)), digits).alias("pooled_std"))
