"""Nested profile JSON and the hand-written category index.

Profile (one file per corpus):
  {name, sets: [{name, columns: [{column, categorical, annotated_duration_ms,
   duration_from_samples_ms, number_of_samples, num_of_non_empty_segments}]}]}
Category index (one file):
  {datasets: [{name, sets: [{name, addressee_cols: [], vcm_cols: [], vtc_cols: [],
   transcription_cols: [], other: [], ignore: []}]}]}
Both are read with an explicit schema and exploded to long form for the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.operators.checks import INDEX_LISTS

COLUMN_T = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("categorical", T.BooleanType()),
    T.StructField("annotated_duration_ms", T.LongType()),
    T.StructField("duration_from_samples_ms", T.LongType()),
    T.StructField("number_of_samples", T.LongType()),
    T.StructField("num_of_non_empty_segments", T.LongType()),
])
PROFILE_T = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("sets", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("columns", T.ArrayType(COLUMN_T)),
    ]))),
])
LISTS = INDEX_LISTS + ("ignore",)
INDEX_SET_T = T.StructType([T.StructField("name", T.StringType())]
                           + [T.StructField(lst, T.ArrayType(T.StringType())) for lst in LISTS])
INDEX_T = T.StructType([T.StructField("datasets", T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("sets", T.ArrayType(INDEX_SET_T)),
])))])


def scan_profiles(spark: SparkSession, path: str) -> DataFrame:
    """A folder of profile JSON files -> one row per (dataset, set, column)."""
    raw = spark.read.schema(PROFILE_T).option("multiLine", "true").json(path)
    sets = raw.select(F.col("name").alias("dataset"), F.explode("sets").alias("s"))
    cols = sets.select("dataset", F.col("s.name").alias("set_name"), F.explode("s.columns").alias("c"))
    return cols.select("dataset", "set_name", *[F.col(f"c.{f.name}").alias(f.name) for f in COLUMN_T.fields])


def scan_category_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The category index -> (long form (dataset, set_name, category, column),
    nested form: one row per set with the lists, null when absent)."""
    raw = spark.read.schema(INDEX_T).option("multiLine", "true").json(path)
    ds = raw.select(F.explode("datasets").alias("d"))
    sets = ds.select(F.col("d.name").alias("dataset"), F.explode("d.sets").alias("s"))
    nested = sets.select("dataset", F.col("s.name").alias("set_name"), *[F.col(f"s.{lst}").alias(lst) for lst in LISTS])
    # every (category, column) pair of a set; a set without any column keeps one
    # row with null category / column, so set-level checks still see it
    def tag(lst):
        return lambda c: F.struct(F.lit(lst).alias("category"), c.alias("column"))

    pairs = F.flatten(F.array(*[
        F.transform(F.coalesce(F.col(lst), F.array().cast("array<string>")), tag(lst)) for lst in LISTS]))
    long = nested.select("dataset", "set_name", F.explode_outer(pairs).alias("p")) \
                 .select("dataset", "set_name", F.col("p.category").alias("category"),
                         F.col("p.column").alias("column"))
    return long, nested


def write_profiles(profile_long: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long profile -> one nested JSON document per corpus (folder per corpus).

    The nesting collects columns per set and sets per corpus; its size is the
    number of label columns of a corpus, not the number of segments.
    """
    per_set = profile_long.groupBy("dataset", "set_name").agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(f.name) for f in COLUMN_T.fields]))).alias("columns"))
    per_ds = per_set.groupBy("dataset").agg(
        F.array_sort(F.collect_list(F.struct(F.col("set_name").alias("name"), "columns"))).alias("sets"))
    (per_ds.select(F.col("dataset").alias("name"), "sets", F.col("dataset").alias("corpus"))
     .write.mode(mode).partitionBy("corpus").json(path))
