"""Column functions and small curation operators."""

import pandas as pd
import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from annolake.functions import columns as C
from annolake.operators import curate as CU
from annolake.operators.stats import equal_width_bins, pooled


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr.alias("y")).first().y


def test_names(spark):
    assert one(spark, C.clip_name(F.col("x"), F.lit(5), F.lit(9)), "ds/rec_1.wav") == "ds/rec_1-5to9.wav"
    assert one(spark, C.clip_name(F.col("x"), F.lit(5), F.lit(9)), "rec") == "rec-5to9"
    assert one(spark, C.with_suffix(F.col("x"), ".wav"), "a/b.tar.mp3") == "a/b.tar.wav"
    assert one(spark, C.with_suffix(F.col("x"), ".wav"), "a/b") == "a/b.wav"
    assert one(spark, C.with_stem(F.col("x"), F.lit("new")), "d/old.csv") == "d/new.csv"
    s, e = C.span_from_name(F.col("x"))
    assert one(spark, e - s, "rec_a_100_2500.csv") == 2400
    assert one(spark, s, "norange.csv") is None
    assert one(spark, C.dest_path(F.col("x"), "annotations", "out", F.lit("c1"), ["annotations"]),
               "/d/c1/annotations/s/converted/f.csv") == "out/annotations/c1/s/converted/f.csv"
    assert one(spark, C.dataset_of_set(F.col("x")), "c1/s/x") == "c1"


def test_nulls_and_discard(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), (" x ",), (None,), ("",)], "v string")
    assert [r.v for r in df.select(C.nullify("v").alias("v")).collect()] == [None, None, " x ", None, None]
    d = spark.createDataFrame([("1",), ("1.0",), ("True",), ("0",), (None,)], "discard string")
    assert C.drop_discarded(d).count() == 2


def test_minutes_half_up(spark):
    assert one(spark, C.to_minutes(F.col("x"), 3), 30, "long") == 0.001     # exact tie goes up
    assert one(spark, C.to_minutes(F.col("x"), 2), 2_505_600_000, "long") == 41760.0
    assert one(spark, C.to_minutes(F.col("x"), 3), None, "long") is None


def test_align_and_drop_null(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    al = C.align(df, [("x", "string"), ("z", "double"), ("y", "string")])
    assert al.columns == ["x", "z", "y"]
    assert C.drop_null_columns(al).columns == ["x"]


def test_filter_expr(spark):
    df = spark.createDataFrame([("F", 1), ("M", 2)], "child_sex string, n int")
    assert CU.filter_expr(df, "child_sex == 'F'").count() == 1
    assert CU.filter_expr(df, "child_sex = 'F'", syntax="sql").count() == 1
    with pytest.raises((AnalysisException, ParseException)):
        CU.filter_expr(df, "nope = 1", syntax="sql")
    assert CU.filter_expr(df, "child_sex ==== 'F'", on_error="ignore").count() == 2


def test_namespace_keys(spark):
    ch = spark.createDataFrame([("c1", "A")], "dataset string, child_id string")
    rc = spark.createDataFrame([("c1", "A", "r.wav", "r.its")],
                               "dataset string, child_id string, recording_filename string, raw_filename string")
    an = spark.createDataFrame([("c1", "s", "r.wav")], "dataset string, set string, recording_filename string")
    c, r, a = CU.namespace_keys(ch, rc, an)
    assert tuple(c.first()) == ("c1_A",)
    assert tuple(r.first()) == ("c1_A", "c1/r.wav", "c1/r.its")
    assert tuple(a.first()) == ("c1/s", "c1/r.wav")


def test_select_datasets_unknown(spark):
    df = spark.createDataFrame([("a",), ("b",)], "dataset string")
    assert CU.select_datasets(df, ["a"], known=df).count() == 1
    with pytest.raises(ValueError):
        CU.select_datasets(df, ["zz"], known=df)


def test_equal_width_bins_like_pandas_cut(spark):
    vals = [0.5, 1.0, 2.2, 3.9, 7.7, 10.0, 10.0, 4.4]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.bin for r in equal_width_bins(df, "x", 10).orderBy("x").collect()]
    exp = pd.cut(pd.Series(sorted(vals)), bins=10, labels=False) + 1
    assert got == list(exp)


def test_pooled(spark):
    m = spark.createDataFrame([("a", 2.0, 1), ("a", 4.0, 3), ("b", None, 1)], "ax string, duration_mean double, count long")
    got = {r.ax: r.duration_mean for r in pooled(m, "ax", "duration_mean").collect()}
    assert got["a"] == 3.5
    s = spark.createDataFrame([("a", 1.0, 2), ("a", None, 1)], "ax string, duration_std double, count long")
    assert pooled(s, "ax", "duration_std").first().duration_std == pytest.approx((2 / 3) ** 0.5)
