"""Plan-shape guards: the scale properties the design relies on."""

import re

from annolake.operators.intervals import support
from annolake.operators.split import weighted_split
from annolake.plans.queries import QUERIES
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_support_has_no_window_over_a_whole_key(spark):
    df = spark.createDataFrame([("r", i, i + 5) for i in range(50)], "recording string, start long, end long")
    plan = plan_of(support(df, ["recording"], chunk=10))
    windows = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert windows
    # row-level windows partition by (key, chunk); the only key-only window runs over chunk rows
    for w in windows:
        assert not w.startswith("recording"), w
    assert "_scan_ck" in plan


def test_weighted_split_windows_are_chunked(spark):
    df = spark.createDataFrame([(i, "d", i % 7) for i in range(100)], "key long, dataset string, weight long")
    plan = plan_of(weighted_split(df, "key", "weight", by=["dataset"]))
    for w in re.findall(r"windowspecdefinition\(([^)]*)", plan):
        assert not w.startswith("dataset"), w


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["merge_replace"](spark, SF_SMALL))
    assert "LessThan(ts," in plan and "GreaterThanOrEqual(ts," in plan
    fi = plan_of(QUERIES["file_index"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", fi)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_shipdate" not in s and "l_extendedprice" not in s for s in lineitem)


def test_weighted_split_never_shuffles_rows_by_stratum(spark):
    df = spark.createDataFrame([(i, "d" if i % 3 else "e", i % 7) for i in range(200)],
                               "key long, dataset string, weight long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = weighted_split(df, "key", "weight", by=["dataset"])
        out.collect()
        plan = plan_of(out).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning(dataset" not in plan
    assert "Exchange hashpartitioning(coalesce(dataset" not in plan
