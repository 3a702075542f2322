"""Mergeable states: moments along axes, stored profiles, folders replaced at the sink."""

import os
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from annolake.operators.moments import merge_moments, metrics_of, moments, pooled_std
from annolake.operators.profile import build_profile, label_profile
from annolake.operators.profile_store import ProfileStore
from annolake.operators.stats import distribution, pooled
from annolake.sources.sinks import replace_partitions


def rows(n=400, seed=3):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", None]), rng.choice(["CHI", "FEM", None, "one"]) if k else "single", rng.choice([1.25, 1.35, None, 7.0]),
             rng.choice([None, 10**9 + rng.randint(0, 50), rng.randint(0, 900)])) for k in range(n)]


SCHEMA = "dataset string, speaker string, age double, d long"


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) <= 1e-6 * max(1, abs(a)))


def test_one_pass_equals_one_query_an_axis(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    states = moments(df, ["speaker", "age"], "d")
    got = {(r.dataset, r.axis, r.x): r for r in metrics_of(states, ["dataset", "axis", "x"], 3600.0).collect()}
    n = 0
    for axis in ("speaker", "age"):
        for r in distribution(df, axis, "d", total_unit=3600).collect():
            g = got[r.dataset, axis, r[axis]]
            assert g["count"] == r["count"] and all(close(g[m], r[m]) for m in ("duration_mean", "duration_std", "duration_total")), (g, r)
            n += 1
        want = {r[axis]: r.duration_std for r in pooled(distribution(df, axis, "d", digits=12), axis, "duration_std").collect()}
        mine = {r.x: r.pooled_std for r in pooled_std(states.where(F.col("axis") == axis), ["x"]).collect()}
        assert mine.keys() == want.keys() and all(close(mine[k], want[k]) for k in want)
    assert n == len(got)
    scans = moments(df, ["speaker", "age"], "d")._jdf.queryExecution().optimizedPlan().toString()
    assert scans.count("LogicalRDD") + scans.count("LocalRelation") <= 1


def test_states_of_parts_give_those_of_all(spark):
    """Also with values near 10^9 that differ by a few: nothing cancels."""
    data = rows(500, 5)
    df = spark.createDataFrame(data, SCHEMA)
    parts = moments(df.limit(200), ["speaker"], "d").unionByName(moments(df.exceptAll(df.limit(200)), ["speaker"], "d"))
    got = {r.x: r for r in metrics_of(merge_moments(parts, ["axis", "x"]), ["axis", "x"]).collect()}
    want = defaultdict(list)
    for _, s, _, d in data:
        want[s or "N/A"] += [] if d is None else [d]
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k]["count"] == len(v) and close(got[k].duration_total, float(sum(v)) if v else None)
        assert close(got[k].duration_mean, statistics.fmean(v) if v else None) and close(got[k].duration_std, statistics.stdev(v) if len(v) > 1 else None)


def labels(spark, seed, sets=("s1", "s2", "01")):
    rng = random.Random(seed)
    out = [("c" + str(k % 2), rng.choice(sets), k * 10, k * 10 + rng.randint(1, 9), rng.choice(["kind", "free"]), rng.choice(["x", "y", None, str(k)]))
           for k in range(200)]
    return spark.createDataFrame(out, "dataset string, set_name string, onset long, offset_ms long, label string, value string")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_a_replaced_profile_equals_one_built_anew(spark, tmp_path):
    old, new = labels(spark, 1), labels(spark, 2, ("s2", "s9"))
    store = ProfileStore(spark, str(tmp_path / "p"))
    store.replace(old)
    assert same(store.profile(), label_profile(old))
    store.replace(new)
    fresh = old.where("set_name <> 's2'").unionByName(new)
    assert same(store.profile(), label_profile(fresh))
    store.replace(new)
    assert same(store.profile(), label_profile(fresh))
    one = store.profile([("c1", "01")], with_values=False)
    assert same(one, label_profile(old.where("dataset = 'c1' and set_name = '01'"), with_values=False))
    plan = store.values([("c1", "01")])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(dataset#" in plan and "PushedFilters: []" in plan
    files = spark.createDataFrame([("c0", "s2", "f_0_50.csv"), ("c1", "01", "g_5_9.csv")], "dataset string, set_name string, annotation_filename string")
    side = spark.createDataFrame([("c0", "s2", None, None), ("c1", "01", 3, 7)], "dataset string, set_name string, sampling_count long, sampling_unit_duration long")
    assert same(store.build_profile(files, side), build_profile(fresh, files, side))


def test_only_the_folders_of_replaced_keys_change(spark, tmp_path):
    path = str(tmp_path / "t")

    def listing():
        return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}

    df = spark.createDataFrame([(c, s, k) for c in "ab" for s in "xyz" for k in range(4)], "dataset string, set string, n int")
    replace_partitions(df, path, ["dataset", "set"])
    before = listing()
    batch = spark.createDataFrame([("a", "y", 100), ("c", "x", 7)], df.schema)
    for _ in range(2):
        replace_partitions(batch, path, ["dataset", "set"])
        got = sorted(tuple(r) for r in spark.read.parquet(path).select("dataset", "set", "n").collect())
        assert got == sorted([tuple(r) for r in df.where("not (dataset = 'a' and set = 'y')").collect()] + [("a", "y", 100), ("c", "x", 7)])
        kept = {f for f in before if not f.startswith("dataset=a/set=y/")}
        assert kept <= listing() and not (before - kept) & listing()
