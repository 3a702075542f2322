"""Stored partial islands against the support of everything, and dense stretches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from annolake.operators.intervals import assign_to_clip, partial_islands, support, support_in_recording
from annolake.operators.island_store import IslandStore
from annolake.streaming.incremental import start_island_store


def data(spark, n=900, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        s = rng.randint(-50, 4000)
        rows.append((k, rng.choice(["hot", "hot", "hot", "a", "b", None, f"r{k % 40}"]), s, s + rng.choice([0, 1, 5, 30, 400])))
    return spark.createDataFrame(rows, "id long, recording string, start long, end long").repartition(5)


def found(df):
    return sorted((str(r.recording), r.start, r.end) for r in df.collect())


@pytest.mark.parametrize("collar", [0, 12])
def test_three_batches_equal_the_full_support(spark, tmp_path, collar):
    df = data(spark)
    store = IslandStore(spark, str(tmp_path / "s"), collar=collar, chunk=100, buckets=8)
    for k in range(3):
        store.add(df.where(F.col("id") % 3 == k), k)
    store.add(df.where(F.col("id") % 3 == 1), 1)                 # a retried batch
    want = found(support(df, ["recording"], collar=collar, chunk=100))
    assert found(store.islands()) == want
    assert found(store.compact(str(tmp_path / "c")).islands()) == want
    few = spark.createDataFrame([(9001, "a", 10, 5000), (9002, None, 7, 9)], df.schema)
    new = [r for r in found(support(df.unionByName(few), ["recording"], collar=collar, chunk=100)) if r[0] in ("a", "None")]
    assert found(store.renew(few, 3)) == new


def test_only_touched_buckets_are_read(spark, tmp_path):
    df = data(spark)
    store = IslandStore(spark, str(tmp_path / "s"), buckets=16)
    store.add(df, 0)
    keys = store.add(df.where("recording = 'a'").limit(2), 1)
    part = store.partials(keys)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ = \d", plan), plan
    assert {r.recording for r in part.collect()} == {"a"} and part.select("bucket").distinct().count() == 1


def test_a_stream_fills_the_store(spark, tmp_path):
    df = data(spark, 300)
    for k in range(2):
        df.where(F.col("id") % 2 == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    store = IslandStore(spark, str(tmp_path / "s"), chunk=200, buckets=4)
    q = start_island_store(stream, store, str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert q.exception() is None
    assert found(store.islands()) == found(support(df, ["recording"]))


def test_a_dense_minute_is_spread(spark):
    """A third of all rows begin within one minute of one recording: what meets in one task is bounded by the clock, not by the rows."""
    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("recording"),
        F.when(F.col("id") % 3 == 0, F.xxhash64("id") % 500 + 30_000).otherwise(F.pmod(F.xxhash64("id"), F.lit(80_000_000))).alias("start"))
    df = df.withColumn("end", F.col("start") + 3)
    part = partial_islands(df, ["recording"])
    at_most = part.groupBy("_scan_key", "_scan_ck").count().agg(F.max("count")).first()[0]
    assert at_most <= 60_000
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_max" in plan
    clips = spark.createDataFrame([("hot", 0, 40_000), ("hot", 50_000, 60_000), ("r1", 0, 10**9)], "recording string, start long, end long")
    ann = df.withColumnsRenamed({"start": "range_onset", "end": "range_offset"})
    inside, outside = assign_to_clip(ann, clips, key="recording")
    want = df.where("(recording = 'hot' and (start between 0 and 39997 or start between 50000 and 59997)) or recording = 'r1'").count()
    assert inside.count() == want and outside.count() == n - want


def test_collar_after_the_crop(spark):
    """A gap outside the recording bridges nothing; the rows never join the recordings."""
    rows = [("r", 0, 10), ("r", 95, 98), ("r", 101, 140), ("r", 12, 20), ("q", 5, 6), ("r", -9, -1), ("r", 30, 95)]
    df = spark.createDataFrame(rows, "recording string, start long, end long")
    rec = spark.createDataFrame([("r", 100), ("x", 5)], "recording string, duration long")
    assert found(support_in_recording(df, rec, collar=5)) == [("r", 0, 20), ("r", 30, 98)]
    assert found(support_in_recording(df, rec, collar=11)) == [("r", 0, 98)]
