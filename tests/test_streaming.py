"""Incremental merge over Structured Streaming equals the batch merge."""

import os
import time

from annolake.operators.merge import merge_append, merge_replace
from annolake.streaming.incremental import corpus_view, read_log, start_batch_log

SCHEMA = "set string, recording_filename string, range_onset long, range_offset long"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_replace_equals_batch(spark, tmp_path):
    src, log, ck = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "ck")
    b1 = spark.createDataFrame([("a", "r1", 0, 10), ("a", "r1", 20, 30), ("b", "r2", 0, 5)], SCHEMA)
    b2 = spark.createDataFrame([("a", "r1", 0, 15), ("c", "r3", 1, 2)], SCHEMA)
    b1.coalesce(1).write.parquet(os.path.join(src, "p1"))
    q = start_batch_log(spark, src + "/*", b1.schema, log, checkpoint=ck)
    q.awaitTermination(120)
    time.sleep(0.5)
    b2.coalesce(1).write.parquet(os.path.join(src, "p2"))
    q = start_batch_log(spark, src + "/*", b1.schema, log, checkpoint=ck)
    q.awaitTermination(120)
    lg = read_log(spark, log)
    assert sorted(r.batch_id for r in lg.select("batch_id").distinct().collect()) == [0, 1]
    assert _rows(corpus_view(lg, "set").select(*b1.columns)) == _rows(merge_replace(b1, b2, "set"))
    assert _rows(corpus_view(lg).select(*b1.columns)) == _rows(merge_append(b1, b2))
