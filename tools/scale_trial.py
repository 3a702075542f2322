"""Scaling trial: interval queries on event tables derived from the given sf0.1
events (copies with re-keyed users, a skewed copy where one recording holds
a third of all rows, and one where that third begins within one minute). Writes the derived tables to a scratch folder given on the
command line. Prints one line per (variant, query): rows, seconds, and the
longest task of the run (from the listener-free event log is not needed: we
report wall time and output rows)."""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    scratch = sys.argv[1]
    src = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F
    from annolake.session import get_session
    from annolake.plans.queries import QUERIES
    spark = get_session("local[8]", 16)
    ev = spark.read.parquet(f"{src}/events.parquet")
    n_ev = ev.count()
    variants = {}
    for k in (1, 4, 16):
        copies = [ev.withColumn("user_id", F.col("user_id") + F.lit(i * 1_000_000))
                    .withColumn("event_id", F.col("event_id") + F.lit(i * n_ev)) for i in range(k)]
        df = copies[0]
        for c in copies[1:]:
            df = df.unionByName(c)
        variants[f"x{k}"] = df
    # skew: 16 copies, and in every copy a third of the events move to user 0
    # (one recording then holds a third of all rows, spread over its 29 days)
    variants["x16_hot"] = variants["x16"].withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    # density: that third begins within one minute of user 0's recording
    variants["x16_minute"] = variants["x16_hot"].withColumn("ts", F.when(F.col("event_id") % 3 == 0, F.expr(
        "timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, cast(pmod(xxhash64(event_id), 60000) / 1000 as decimal(18, 6)))"))
        .otherwise(F.col("ts").cast("timestamp_ntz")))
    for name, df in variants.items():
        d = f"{scratch}/{name}"
        df.write.mode("overwrite").parquet(f"{d}/events.parquet")
        for q in ("interval_support", "clip_assign_rebase"):
            out = QUERIES[q](spark, d)
            t0 = time.perf_counter()
            out.write.format("noop").mode("overwrite").save()
            el = time.perf_counter() - t0
            rows = spark.read.parquet(f"{d}/events.parquet").count()
            print(f"{name}\t{q}\tinput_rows={rows}\tsec={el:.2f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
