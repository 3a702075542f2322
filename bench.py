"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed with the no-op sink (every row computed, nothing
collected to the driver). One untimed pass over the headline queries warms the
JVM (JIT, generated code) first; the timed pass follows. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "create_dataset", "interval_support", "clip_list", "clip_assign_rebase", "slice_payload",
    "weighted_split", "entity_split", "split_finalize", "label_profile", "category_summary",
    "check_missing_flag", "file_index", "distribution_std", "subject_age_bins", "merge_replace",
    "copy_manifest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [a for a in sys.argv[1:]] or HEADLINE
    from annolake.session import drop_tables, get_session
    from annolake.plans.queries import QUERIES

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)   # one shuffle partition per core; AQE coalesces
    # warm-up pass (not timed): JIT and whole-stage code generation
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        drop_tables(spark)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
