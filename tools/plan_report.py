"""Write PLANS.md: the executed (AQE final) plan shape of the headline queries.

For each query: file scans, shuffle exchanges (hash / range), reused
exchanges, broadcasts, windows, joins by kind, and the filters pushed to the
parquet scans. Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

QUERIES = ["interval_support", "clip_assign_rebase", "slice_payload", "weighted_split", "entity_split",
           "label_profile", "category_summary", "check_missing_flag", "file_index", "split_finalize",
           "distribution_std", "describe_all_axes", "validation_report", "merge_replace", "copy_manifest", "create_dataset"]


def shape(plan: str) -> dict:
    return {
        "scans": len(re.findall(r"FileScan parquet|Scan parquet", plan)),
        "hash exch": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range exch": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single-part exch": len(re.findall(r"Exchange SinglePartition", plan)),
        "reused": len(re.findall(r"ReusedExchange", plan)),
        "broadcast": len(re.findall(r"BroadcastExchange", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "SMJ": len(re.findall(r"SortMergeJoin", plan)),
        "BHJ": len(re.findall(r"BroadcastHashJoin", plan)),
        "python": len(re.findall(r"FlatMapGroupsInPandas|MapInPandas|ArrowEvalPython|BatchEvalPython", plan)),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from annolake.session import get_session
    from annolake.plans.queries import QUERIES as Q
    spark = get_session("local[8]", 16)
    rows, pushed = [], {}
    for name in QUERIES:
        df = Q[name](spark, sf)
        t0 = time.perf_counter()
        df.collect()
        el = time.perf_counter() - t0
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        rows.append((name, round(el, 2), shape(plan)))
        pushed[name] = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
    keys = list(rows[0][2])
    print("# PLANS\n")
    print(f"Executed (AQE final) plans of the headline queries at `{sf}` on local[8] (tools/plan_report.py).")
    print("Counts are plan nodes; a `reused` exchange is a shuffle computed once and read twice.\n")
    print("| query | sec | " + " | ".join(keys) + " |")
    print("| --- | --- | " + " | ".join("---" for _ in keys) + " |")
    for name, el, s in rows:
        print(f"| {name} | {el} | " + " | ".join(str(s[k]) for k in keys) + " |")
    print("\n## Plan trees with broadcasts off (what large sides look like)\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("interval_support", "weighted_split"):
        df = Q[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        keep = []
        for line in plan.splitlines():
            m = re.match(r"^([\s:+-]*)(?:\*\(\d+\) )?(Exchange \w+\([^)]*\)|ReusedExchange|Window \[[^\]]{0,60}|"
                         r"SortMergeJoin \[[^\]]*\]|HashAggregate\(keys=\[[^\]]*\]|FileScan parquet \[[^\]]*\]|Union)",
                         line)
            if m:
                keep.append(m.group(1) + re.sub(r"#\d+L?", "", m.group(2)))
        print(f"`{name}`:\n\n```\n" + "\n".join(keep) + "\n```\n")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    print("\n## Filters pushed to the parquet scans\n")
    for name, p in pushed.items():
        if p:
            print(f"* `{name}`: " + "; ".join(f"[{x}]" for x in p))
    spark.stop()


if __name__ == "__main__":
    main()
