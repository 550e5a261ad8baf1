"""Summarize the physical plan of every registered batch query (markdown table).

usage: python tools/plan_report.py [sf_dir]
Counts shuffles and join strategies, lists the columns each Parquet scan reads and
its pushed filters, and flags nested-loop / cartesian joins. Detector queries
materialize intermediates while being built, so their plan starts at checkpoints.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civicstream.plans.queries import QUERIES  # noqa: E402
from civicstream.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    return {
        "exchanges": plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition")
        + plan.count("Exchange rangepartitioning") + plan.count("Exchange RoundRobin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "shj": plan.count("ShuffledHashJoin"),
        "bnlj": plan.count("BroadcastNestedLoopJoin"),
        "cartesian": plan.count("CartesianProduct"),
        "window_limit": plan.count("WindowGroupLimit"),
        "scans": sorted({", ".join(sorted(re.sub(r"#\d+L?", "", c).split(","))) for c, _ in scans}),
        "pushed": sorted({p for _, p in scans if p}),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    print("| query | shuffles | broadcast hash | sort-merge | nested loop | top-k limit | scan columns |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        p = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarize(p)
        cols = "; ".join(s["scans"]) or "(materialized)"
        print(f"| {name} | {s['exchanges']} | {s['bhj']} | {s['smj']} | {s['bnlj']} | "
              f"{s['window_limit']} | {cols} |")


if __name__ == "__main__":
    main()
