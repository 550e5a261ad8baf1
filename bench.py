"""Benchmark the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``;
one warm-up run, then the median of ``$BENCH_REPS`` (default 3) timed runs per query,
each forced to completion with a no-op write. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from civicstream.plans.queries import QUERIES  # noqa: E402
from civicstream.session import build_session  # noqa: E402

HEADLINE = ["validate_smart_meters", "dlq_by_reason", "ward_energy", "health_advisories",
            "eta_enriched", "aqi_alerts", "gridlock_alerts", "bunching_alerts", "incidents",
            "latest_per_topic", "dedup"]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    out = {}
    for name in names:
        fn = QUERIES[name]
        run_once(spark, fn, sf_dir)
        out[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
