"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8): one warm-up run, then the median of
three timed runs.  A run executes the whole plan into Spark's ``noop`` sink
(nothing is collected to the driver).  Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans import registry  # noqa: E402
from quire.session import build_session  # noqa: E402

HEADLINE = {
    "keyword_search": "c2_search_request",
    "term_join_200": "j5_term_join",
    "lookback_dedup": "j1_lookback_antijoin",
    "dedup_report": "a5_dedup_report",
    "backfill_fold": "backfill_fold_dedup",
    "keyword_stats": "o5_top_keywords",
    "trend_grid": "j6_trend_grid",
    "digest": "s10_digest_lines",
    "json_repair": "x2_ai_fields",
    "reading_list": "o3_reading_list",
    "first_seen": "w1_first_seen",
    "safety_gate": "f13_safety_gate",
}


def run_once(spark, fn, sf_dir) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    registry.load_all()
    # JVM warm-up (class loading, JIT) before any timed query.
    for name in ("c2_search_request", "a5_dedup_report"):
        run_once(spark, registry.QUERIES[name], sf_dir)
    times = {}
    for label, name in HEADLINE.items():
        if only and label not in only:
            continue
        fn = registry.QUERIES[name]
        run_once(spark, fn, sf_dir)  # warm-up
        times[label] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
