"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
Each query is forced with a ``noop`` write (full computation, nothing collected
to the driver).  An untimed warm-up pass runs every query once on the smallest
data set ($BENCH_WARMUP_DIR, default sf0.001) so generated code is compiled
before timing; each query is then timed $BENCH_RUNS times (default 3, fewer
when another round would take more than $BENCH_BUDGET seconds in all) and the
median is reported.  ``value`` is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dws_traffic_pv", "dws_home_detail_uv", "dws_user_login", "dws_keyword_count",
    "dws_sku_order", "dws_province_order", "retract_dedup",
    "cdc_parse", "dim_route", "dwd_route", "upsert_latest",
    "dwd_order_detail", "dwd_payment", "dwd_refund", "dwd_cart_add",
    "log_etl", "is_new_repair", "log_displays",
    "label_user_activity", "label_order_score", "label_age_band", "interval_join_12h",
    "comment_order_join", "moderation_p1", "dedup_exact", "run_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from tillstream.plans.queries import QUERIES
    from tillstream.session import SPREAD_SCANS, build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                                 SPREAD_SCANS: os.environ.get("BENCH_SPREAD", "true")})
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    if warm_dir and os.path.isdir(warm_dir):
        for n in names:
            QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    # Whole rounds over all queries; a further round only if it fits the budget.
    budget = float(os.environ.get("BENCH_BUDGET", "420"))
    taken: dict[str, list[float]] = {n: [] for n in names}
    begin, done = time.time(), 0
    while done < runs and (not done or (time.time() - begin) * (done + 1) / done <= budget):
        for n in names:
            t0 = time.time()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken[n].append(time.time() - t0)
        done += 1
    times = {n: round(statistics.median(ts), 3) for n, ts in taken.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
        "spark": spark.version, "runs": done, "warmup": warm_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
