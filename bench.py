"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and prints one JSON line.

The tables are opened once, as a database would be; every run starts without the views, features
and models that another run has cut.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from dataclasses import replace

from campaignry.catalog import operators, present
from campaignry.session import local_session
from campaignry.sources.star import star_tables

HEADLINE = [
    "campaign_performance", "channel_analysis", "customer_segments", "revenue_roi", "monthly_trends", "ab_test_results",
    "funnel_campaign", "cohort_conversion", "cohort_revenue", "cohort_penetration", "multi_responders", "churn_risk",
    "running_revenue", "segment_percentiles", "conversion_type", "first_touch", "target_audience", "dq_run",
    "constraint_check", "profile_nulls", "dup_rows", "outliers", "corr_matrix", "cvr_by_income_quintile", "exec_summary",
    "build_feature_matrix", "rfm_score_py", "kmeans_fit", "build_ml_dataset", "ml_split",
]


def run(base, name: str) -> float:
    t = replace(base, _memo={})
    t0 = time.perf_counter()
    present(operators()[name](t)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    base = star_tables(spark, folder)
    base.campaign_dim()
    run(base, "campaign_performance")  # JVM warm-up
    times = {}
    for name in names:
        times[name] = round(statistics.median(run(base, name) for _ in range(repeats)), 3)
        print(f"{name:26s} {times[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
