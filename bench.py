"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs to completion into the no-op sink (full execution, nothing
collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from abx.plans.queries import QUERIES  # noqa: E402
from abx.session import build_session  # noqa: E402

HEADLINE = [
    "user_day_metrics", "assign_multi", "assign_quota", "ratio_test", "daily_ttest",
    "experiment_results", "overall_ttest", "active_rate_ztest", "active_rate", "average_duration",
    "user_day_filled", "aa_test", "sample_progress", "experiment_overlap", "duration_ttest",
    "one_hot", "listing_features", "user_key_unique", "price_model", "score_by_group", "stream_user_day_metrics", "stream_assign",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Warm-up (JVM JIT, Python workers for the tail-probability UDFs) is not timed.
    QUERIES["all_test_results"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
