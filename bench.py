"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
rows shipped to the driver), once to warm up and then 3 times; the median is
reported. The streaming flow (5 time slices, every layer drained after each)
is timed once. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "q1_distinct_conditions", "q2_distinct_conditions_per_city", "q3_condition_rank", "q4_avg_temperature",
    "q5_hottest_city", "q6_daily_top_variation", "q7_max_variation", "q8_strongest_wind",
    "curated_city", "curated_observation", "json_landing_load", "merge_condition_frequency",
    "merge_avg_exact", "merge_avg_halving", "merge_daily_variation", "merge_city", "cdc_snapshot_diff",
    "dq_unique", "dq_foreign_key", "surrogate_key", "curated_observation_keyed", "table_scan", "table_scan_period",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    with_stream = os.environ.get("BENCH_STREAM", "1") != "0"

    from cirrus.plans import catalog
    from cirrus.session import build_session

    spark = build_session(f"local[{cpus}]", app="cirrus-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "8g"})
    queries: dict[str, float] = {}
    for name in HEADLINE:
        fn = catalog.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        queries[name] = round(statistics.median(times), 3)
    batch_total = round(sum(queries.values()), 3)
    if with_stream:
        t0 = time.perf_counter()
        catalog._flow(spark, sf_dir)
        queries["stream_flow_5_slices"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": batch_total, "unit": "sec",
                      "queries": queries, "sf": sf, "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
