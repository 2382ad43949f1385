"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line (seconds, median of three runs)."""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from farebox.session import build_session, remove_scratch
from workloads import QUERIES

HEADLINE = [
    "q7_unified_deduplicated_trips",
    "q8_fact_trips",
    "a8_monthly_zone_revenue",
    "q9_best_green_zone",
    "q11_staged_trips_of_an_interval",
    "q12_daily_report_of_an_interval",
    "q3_biggest_pickup_zone_of_a_day",
    "q6_vendors_in_range_plain",
    "q13_least_frequent_zone",
    "q16_payment_shares",
    "q18_hash_id_merge",
    "w14_messages",
    "t2_tumbling_counts",
    "t3_session_counts",
    "t4_hourly_tips",
    "t2_tumbling_counts_streamed",
    "q19_nearest_vectors_per_label",
]


def run_once(spark, query, sf_dir):
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "farebox-bench", f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={
            "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"file:{tempfile.mkdtemp(prefix='farebox-bench-')}",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run_once(spark, QUERIES[name], sf_dir)
        remove_scratch(spark)
        times[name] = round(statistics.median(run_once(spark, QUERIES[name], sf_dir) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "sum of headline query medians", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
