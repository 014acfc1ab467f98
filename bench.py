"""Run the headline queries and print one JSON line with their times.

BENCH_SF_DIR  folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_QUERIES comma-separated names (default: the headline queries; ``all`` for every registered query)
"""

from __future__ import annotations

import json
import os
import sys
import time

from forecastops.plans.catalog import QUERIES
from forecastops.session import build_session

HEADLINE = [
    "forecast_metrics",
    "weekly_panel",
    "weekly_rollup",
    "training_features",
    "rolling_family",
    "customer_view",
    "customer_view_pit",
    "product_view",
    "pit_training_set",
    "asof_events",
    "ntile_group",
    "six_way_segments",
    "train_split",
    "temporal_split_8020",
    "revenue_quantiles",
    "feature_histogram",
    "psi_alert",
    "feature_jsd_alert",
    "univariate_drift",
    "metric_rollup",
    "sigma_alert",
    "relative_drift_alert",
    "forecast_vs_sales",
    "grouped_fit",
    "partitioned_score",
    "trial_search",
    "upsert_stored",
    "latest_per_key",
    "feature_latest",
    "daily_monitor",
    "daily_monitor_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "*")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    partitions = str(os.cpu_count() if cpus == "*" else int(cpus))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": partitions,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the first job pays for JVM start-up, not a query
    spark.read.parquet(f"{folder}/nation.parquet").groupBy("n_regionkey").count().collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    sf = folder.rsplit("/sf", 1)[-1]
    out = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
