"""Time the headline queries: one warm-up, then the median of three runs into a noop sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from secflow.plans.queries import registry  # noqa: E402

HEADLINE = [
    "raw_parse", "log_normalize", "log_match_flag", "event_builtin", "event_user_fields", "alarm_single",
    "alarm_windowed", "alarm_windowed_reset", "corr_detail_hits", "corr_threshold", "corr_leak_match", "corr_flow_asof",
    "corr_composite", "flow_json_explode", "appflow_line_parse", "ip_range_filter", "asset_discovery",
    "asset_flow_profile", "asset_app_profile", "asset_subcluster_features", "asset_minmax", "flow_standardize",
    "rules_log_regex"]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("secflow-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            registry()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
