"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seriesloom.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "w30_feature_set", "w30_feature_set_mixed", "w30_feature_set_rows", "w03_moving_average", "w13_strength_index",
    "w16_increase_runs_rows", "w18_recursive_average_rows", "t01_align_to_weekday", "t05_monthly_to_weekly", "t07_interpolate_rows",
    "j01_star_join_weekly", "j02_star_join_monthly", "a01_report_metrics", "a17_five_numbers_by_weekday", "k01_pivot_forecasts",
    "b01_expanding_folds", "b04_growing_folds", "f08_recursive_forecast", "f14_autoregression", "f15_smoothing", "x04_spearman_rows",
    "x09_hurst", "x10_dominant_cycle", "x13_decompose", "e06_bin_probabilities",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("seriesloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small query first, so that starting the engine is not charged to the first headline.
    QUERIES["w01_lags"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
