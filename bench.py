"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. Every
query is run once to warm up and then timed once, results written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINES = [
    "hourly_load_features",
    "a1_filtered_session_scan",
    "b0_clean_events",
    "b13_quantile_trim",
    "c1_four_way_join",
    "d4_pivot_two_sums",
    "d5_exact_quantiles",
    "d6_mad_bounds",
    "d9_completeness",
    "d11_describe",
    "d14_repeated_rows",
    "d21_ols_trend",
    "e2_rolling_sums",
    "e5_forward_fill",
    "e6_expanding_mad_flags",
    "e7_c5_frozen_mad_flags",
    "h7_c2_c3_holiday_flags",
    "i1_split_by_hour",
    "j1_autocorrelation",
    "j4_kpss_level",
    "j5_seasonal_decomposition",
    "k1_f2_f_scores",
    "k2_mutual_information",
    "l11_d24_seasonal_naive_errors",
    "l12_holt_winters",
    "m1_streaming_hourly_load",
    "o4_sessions_to_hourly_load",
    "o6_temperature_to_hours",
    "o7_traffic_to_hours",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chronoload-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from registered import all_queries

    queries = all_queries()
    times = {}
    for name in names:
        for _ in range(2):
            begin = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline queries, second run", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
