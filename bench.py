"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Every query is run once to warm the JVM up and
then timed, results going to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import all_queries  # noqa: E402

HEADLINE = [
    "daily_ridership", "hourly_ridership", "station_performance", "line_performance", "delay_analysis",
    "delay_summary_by_line", "monthly_trends_seven_years", "daily_kpis", "station_summary", "line_days",
    "avg_delays_per_line", "peak_hours", "on_time_by_line", "top_stations", "delay_causes", "weekend_vs_weekday",
    "borough_traffic", "time_period_performance", "ridership_measures_by_borough", "measures_across_facts",
    "rolling_seven_days", "year_over_year", "clean_stations", "clean_ridership", "clean_delays", "clean_performance",
    "load_stations", "load_ridership", "load_performance", "report_boroughs",
    "daily_ridership_large", "station_performance_large", "top_stations_large", "load_ridership_large",
]


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(run(name), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
