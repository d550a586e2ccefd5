"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores.  Each query runs twice into a sink
that discards rows; ``queries`` holds the second run, ``first_run`` the first one and
``duckdb`` the time of the equivalent SQL on the same files.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

HEADLINE = [
    "bars_with_quotes", "agg_hourly_buckets", "agg_month_buckets", "agg_tick_buckets", "agg_vwap", "agg_moments",
    "running_cumulative", "sliding_arrival_and_exit", "sliding_min_max", "first_last_ticks", "num_distinct",
    "median", "percentile_rows", "ranking_order", "tw_average", "cumsum_global", "lag_lead", "fill_forward",
    "join_by_time_default", "join_by_time_inner", "aggregated_window_time", "join_with_query_window", "interval_join",
    "point_in_time", "coalesce_feeds", "diff_series", "lee_and_ready", "ob_snapshot", "pnl_realized",
    "recipe_effective_spread", "recipe_markouts", "text_search", "date_parts",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from oracle import connect
    from tickloom.plans import ORACLE, QUERIES

    names = sys.argv[1:] or HEADLINE
    con = connect(sf)
    first, second, duck = {}, {}, {}
    for name in names:
        for times in (first, second):
            t = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t, 3)
        if name in ORACLE:
            t = time.perf_counter()
            con.execute(ORACLE[name]).fetchall()
            duck[name] = round(time.perf_counter() - t, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(second.values()), 3), "unit": "sec",
        "queries": second, "first_run": first, "duckdb": duck, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
