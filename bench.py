"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads.
Every query runs once to warm up and then BENCH_RUNS times (default 3); the
median is reported. Results are materialised in full through the noop sink.
"""

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from tallylake import catalogue

HEADLINE = (
    "employee_rewards",
    "customer_frustration",
    "first_last_page_report",
    "scd1_merge",
    "scd2_append_versions",
    "scd2_current",
    "product_kpis",
    "product_dimension_kpi",
    "curated_customer_payments",
    "curated_order_lines",
    "curated_orders_products",
    "navigation_curation",
    "viewership_pattern",
    "purchase_funnel",
    "customer_intent",
    "rank_per_group",
    "row_number_global",
    "demand_supply_ratio",
    "top_n_orders",
    "munge",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    work = tempfile.mkdtemp(prefix="run-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallylake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.checkpoint.dir", f"{work}/shared")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalogue.queries()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
