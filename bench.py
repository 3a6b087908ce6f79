"""Time the headline queries; prints one JSON line with the median of three runs.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. The
sales lines are first written as delimited text, which is not timed: that file
is what a load is given. `load` is the whole way from that text to the finished
star schema. Queries on the warehouse read what it wrote; those on raw lines
make the text anew from the tables, which is part of their time.
"""

import json
import os
import tempfile
import time
from statistics import median

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

QUERIES = [
    "top_products",
    "sales_summary",
    "customer_stats",
    "count_sales",
    "recent_sales",
    "customer_count",
    "product_count",
    "net_revenue_by_type",
    "quality_suite",
    "quality_anomalies",
    "quality_trend_summary",
    "check_constraints",
    "referential_integrity",
    "product_consolidation",
    "customer_scd2_history",
    "scd2_as_of",
    "change_archive",
    "ingest_metrics",
    "line_verdict",
    "dedup_keep_first",
    "iqr_bounds",
    "incremental_load",
]
RUNS = 3


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from tallyhouse.plans import registry
    from tallyhouse.plans.warehouse import Warehouse
    from tallyhouse.session import new_folder
    from tallyhouse.sources.files import read_csv

    registry.tune(spark)
    text = new_folder(spark, "csv")
    registry.write_text(registry.sales_view(spark, SF_DIR), text)

    def load(lines: str) -> Warehouse:
        house = Warehouse(spark, new_folder(spark, "warehouse"))
        house.load(read_csv(spark, lines), registry.CHECKS, registry.BATCH, registry.LOADED_AT)
        return house

    # Compiles what every run needs; not timed.
    small = new_folder(spark, "csv")
    registry.write_text(registry.sales_view(spark, SF_DIR).filter("seq % 50 = 0"), small)
    load(small)

    seconds, runs = {}, []
    for _ in range(RUNS):
        begun = time.perf_counter()
        house = load(text)
        runs.append(time.perf_counter() - begun)
    seconds["load"] = median(runs)
    lines = house.judged().count()
    registry.use_warehouse(spark, SF_DIR, house)
    for name in QUERIES:
        runs = []
        for _ in range(RUNS):
            begun = time.perf_counter()
            registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begun)
        seconds[name] = median(runs)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "load and query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "load_lines_per_sec": round(lines / seconds["load"]),
            }
        )
    )


if __name__ == "__main__":
    main()
