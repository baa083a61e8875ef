"""Time the headline queries and print one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from scdflow.plans import catalog
from scdflow.sources.testdata import Tables

HEADLINE = [
    "daily_revenue",
    "revenue_by_grain",
    "top_products",
    "top_customers",
    "sales_by_category",
    "dim_customer_scd2",
    "dim_product_scd2",
    "dim_customer_from_cdc",
    "fact_orders_load",
    "fact_orders_asof",
    "cdc_op_counts",
    "validate_products",
    "failed_upsert",
    "failed_summary",
    "recent_changes",
    "cdc_stats",
    "order_totals",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scdflow-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    by_name = {run.__name__: run for run in catalog.QUERIES}
    # Start-up of the JVM and of the readers is not part of any query.
    tables.read("lineitem").write.format("noop").mode("overwrite").save()
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds = {}
    for name in chosen:
        started = time.perf_counter()
        by_name[name](tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
