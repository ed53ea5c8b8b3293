"""Benchmark: run the registered queries at one scale factor, print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is executed in full with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  ``layers_build`` is the
time to (re)build the stored dimensions and fact that the marts read.  Every
query first runs once untimed (code generation, JIT, file listing); the
reported time is the median of ``BENCH_RUNS`` warm runs (default 3).
``value`` is the sum of the per-query times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "orders_clean", "order_details_clean", "fact_sales",
    "gold_sales_by_country", "gold_sales_by_country_order_grain",
    "gold_sales_by_category", "gold_sales_by_category_order_grain",
    "gold_sales_by_employee", "gold_sales_by_employee_order_grain",
    "gold_top_products", "gold_top_products_order_grain",
    "gold_kpis", "gold_kpis_order_grain",
    "gold_monthly_trends", "gold_monthly_trends_order_grain",
    "gold_monthly_yoy", "gold_team_summary", "gold_territory_rollup",
    "gold_category_top_bottom", "gold_country_comparison", "gold_order_frequency",
    "gold_orders_by_weekday", "gold_product_net_revenue",
    "dq_not_null", "dq_business_rules", "dq_duplicate_keys", "dq_referential_integrity",
    "dq_quarantine",
    "scd2_history_events", "scd2_apply_batch", "asof_dim_join", "cdc_apply_latest", "snapshot_diff",
    "cdc_upsert_fact", "util_dedupe_first", "fact_partition_roundtrip",
    "ingest_stream_csv", "cdc_stream_apply",
]


def run(spark, fn, base):
    t0 = time.perf_counter()
    fn(spark, base).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main(argv):
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from pyspark.sql import SparkSession

    from strata.queries import QUERIES
    from strata.session import shared_dir

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("strata-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g")
             # one process on one machine, so a local folder is shared by all
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-bench-"))
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    from strata.plans.warehouse import Warehouse

    names = argv or HEADLINE
    times = {}
    # the stored layers (dimensions + partitioned fact) the marts read,
    # rebuilt from the raw tables here so their cost is reported
    Warehouse(spark, base).build_all(force=True)
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        Warehouse(spark, base).build_all(force=True)
        samples.append(time.perf_counter() - t0)
    times["layers_build"] = round(statistics.median(samples), 3)
    for name in names:
        run(spark, QUERIES[name], base)
        samples = [run(spark, QUERIES[name], base) for _ in range(runs)]
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(base).replace("sf", "")
    print(json.dumps({"metric": "sum of per-query wall time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
