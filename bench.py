"""Time the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

The `write_` entries write the silver tables, the order fact, the wide order table and the model
features from the given tables; the reports then read those, as they would read saved ones. Every result is written to the no-op sink,
so all columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewinds.operators.materialise import release  # noqa: E402
from tradewinds.queries import QUERIES, context  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

REPORTS = [
    "q1_silver_orders", "q1_silver_payments", "q1_silver_reviews", "w2_dedup_customers", "w2_dedup_products",
    "v4_null_counts", "v5_duplicate_rows", "v6_unparseable_dates", "v14_silver_checks",
    "q2_fact_orders", "j4_items_enriched", "j9_enriched_orders",
    "q3_rfm", "q3_rfm_summary", "q4_cohort_retention", "a36_cohort_matrix",
    "q5_monthly_trend", "a9_quarterly", "a10_revenue_by_state",
    "q6_seller_scorecard", "l4_bottom_sellers", "a12_seller_states",
    "a13_kpis", "a14_orders_per_week", "a19_delivery_histogram", "a20_customer_state_table",
    "a23_delivery_heat", "q7_customer_segments", "a28_seller_leaderboard", "l3_top_sellers", "l5_seller_detail",
    "a33_zip_medians", "q8_features", "m4_medians", "m5_stratified_split", "m7_regression_metrics",
    "m11_classification_metrics", "w9_order_amount_ranks",
    # not in the first round's list
    "s2_payments_csv", "s7_latest_snapshot", "s9_load_all", "v7_validation_reports", "v8_gate", "q2_dim_dates",
]


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-"),  # also for intermediate tables
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tables = context(spark, FOLDER)
    seconds: dict[str, float] = {}

    def clock(name, action) -> None:
        started = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - started, 3)

    spark.read.parquet(f"{FOLDER}/region.parquet").count()  # start-up is not measured
    clock("write_silver", tables.silver_tables)
    clock("write_fact", tables.fact_orders)
    clock("write_enriched", tables.enriched)
    clock("write_features", lambda: tables.features)
    for name in REPORTS:
        clock(name, lambda: QUERIES[name](tables).write.format("noop").mode("overwrite").save())
    release(spark)
    print(json.dumps({
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
