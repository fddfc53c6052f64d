"""The whole run: land, validate, clean, load, compare counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tradewinds.operators import quality
from tradewinds.plans.silver import SILVER
from tradewinds.schemas import RAW
from tradewinds.sources import csv_tables, tables


def run_snapshot(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    run_date: dt.date | None = None,
    strict: bool = False,
    skip_silver: bool = False,
    skip_load: bool = False,
) -> DataFrame:
    """Row counts per table after a full run. Without `strict`, tables that fail validation are
    still processed."""
    bronze = f"{target}/bronze"
    landed = csv_tables.land_snapshot(spark, source, bronze, run_date=run_date)
    latest = {name: csv_tables.latest_snapshot(spark, bronze, name).drop("run_date") for name in landed}
    quality.gate(quality.validate_all(spark, latest), strict=strict)

    raw = {name: csv_tables.typed(latest[name], name) for name in RAW}
    silver_folder = f"{target}/silver"
    counts = {}
    for name, (raw_name, job) in SILVER.items():
        path = f"{silver_folder}/{name}.parquet"
        if not skip_silver:
            counts[name] = tables.write_silver(job(raw[raw_name]), silver_folder, name)
        elif csv_tables.path_exists(spark, path):
            counts[name] = None  # counted below from what an earlier run wrote
    written = {name: tables.read_silver(spark, silver_folder, name) for name in counts}
    if skip_silver:
        silver_counts = tables.table_counts(spark, written) if written else spark.createDataFrame([], tables.LOADED)
    else:
        silver_counts = spark.createDataFrame(list(counts.items()), tables.LOADED)
    loaded = None if skip_load else tables.load_all(spark, written)
    bronze_counts = tables.table_counts(spark, {name: latest[raw_name] for name, (raw_name, _) in SILVER.items()})
    return tables.reconcile(bronze_counts, silver_counts, loaded)
