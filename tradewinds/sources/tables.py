"""Saving and loading of silver and warehouse tables, and their row counts side by side."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

LOADED = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("rows", T.LongType()),
])

# silver table -> warehouse table
_log = logging.getLogger(__name__)

WAREHOUSE_NAMES = {
    "orders": "STG_ORDERS", "products": "STG_PRODUCTS", "customers": "STG_CUSTOMERS",
    "sellers": "STG_SELLERS", "payments": "STG_PAYMENTS", "reviews": "STG_REVIEWS",
    "items": "STG_ORDER_ITEMS",
}


def write_silver(df: DataFrame, folder: str, name: str) -> int:
    """Overwrite one silver table as Parquet; returns the rows written, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return seen.get["rows"]


def read_silver(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def warehouse_columns(df: DataFrame) -> DataFrame:
    """Upper-case names, timestamps without zone, booleans as 0 and 1."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name.upper()))
    return df.select(*columns)


def load_table(df: DataFrame, name: str, *, mode: str = "overwrite", folder: str | None = None) -> int:
    """Replace a warehouse table; returns the rows written, counted while writing.

    The table is managed by the catalog unless a folder is given for its files.
    """
    seen = Observation()
    rows = warehouse_columns(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode(mode)
    (writer.option("path", f"{folder}/{name}") if folder else writer).saveAsTable(name)
    return seen.get["rows"]


def load_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    *,
    names: Mapping[str, str] = WAREHOUSE_NAMES,
    folder: str | None = None,
) -> DataFrame:
    """Load every given table. An absent one is skipped, a failing one counts -1, the rest go on.

    Why a table failed is logged.
    """
    results = []
    for table, name in names.items():
        df = tables.get(table)
        if df is None:
            continue
        try:
            results.append((name, load_table(df, name, folder=folder)))
        except Exception:  # any failure of one table must not stop the others
            _log.exception("loading %s failed", name)
            results.append((name, -1))
    return spark.createDataFrame(results, LOADED)


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table; -1 for a table that is absent."""
    parts = []
    for name, df in tables.items():
        counted = (
            spark.createDataFrame([(name, -1)], LOADED) if df is None
            else df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        )
        parts.append(counted)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def reconcile(
    bronze: DataFrame,
    silver: DataFrame,
    loaded: DataFrame | None = None,
    *,
    names: Mapping[str, str] = WAREHOUSE_NAMES,
) -> DataFrame:
    """Raw, silver and loaded rows per table: -1 where raw or silver is missing, 'skipped' or
    'FAILED' for the load. `names` are the loaded tables' names."""
    raw = bronze.select("table", F.col("rows").alias("bronze"))
    clean = silver.select("table", F.col("rows").alias("silver"))
    joined = raw.join(clean, "table", "left")
    if loaded is None:
        joined = joined.withColumn("n", F.lit(None).cast("bigint"))
    else:
        short = F.create_map(*[F.lit(x) for table, name in names.items() for x in (name, table)])[F.col("table")]
        joined = joined.join(loaded.select(short.alias("table"), F.col("rows").alias("n")), "table", "left")
    text = F.when(F.col("n").isNull(), "skipped").when(F.col("n") < 0, "FAILED").otherwise(F.col("n").cast("string"))
    return joined.select("table", "bronze", F.coalesce("silver", F.lit(-1)).alias("silver"), text.alias("loaded"))
