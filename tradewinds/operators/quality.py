"""Checks on raw, silver and gold tables. Row checks return the failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradewinds.functions import parse_timestamp
from tradewinds.schemas import DATES, NOT_NULL, NOT_PROGRESSED, RAW

REPORT = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("checks_passed", T.ArrayType(T.StringType())),
    T.StructField("checks_failed", T.ArrayType(T.StringType())),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
])


class CriticalTables(RuntimeError):
    """At least one raw table cannot be used."""


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def trimmed_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def column_difference(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """Missing and extra column names."""
    actual = {c.strip() for c in df.columns}
    return sorted(set(expected) - actual), sorted(actual - set(expected))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: nulls per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def unparseable_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: non-null values per column that are no timestamp."""
    return df.agg(*[
        F.count_if(F.col(c).isNotNull() & parse_timestamp(c).isNull()).alias(c) for c in columns
    ])


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each set of equal rows; nulls equal nulls.

    Copies are counted before the shuffle, so a large set of copies costs one row per task.
    """
    repeated = _repeated_rows(df)
    groups = repeated.groupBy(*_columns(df)).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def _repeated_rows(df: DataFrame) -> DataFrame:
    """Rows whose 64-bit hash occurs more than once: all that can have an equal row, and hardly any other.

    Only hashes are shuffled to find them, and whole rows only if their hash is repeated.
    """
    hashed = df.select("*", F.xxhash64(*_columns(df)).alias("_row_hash"))
    often = hashed.groupBy("_row_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("_row_hash").alias("_often"))
    return hashed.join(often, F.col("_row_hash") == F.col("_often"), "left_semi").drop("_row_hash")


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter("n_records > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Non-null values outside the list, with their counts."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value_field"))
    return counts.agg(F.count(F.lit(1)).alias("n_records")).filter(~F.col("value_field").isin(*accepted))


def negative_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def validate_table(
    df: DataFrame,
    *,
    name: str,
    required: Sequence[str],
    not_null: Sequence[str] = (),
    dates: Sequence[str] = (),
) -> DataFrame:
    """Report of one raw table: a single row with status, passed and failed checks and details.

    Missing columns and an empty table are CRITICAL, any other failed check is FAIL.
    """
    return df.sparkSession.createDataFrame([_report(df, name, required, not_null, dates)], REPORT)


def _outcomes(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    """One row: `rows`, `alike` (rows beyond the first of each row hash) and `n0`, `n1`, ... where a condition holds.

    One scan; rows are added up by hash and by the bits of the conditions they meet before the shuffle,
    so it carries a few bytes a row, however wide the table is.
    """
    bits = [F.when(condition, 1 << i).otherwise(0).cast("bigint") for i, condition in enumerate(conditions)]
    narrow = df.select(F.xxhash64(*_columns(df)).alias("_hash"), sum(bits, F.lit(0).cast("bigint")).alias("_bits"))
    copies = F.col("_copies")
    held = [F.sum(F.when(F.getbit("_bits", F.lit(i)) == 1, copies)) for i in range(len(bits))]
    return narrow.groupBy("_hash", "_bits").agg(F.count(F.lit(1)).alias("_copies")).agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("alike"),
        *[F.coalesce(n, F.lit(0)).alias(f"n{i}") for i, n in enumerate(held)],
    )


def _report(df: DataFrame, name: str, required: Sequence[str], not_null: Sequence[str], dates: Sequence[str]) -> tuple:
    missing, extra = column_difference(df, required)
    if missing:
        return _critical(name, f"{name}: missing expected columns {', '.join(missing)}")

    df = trimmed_names(df)
    keys = [c for c in not_null if c in df.columns]
    parsed = [c for c in dates if c in df.columns]
    conditions = [F.col(c).isNull() for c in keys]
    conditions += [F.col(c).isNotNull() & parse_timestamp(c).isNull() for c in parsed]
    counted = _outcomes(df, conditions).first()
    rows, found = counted["rows"], counted[2:]
    if not rows:
        return _critical(name, f"Empty file: {name}")
    # equal rows have equal hashes; whether rows of one hash are equal is looked up only if there are any
    copies = duplicate_rows(df).first()[0] if counted["alike"] else 0

    def listing(columns: Sequence[str], counts: Sequence[int], note: str) -> str:
        return ", ".join(f"{c} ({n} {note})" for c, n in zip(columns, counts) if n)

    nulls = listing(keys, found[:len(keys)], "null")
    unparseable = listing(parsed, found[len(keys):], "unparseable")
    checks = {
        "file_exists": True, "csv_readable": True, "row_count_gt_zero": True, "column_names_match": True,
        "no_key_nulls": not nulls, "no_full_duplicates": not copies, "date_columns_parseable": not unparseable,
    }
    details = {
        "row_count": str(rows), "extra_columns": ", ".join(extra), "null_counts": nulls,
        "duplicate_rows": str(copies), "unparseable_dates": unparseable,
    }
    return (
        name, "PASS" if all(checks.values()) else "FAIL", rows,
        [check for check, ok in checks.items() if ok], [check for check, ok in checks.items() if not ok],
        {key: value for key, value in details.items() if value},
    )


def _critical(name: str, error: str) -> tuple:
    return (name, "CRITICAL", 0, [], ["critical_error"], {"error": error})


def validate_all(spark: SparkSession, tables: Mapping[str, DataFrame | None], *, at_a_time: int = 4) -> DataFrame:
    """Reports of every raw table; a table that is absent or cannot be read is CRITICAL.

    Tables are checked beside each other, and a table that fails leaves the others alone.
    """
    def report(name: str) -> tuple:
        df, schema = tables.get(name), RAW[name]
        if df is None:
            return _critical(name, f"Expected table not found: {name}")
        try:
            return _report(df, name, schema.names, NOT_NULL.get(name, []), DATES.get(name, []))
        except Exception as error:  # whatever keeps Spark from reading it is the finding
            return _critical(name, f"Cannot read {name}: {error}")

    with ThreadPoolExecutor(at_a_time) as pool:
        reports = list(pool.map(inheritable_thread_target(spark)(report), RAW))
    return spark.createDataFrame(reports, REPORT)


def summary_line(reports: DataFrame) -> DataFrame:
    """One readable line per report."""
    text = F.concat(
        F.lit("["), F.col("status"), F.lit("] "), F.col("file_name"),
        F.lit(" | rows="), F.col("row_count").cast("string"),
        F.lit(" | passed="), F.size("checks_passed").cast("string"),
        F.lit(" | failed="), F.size("checks_failed").cast("string"),
    )
    return reports.select("file_name", text.alias("summary"))


def gate(reports: DataFrame, *, strict: bool = True) -> list[str]:
    """Names of tables that did not pass; a strict gate stops on a CRITICAL one."""
    flagged = reports.filter("status <> 'PASS'").select("file_name", "status").collect()  # one row a table
    critical = sorted(r["file_name"] for r in flagged if r["status"] == "CRITICAL")
    if strict and critical:
        raise CriticalTables(f"critical validation failures: {', '.join(critical)}")
    return sorted(r["file_name"] for r in flagged)


def silver_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failing rows per check over the silver tables; every count is 0 when the data is sound.

    All row checks of a table are counted in one pass.
    """
    row_checks = {
        "orders": {
            "orders.order_id not null": F.col("order_id").isNull(),
            "orders.customer_id not null": F.col("customer_id").isNull(),
            "orders.delivery_days not negative": F.col("delivery_days") < 0,
            "orders without dropped statuses": F.col("order_status").isin(*NOT_PROGRESSED),
        },
        "products": {"products.product_id not null": F.col("product_id").isNull()},
        "customers": {"customers.customer_id not null": F.col("customer_id").isNull()},
        "sellers": {"sellers.seller_id not null": F.col("seller_id").isNull()},
        "payments": {
            "payments.order_id not null": F.col("order_id").isNull(),
            "payments.total_payment positive": F.col("total_payment") <= 0,
        },
        "reviews": {
            "reviews.review_id not null": F.col("review_id").isNull(),
            "reviews.order_id not null": F.col("order_id").isNull(),
        },
    }
    parts = []
    for table, checks in row_checks.items():
        counted = {name: F.count_if(failing) for name, failing in checks.items()}
        counted[f"{table} not empty"] = (F.count(F.lit(1)) == 0).cast("bigint")
        outcome = [F.struct(F.lit(name).alias("check"), n.alias("failing_rows")) for name, n in counted.items()]
        parts.append(tables[table].agg(F.array(*outcome).alias("outcome")).select(F.inline("outcome")))
    for table, key in [("products", "product_id"), ("reviews", "order_id")]:
        repeated = not_unique(tables[table], key).agg(F.count(F.lit(1)).alias("failing_rows"))
        parts.append(repeated.select(F.lit(f"{table}.{key} unique").alias("check"), "failing_rows"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
