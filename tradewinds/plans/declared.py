"""The declared tests of sources, staging and star schema, compiled to one aggregate per table.

Every tested column of a table becomes rows (column, key), counted together: a null key counts nulls, a
key with more than one row is repeated, a key outside a list is not accepted. So each table is read once
and shuffled once, however many tests it has, and counts are added up before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F

from tradewinds.operators.quality import CriticalTables
from tradewinds.schemas import FACT_STATUSES, REGIONS, SCORES

KEY = ("unique", "not_null")
PRESENT = ("not_null",)

# Fixed: which columns are tested, and for what; a list of values is the third kind of test.
DECLARED: dict[str, dict[str, Sequence]] = {
    "source.orders": {"order_id": KEY, "customer_id": PRESENT, "order_status": [[*FACT_STATUSES, "unavailable", "created"]]},
    "source.customers": {"customer_id": KEY, "customer_unique_id": PRESENT},
    "source.products": {"product_id": KEY},
    "source.sellers": {"seller_id": KEY},
    "source.payments": {"order_id": KEY, "total_payment": PRESENT},
    "source.reviews": {"review_id": KEY, "order_id": KEY},
    "staging.orders": {"order_id": KEY, "customer_id": PRESENT},
    "staging.customers": {"customer_id": KEY, "customer_unique_id": PRESENT},
    "staging.products": {"product_id": KEY},
    "staging.sellers": {"seller_id": KEY},
    "staging.payments": {"order_id": KEY, "payment_amount": PRESENT},
    "staging.reviews": {"review_id": KEY, "order_id": KEY, "review_score": [SCORES]},
    "gold.fact_orders": {
        "order_key": KEY, "order_id": KEY, "customer_key": PRESENT, "date_key": PRESENT, "payment_amount": PRESENT,
        "order_status": [FACT_STATUSES],
    },
    "gold.dim_customers": {"customer_key": KEY, "customer_id": KEY, "customer_unique_id": PRESENT, "customer_region": [REGIONS]},
    "gold.dim_sellers": {"seller_key": KEY, "seller_id": KEY},
    "gold.dim_products": {"product_key": KEY, "product_id": KEY},
    "gold.dim_dates": {"date_key": KEY, "full_date": KEY},
    "gold.dim_payment": {"payment_key": KEY},
}
RESULT = "`table` string, `column` string, test string, failing long"


def _kind(test) -> str:
    return test if isinstance(test, str) else "accepted_values"


def table_tests(df: DataFrame, tests: Mapping[str, Sequence]) -> DataFrame:
    """(column, test, failing): nulls, values that occur more than once, or rows with a value that is not accepted."""
    def key(column: str) -> Column:
        text = F.col(column).cast("string")
        return text if tuple(tests[column]) != PRESENT else F.when(text.isNotNull(), "")

    cells = F.array(*[F.struct(F.lit(c).alias("column"), key(c).alias("key")) for c in tests])
    counts = df.select(F.inline(cells)).groupBy("column", "key").agg(F.count(F.lit(1)).alias("n"))

    def failing(column: str, test) -> Column:
        mine = F.col("column") == column
        if test == "not_null":
            return F.sum(F.when(mine & F.col("key").isNull(), F.col("n")))
        known = mine & F.col("key").isNotNull()
        if test == "unique":
            return F.count_if(known & (F.col("n") > 1))
        return F.sum(F.when(known & ~F.col("key").isin(*map(str, test)), F.col("n")))

    outcome = [
        F.struct(
            F.lit(column).alias("column"), F.lit(_kind(test)).alias("test"),
            F.coalesce(failing(column, test), F.lit(0)).cast("bigint").alias("failing"),
        )
        for column, listed in tests.items() for test in listed
    ]
    return counts.agg(F.array(*outcome).alias("outcome")).select(F.inline("outcome"))


def run_tests(tables: Mapping[str, DataFrame], declared: Mapping[str, Mapping[str, Sequence]] = DECLARED) -> DataFrame:
    """One row per declared test. The tables do not depend on each other, so their jobs are submitted together."""
    def one(name: str) -> list[tuple]:
        return [(name, *row) for row in table_tests(tables[name], declared[name]).collect()]  # a row a test

    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(8) as pool:
        rows = [row for part in pool.map(one, declared) for row in part]
    return spark.createDataFrame(rows, RESULT)


def stop_on_failures(results: DataFrame, *, strict: bool = True) -> list[str]:
    """Tables with a failing test; a strict gate stops on them."""
    failed = sorted(r["table"] for r in results.filter("failing > 0").select("table").distinct().collect())  # one row a table
    if strict and failed:
        raise CriticalTables(f"declared tests fail: {', '.join(failed)}")
    return failed
