"""Monthly cohorts by first purchase and their retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tradewinds.functions import month_label, month_start, months_apart, share_pct
from tradewinds.plans.revenue import revenue_orders


def active_months(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct person and purchase month, with the person's first month."""
    orders = revenue_orders(fact).filter("purchased_at is not null")
    per_key = orders.select("customer_key", month_start("purchased_at").alias("order_month")).distinct()
    person = customers.filter("customer_unique_id is not null").select("customer_key", "customer_unique_id")
    months = per_key.join(person, "customer_key").select("customer_unique_id", "order_month").distinct()
    # a person has one row per calendar month, so the window stays short
    first = F.min("order_month").over(Window.partitionBy("customer_unique_id"))
    return months.withColumn("cohort_month", first)


def cohort_counts(activity: DataFrame) -> DataFrame:
    """Active people per cohort and months since the first order."""
    index = months_apart("order_month", "cohort_month")
    return activity.groupBy("cohort_month", index.alias("months_since_first_order")).agg(
        F.count("customer_unique_id").alias("active_customers")
    )


def cohort_retention(fact: DataFrame, customers: DataFrame, *, max_index: int | None = 12) -> DataFrame:
    counts = cohort_counts(active_months(fact, customers))
    started = F.when(F.col("months_since_first_order") == 0, F.col("active_customers"))
    sized = counts.withColumn("cohort_size", F.max(started).over(Window.partitionBy("cohort_month")))
    return (
        (sized if max_index is None else sized.filter(F.col("months_since_first_order") <= max_index))
        .select(
            month_label("cohort_month").alias("cohort_label"),
            "cohort_size",
            "months_since_first_order",
            "active_customers",
            share_pct(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate_pct"),
        )
        .orderBy("cohort_label", "months_since_first_order")
    )


def cohort_matrix(retention: DataFrame, *, upto: int = 6) -> DataFrame:
    """One row per cohort, one column per month since the first order."""
    indexes = list(range(upto + 1))
    wide = (
        retention.groupBy("cohort_label")
        .pivot("months_since_first_order", indexes)
        .agg(F.max("retention_rate_pct"))
    )
    named = [F.col(str(i)).alias(f"Month {i}") for i in indexes]
    return wide.select("cohort_label", *named).orderBy("cohort_label")
