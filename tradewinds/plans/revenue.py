"""Monthly, quarterly and state revenue over the order fact (one row per order)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tradewinds.functions import mean, month_label, month_start, quarter_label, ratio, share_pct
from tradewinds.operators.relational import top_k
from tradewinds.schemas import NOT_REVENUE


def revenue_orders(fact: DataFrame) -> DataFrame:
    return fact.filter(~F.col("order_status").isin(*NOT_REVENUE))


def monthly_base(fact: DataFrame) -> DataFrame:
    """Exact totals per purchase month."""
    orders = revenue_orders(fact).filter("purchased_at is not null")
    return orders.groupBy(month_start("purchased_at").alias("period_start")).agg(
        F.count("order_id").alias("order_count"),
        F.count_distinct("customer_key").alias("unique_customers"),
        F.sum("payment_amount").alias("gmv"),
        mean("payment_amount", 2).alias("avg_order_value"),
        mean("review_score", 2).alias("avg_review_score"),
        ratio(F.count_if("is_late") * 100, F.count(F.lit(1)), 1).alias("late_delivery_pct"),
    )


def with_growth(months: DataFrame) -> DataFrame:
    """Previous month, growth and three-month rolling mean. One row per month, so one task is enough."""
    by_month = Window.orderBy("period_start")
    recent = by_month.rowsBetween(-2, 0)
    previous = F.lag("gmv").over(by_month)
    return months.withColumns({
        "prev_month_gmv": previous,
        "prev_month_orders": F.lag("order_count").over(by_month),
        "mom_gmv_growth_pct": share_pct(F.col("gmv") - previous, previous),
        "rolling_3m_avg_gmv": ratio(F.sum("gmv").over(recent), F.count("gmv").over(recent), 2),
    })


def monthly_trend(fact: DataFrame) -> DataFrame:
    months = with_growth(monthly_base(fact))
    return months.select(
        month_label("period_start").alias("year_month"),
        "order_count", "unique_customers", "gmv", "avg_order_value", "mom_gmv_growth_pct",
        "rolling_3m_avg_gmv", "avg_review_score", "late_delivery_pct",
    ).orderBy("year_month")


def quarterly(fact: DataFrame) -> DataFrame:
    """Orders without a purchase time stay in, as one group without a quarter."""
    groups = revenue_orders(fact).groupBy(
        "order_year", F.quarter("purchased_at").alias("quarter"), quarter_label("purchased_at").alias("year_quarter")
    )
    return groups.agg(
        F.count("order_id").alias("order_count"),
        F.sum("payment_amount").alias("quarterly_gmv"),
        mean("payment_amount", 2).alias("avg_order_value"),
    ).orderBy(F.col("order_year").asc_nulls_last(), F.col("quarter").asc_nulls_last())


def state_revenue(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per customer state with its share. Orders are added up per customer before the join."""
    per_customer = revenue_orders(fact).groupBy("customer_key").agg(
        F.count("order_id").alias("orders"), F.sum("payment_amount").alias("gmv")
    )
    place = customers.select("customer_key", "customer_state", "customer_region")
    states = per_customer.join(place, "customer_key").groupBy("customer_state", "customer_region").agg(
        F.sum("orders").alias("order_count"),
        F.sum("gmv").alias("total_gmv"),
        ratio(F.sum("gmv"), F.sum("orders"), 2).alias("avg_order_value"),
    )
    everything = F.sum("total_gmv").over(Window.partitionBy())  # one row per state
    return states.withColumn("gmv_share_pct", share_pct(F.col("total_gmv"), everything))


def revenue_by_state(fact: DataFrame, customers: DataFrame, *, n: int = 10) -> DataFrame:
    return top_k(state_revenue(fact, customers), "total_gmv", n, tie_break="customer_state")
