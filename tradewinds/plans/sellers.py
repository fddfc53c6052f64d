"""Seller scorecard, rankings and state summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewinds.functions import mean, ratio
from tradewinds.operators.materialise import Scope, materialise
from tradewinds.operators.ordered import join_ranks, value_ranks
from tradewinds.operators.relational import top_k
from tradewinds.plans.revenue import revenue_orders


def seller_lines(items: DataFrame) -> DataFrame:
    """Items added up per seller and order."""
    return items.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("price").alias("priced"),
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight"),
    )


def seller_metrics(
    fact: DataFrame, items: DataFrame, sellers: DataFrame, *, grain: str = "item"
) -> DataFrame:
    """Orders, revenue, reviews and punctuality per seller.

    `grain="item"` counts a late order once per item, as the on-time rate is defined; it can
    therefore fall below zero. `grain="order"` counts each late order once.

    Items are added up per seller and order first: that makes the number of orders a plain count
    and leaves one row per seller and order for the join.
    """
    return metrics_of_lines(fact, seller_lines(items), sellers, grain=grain)


def metrics_of_lines(fact: DataFrame, lines: DataFrame, sellers: DataFrame, *, grain: str = "item") -> DataFrame:
    orders = revenue_orders(fact).select("order_id", "review_score", "delivery_days", "is_late")
    weight = F.col("lines") if grain == "item" else F.lit(1)

    def weighted(column: str) -> Column:
        return F.sum(F.col(column) * F.col("lines"))

    def present(column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("lines"))), F.lit(0))

    totals = lines.join(orders, "order_id").groupBy("seller_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("price").alias("total_revenue"),
        ratio(F.sum("price"), F.sum("priced"), 2).alias("avg_item_price"),
        F.sum("freight").alias("total_freight"),
        ratio(weighted("review_score"), present("review_score"), 2).alias("avg_review_score"),
        present("review_score").alias("review_count"),
        ratio(weighted("delivery_days"), present("delivery_days"), 1).alias("avg_delivery_days"),
        F.sum(F.when(F.col("is_late"), weight).otherwise(0)).alias("late_orders"),
    )
    on_time = ratio((F.col("total_orders") - F.col("late_orders")) * 100, F.col("total_orders"), 2)
    place = sellers.select("seller_id", "seller_city", "seller_state", "seller_region")
    return place.join(totals.withColumn("on_time_rate_pct", on_time), "seller_id")


def with_reliability(metrics: DataFrame) -> DataFrame:
    """Score out of 100: 40 for reviews, 40 for punctuality, 20 for volume on a log scale."""
    most = metrics.agg(F.max("total_orders")).scalar()
    exact = F.coalesce("avg_review_score", F.lit(0)) * 8 + F.coalesce("on_time_rate_pct", F.lit(0)) * F.lit(0.4).cast("decimal(2,1)")
    volume = F.try_divide(F.log(F.col("total_orders") + 1), F.log(most + 1)) * 20
    score = F.round(exact.cast("double") + volume, 2)
    return metrics.withColumn("reliability_score", score.cast("decimal(18,2)"))


def scored_sellers(
    fact: DataFrame, items: DataFrame, sellers: DataFrame, *, grain: str = "item"
) -> DataFrame:
    """Every seller with its metrics and score, without ranks.

    Lines are written on the way, so that their two large shuffles do not lie on the disks together.
    """
    with Scope(items.sparkSession) as scope:
        lines = materialise(seller_lines(items), lean=True)
        metrics = scope.keep(materialise(metrics_of_lines(fact, lines, sellers, grain=grain), lean=True))
    return with_reliability(metrics)


def seller_scorecard(
    fact: DataFrame, items: DataFrame, sellers: DataFrame, *, grain: str = "item"
) -> DataFrame:
    """Every seller with its metrics, score and five ranks; a missing metric ranks first."""
    scored = scored_sellers(fact, items, sellers, grain=grain)
    columns = {
        "revenue_rank": ("total_revenue", "rank"),
        "volume_rank": ("total_orders", "rank"),
        "review_rank": ("avg_review_score", "dense_rank"),
        "ontime_rank": ("on_time_rate_pct", "rank"),
        "reliability_rank": ("reliability_score", "rank"),
    }
    ranks = value_ranks(scored, [metric for metric, _ in columns.values()], descending=True)
    ranked = join_ranks(scored, ranks, columns)
    return ranked.select(
        "seller_id", "seller_city", "seller_state", "seller_region", "total_orders", "total_revenue",
        "avg_item_price", "total_freight", "avg_review_score", "review_count", "avg_delivery_days",
        "late_orders", "on_time_rate_pct", "reliability_score", *columns,
    ).orderBy("reliability_rank", "seller_id")


def bottom_sellers(scored: DataFrame, n: int = 10) -> DataFrame:
    worst = top_k(scored, "reliability_score", n, tie_break="seller_id", descending=False)
    return worst.select(
        "seller_id", "seller_state", "reliability_score", "avg_review_score", "on_time_rate_pct", "total_orders"
    )


def seller_states(scored: DataFrame) -> DataFrame:
    """Sellers per state, ranked by mean review score; a state without reviews ranks first."""
    states = scored.groupBy("seller_state", "seller_region").agg(
        F.count("seller_id").alias("seller_count"),
        mean("avg_review_score", 2).alias("state_avg_review"),
        mean("on_time_rate_pct", 2).alias("state_ontime_pct"),
        F.sum("total_revenue").alias("state_total_revenue"),
        mean("avg_review_score").alias("_mean"),
    )
    by_review = Window.orderBy(F.col("_mean").desc_nulls_first())  # one row per state
    ranked = states.withColumn("state_review_rank", F.rank().over(by_review)).drop("_mean")
    return ranked.orderBy(F.col("state_avg_review").desc_nulls_first(), "seller_state")
