"""The wide order table and the aggregations of the dashboard pages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewinds.functions import (
    is_good_review, late_label, mean, month_label, plain_mean, ratio, short_id, state_name, state_region,
)
from tradewinds.operators.materialise import materialise
from tradewinds.operators.ordered import rank_borders, value_ranks
from tradewinds.operators.relational import keep_listed, top_k

BOUGHT = "order_purchase_timestamp"


ITEM_COLUMNS = ["product_id", "seller_id", "price", "freight_value"]


def item_place() -> Column:
    """Total order of the items of an order, by number; it carries the values picked from them."""
    unnumbered = F.col("order_item_id").isNull().alias("unnumbered")
    return F.struct(unnumbered, "order_item_id", *ITEM_COLUMNS).alias("place")


def first_item_places() -> list[Column]:
    """Aggregates per order over `place`: for each column the first item that has a value for it."""
    place = F.col("place")
    return [F.min(F.when(place[c].isNotNull(), place)).alias(c) for c in ITEM_COLUMNS]


def first_item_values() -> list[Column]:
    return [F.col(c)[c].alias(c) for c in ITEM_COLUMNS]


def first_items(items: DataFrame) -> DataFrame:
    """Per order, each column's first non-null value by item number. Aggregated, never windowed:
    an order with very many items costs one row per task before the shuffle."""
    placed = items.filter("order_id is not null").select("order_id", item_place())
    return placed.groupBy("order_id").agg(*first_item_places()).select("order_id", *first_item_values())


def with_sellers_and_products(lines: DataFrame, sellers: DataFrame, products: DataFrame) -> DataFrame:
    """Seller and product columns next to each order's first item: rows without orders' other columns,
    and without orders that have no item, so no null key gathers them in one task."""
    return lines.join(sellers, "seller_id", "left").join(products, "product_id", "left")


def customer_of_order(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer columns by order, from rows of two keys. An order without id is not in it, as it is in
    no other table of orders either."""
    keys = orders.filter("order_id is not null").select("order_id", "customer_id")
    return keys.join(customers, "customer_id").drop("customer_id")


def enriched_orders(silver: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order with payment, review, customer state, first item, its seller and product.

    Lookups by other keys are attached to narrow rows first, so the wide order moves once, by order.
    """
    customer = silver["customers"].select("customer_id", "customer_state")
    seller = silver["sellers"].select("seller_id", "seller_state")
    product = silver["products"].select(
        "product_id", "product_weight_g", "product_volume_cm3", "product_photos_qty"
    )
    return (
        silver["orders"]
        .join(silver["payments"], "order_id", "left")
        .join(silver["reviews"].select("order_id", "review_score"), "order_id", "left")
        .join(with_sellers_and_products(first_items(silver["items"]), seller, product), "order_id", "left")
        .join(customer_of_order(silver["orders"], customer), "order_id", "left")
        .withColumn("is_good_review", is_good_review("review_score"))
    )


# ---- filters ----------------------------------------------------------------------------------

def bought(df: DataFrame) -> DataFrame:
    return df.filter(F.col(BOUGHT).isNotNull())


def in_date_range(
    df: DataFrame, start: dt.date | None = None, end: dt.date | None = None, *, inclusive_day: bool = False
) -> DataFrame:
    """Orders between two dates, by default the whole range of the data.

    The end is its midnight, so later orders of the last day stay out unless `inclusive_day`.
    """
    day = F.col(BOUGHT).cast("date")
    bought = F.col(BOUGHT).isNotNull() if start is None else F.col(BOUGHT) >= F.lit(start).cast("timestamp_ntz")
    if inclusive_day:
        return df.filter(bought if end is None else bought & (day <= F.lit(end)))
    last = F.lit(end) if end else df.agg(F.max(day)).scalar()
    return df.filter(bought & (F.col(BOUGHT) <= last.cast("timestamp_ntz")))


def overview_orders(
    df: DataFrame,
    *,
    start: dt.date | None = None,
    end: dt.date | None = None,
    statuses: Sequence[str] = ("delivered",),
    inclusive_day: bool = False,
) -> DataFrame:
    df = in_date_range(bought(df), start, end, inclusive_day=inclusive_day)
    return df.filter(F.col("order_status").isin(*statuses)) if statuses else df


def orders_of_years(df: DataFrame, years: Sequence[int] = ()) -> DataFrame:
    """Years as ranges of time, which reach the scan; a year taken from the time would not."""
    df = bought(df)
    ranges = [
        (F.col(BOUGHT) >= F.lit(dt.datetime(year, 1, 1)).cast("timestamp_ntz"))
        & (F.col(BOUGHT) < F.lit(dt.datetime(year + 1, 1, 1)).cast("timestamp_ntz")) for year in years
    ]
    return df.filter(reduce(or_, ranges)) if ranges else df


def seller_orders(df: DataFrame, states: Sequence[str] = ()) -> DataFrame:
    """Delivered orders with a seller in one of the states, by default in any known one."""
    sold = df.filter("order_status = 'delivered' and seller_id is not null")
    return sold.filter(F.col("seller_state").isin(*states) if states else F.col("seller_state").isNotNull())


def delivered_orders(df: DataFrame) -> DataFrame:
    return bought(df.filter("order_status = 'delivered'"))


def filter_domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def date_domain(df: DataFrame) -> DataFrame:
    day = F.col(BOUGHT).cast("date")
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.count(F.lit(1)).alias("orders"))


# ---- overview ---------------------------------------------------------------------------------

def kpis(df: DataFrame) -> DataFrame:
    """One row. An order without both day counts is not late but counts in the late share."""
    late = F.coalesce(F.col("delivery_days") > F.col("estimated_delivery_days"), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("total_payment"), F.lit(0)).alias("total_revenue"),
        plain_mean("total_payment").alias("avg_order_value"),
        plain_mean("delivery_days").alias("avg_delivery_days"),
        plain_mean("review_score").alias("avg_review_score"),
        F.try_divide(F.count_if(late).cast("double"), F.count(F.lit(1)).cast("double")).alias("_late"),
    ).withColumn("late_pct", F.col("_late") * 100).drop("_late")


def revenue_by_month(df: DataFrame) -> DataFrame:
    paid = bought(df).filter("total_payment is not null")
    return paid.groupBy(month_label(BOUGHT).alias("month")).agg(F.sum("total_payment").alias("total_payment"))


# ---- geography --------------------------------------------------------------------------------

def _revenue() -> Column:
    return F.coalesce(F.sum("total_payment"), F.lit(0)).alias("revenue")


def customer_states(df: DataFrame) -> DataFrame:
    known = df.filter("customer_state is not null").groupBy("customer_state").agg(
        F.count("order_id").alias("order_count"),
        _revenue(),
        plain_mean("review_score").alias("avg_review_score"),
        plain_mean("delivery_days").alias("avg_delivery_days"),
    )
    return known.withColumns({
        "state_name": state_name("customer_state"),
        "region": state_region("customer_state", default=None),
    })


def customer_state_table(df: DataFrame) -> DataFrame:
    """All states, rounded for display, most orders first."""
    known = df.filter("customer_state is not null").groupBy("customer_state").agg(
        F.count("order_id").alias("order_count"),
        F.bround(F.coalesce(F.sum("total_payment"), F.lit(0)), 0).alias("revenue"),
        mean("review_score", 2, half_even=True).alias("avg_review_score"),
        mean("delivery_days", 1, half_even=True).alias("avg_delivery_days"),
    )
    return known.select(
        "customer_state",
        state_name("customer_state").alias("state_name"),
        state_region("customer_state", default=None).alias("region"),
        "order_count", "revenue", "avg_review_score", "avg_delivery_days",
    ).orderBy(F.col("order_count").desc(), "customer_state")


def seller_state_metrics(df: DataFrame) -> DataFrame:
    return df.filter("seller_state is not null").groupBy("seller_state").agg(
        F.count("order_id").alias("order_count"),
        _revenue(),
        plain_mean("delivery_days").alias("avg_delivery_days"),
    )


def orders_by_region(states: DataFrame) -> DataFrame:
    return states.filter("region is not null").groupBy("region").agg(F.sum("order_count").alias("order_count"))


def delivery_heat(df: DataFrame, *, n: int = 10) -> DataFrame:
    """Mean delivery days for the n busiest customer states and n busiest seller states."""
    buyers = top_k(customer_states(df), "order_count", n, tie_break="customer_state")
    shops = top_k(seller_state_metrics(df), "order_count", n, tie_break="seller_state")
    busy = keep_listed(keep_listed(df, "customer_state", buyers), "seller_state", shops)
    return busy.groupBy("customer_state", "seller_state").agg(plain_mean("delivery_days").alias("avg_delivery_days"))


def delivery_heat_matrix(df: DataFrame, *, n: int = 10) -> DataFrame:
    """Customer states down, the n busiest seller states across: `seller_1` and so on, busiest first.

    `seller_1_state` names the state of a column, whatever its code is.
    """
    heat = delivery_heat(df, n=n)
    shops = top_k(seller_state_metrics(df), "order_count", n, tie_break="seller_state")
    order = Window.orderBy(F.desc("order_count"), "seller_state")  # n rows at most
    places = shops.join(heat.select("seller_state").distinct(), "seller_state").select(
        "seller_state", F.row_number().over(order).alias("place")
    )
    names = places.agg(*[F.max(F.when(F.col("place") == i, F.col("seller_state"))).alias(f"s{i}") for i in range(1, n + 1)])
    cells = heat.join(F.broadcast(places), "seller_state").groupBy("customer_state").agg(*[
        F.max(F.when(F.col("place") == i, F.col("avg_delivery_days"))).alias(f"seller_{i}") for i in range(1, n + 1)
    ])
    state = names.select(F.struct("*")).scalar()
    return cells.select("*", *[state[f"s{i}"].alias(f"seller_{i}_state") for i in range(1, n + 1)])


# ---- customers --------------------------------------------------------------------------------

def customer_rfm_base(df: DataFrame) -> DataFrame:
    """Whole days since the last order (counted from a day after the latest one), orders, spend."""
    people = df.filter("customer_id is not null").groupBy("customer_id").agg(
        F.max(BOUGHT).alias("last_order"),
        F.count("order_id").alias("frequency"),
        F.coalesce(F.sum("total_payment"), F.lit(0)).cast("decimal(18,2)").alias("monetary"),
    )
    return materialise(people, lean=True)


def with_elapsed_recency(people: DataFrame) -> DataFrame:
    latest = people.agg(F.max("last_order")).scalar()
    seconds = F.timestamp_diff("SECOND", F.col("last_order"), latest) + 86400
    return people.withColumn("recency", F.floor(seconds / 86400).cast("bigint"))


def quartile_scores(df: DataFrame, metrics: Mapping[str, tuple[str, bool]]) -> DataFrame:
    """Add quarter scores by average percentile rank: new name -> (metric, inverted).

    A quarter ends at the greatest value whose mean rank is within it. These borders are all a row is
    compared with, so rows are not joined with ranks and no frequent value gathers them. A null has no
    rank and the greatest score.
    """
    ranks = value_ranks(df, [metric for metric, _ in metrics.values()], descending=False)
    kind = ranks.schema["value"].dataType
    borders = rank_borders(ranks, [0.25, 0.5, 0.75])

    def score(metric: str, inverted: bool) -> Column:
        value = F.col(metric).cast(kind)
        quarter = F.lit(1)
        for border in borders.get(metric, []):
            quarter = quarter + (F.lit(1) if border is None else F.when(value > F.lit(border).cast(kind), 1).otherwise(0))
        quarter = F.when(value.isNull(), 4).otherwise(quarter)
        return 5 - quarter if inverted else quarter

    return df.withColumns({name: score(metric, inverted) for name, (metric, inverted) in metrics.items()})


def segment_by_total(column: str) -> Column:
    total = F.col(column)
    return (
        F.when(total >= 10, "Champions").when(total >= 7, "Loyal").when(total >= 5, "At Risk").otherwise("Lost")
    )


def customer_rfm(df: DataFrame) -> DataFrame:
    """Segments of delivered orders per customer id, by quarters of each measure."""
    people = with_elapsed_recency(customer_rfm_base(df))
    scored = quartile_scores(people, {
        "recency_score": ("recency", True),
        "frequency_score": ("frequency", False),
        "monetary_score": ("monetary", False),
    })
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.drop("last_order").withColumn("rfm_score", total).withColumn("segment", segment_by_total("rfm_score"))


def segment_spend(scored: DataFrame) -> DataFrame:
    """Customers and mean spend per segment."""
    return scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("count"), plain_mean("monetary").alias("monetary")
    )


def segment_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        mean("recency", 1, half_even=True).alias("avg_recency"),
        mean("frequency", 1, half_even=True).alias("avg_frequency"),
        mean("monetary", 1, half_even=True).alias("avg_monetary"),
    )


def delivery_and_review(df: DataFrame, *, longest: int = 60) -> DataFrame:
    """Orders with delivery days, score and payment, outliers left out."""
    complete = df.select("order_id", "delivery_days", "review_score", "total_payment").dropna(
        subset=["delivery_days", "review_score", "total_payment"]
    )
    return complete.filter(F.col("delivery_days") <= longest)


def review_trend(points: DataFrame) -> DataFrame:
    """Orders and mean score per delivery day."""
    return points.groupBy("delivery_days").agg(
        F.count(F.lit(1)).alias("orders"), plain_mean("review_score").alias("avg_review_score")
    )


def review_by_lateness(df: DataFrame) -> DataFrame:
    return df.groupBy(late_label("is_late").alias("late_label")).agg(plain_mean("review_score").alias("review_score"))


def orders_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(month_label(BOUGHT).alias("cohort_month")).agg(F.count("order_id").alias("orders"))


# ---- sellers ----------------------------------------------------------------------------------

def seller_leaderboard(df: DataFrame, *, min_orders: int = 10) -> DataFrame:
    """Orders, revenue and exact means per seller with enough orders."""
    per_seller = df.groupBy("seller_id").agg(
        F.count("order_id").alias("order_count"),
        _revenue(),
        ratio(F.sum("delivery_days"), F.count("delivery_days")).alias("avg_delivery_days"),
        ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
        F.min("seller_state").alias("seller_state"),
    )
    revenue = F.col("revenue").cast("double")
    return per_seller.filter(F.col("order_count") >= min_orders).withColumns({
        "region": state_region("seller_state", default=None),
        "revenue_per_order": revenue / F.col("order_count"),
    })


def seller_kpis(board: DataFrame) -> DataFrame:
    """Sellers and the mean over sellers of each measure, to six decimals."""
    def over_sellers(column: str) -> Column:
        total = F.sum(F.col(column).cast("decimal(28,10)"))
        return F.round(F.try_divide(total.cast("double"), F.count(column).cast("double")), 6)

    return board.agg(
        F.count(F.lit(1)).alias("active_sellers"),
        over_sellers("order_count").alias("avg_orders_per_seller"),
        over_sellers("avg_delivery_days").alias("avg_delivery_days"),
        over_sellers("avg_review_score").alias("avg_review_score"),
    )


def _displayed(board: DataFrame) -> DataFrame:
    return board.withColumns({
        "revenue": F.bround("revenue", 0),
        "avg_delivery_days": F.bround("avg_delivery_days", 1),
        "avg_review_score": F.bround("avg_review_score", 2),
    })


def top_sellers(board: DataFrame, n: int = 20) -> DataFrame:
    best = _displayed(top_k(board, "revenue", n, tie_break="seller_id"))
    return best.select(
        "seller_id", "seller_state", "order_count", "revenue", "avg_delivery_days", "avg_review_score",
        short_id("seller_id", 8).alias("seller_id_short"),
    )


def seller_state_revenue(board: DataFrame, n: int = 15) -> DataFrame:
    states = board.filter("seller_state is not null").groupBy("seller_state").agg(F.sum("revenue").alias("revenue"))
    return top_k(states, "revenue", n, tie_break="seller_state")


def seller_detail(board: DataFrame, *, sort_by: str = "revenue", n: int = 100) -> DataFrame:
    best = _displayed(top_k(board, sort_by, n, tie_break="seller_id"))
    return best.select(
        short_id("seller_id", 16).alias("seller_id"), "seller_state", "region", "order_count", "revenue",
        "avg_delivery_days", "avg_review_score",
    )
