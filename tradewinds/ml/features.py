"""One row per order with everything the two models learn from."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tradewinds.functions import comment_length, flag_to_int, freight_ratio, haversine_km
from tradewinds.operators.materialise import materialise
from tradewinds.operators.ordered import group_medians, running_totals
from tradewinds.operators.relational import top_k
from tradewinds.plans.dashboard import (
    customer_of_order, first_item_places, first_item_values, item_place, with_sellers_and_products,
)

BOUGHT = "order_purchase_timestamp"

DELIVERY_FEATURES = [
    "seller_state", "customer_state", "distance_km", "product_weight_g", "product_volume_cm3",
    "product_category", "freight_value", "price", "freight_ratio", "item_count",
    "primary_payment_type", "num_installments", "order_day_of_week", "order_month",
    "seller_avg_delivery",
]
DELIVERY_LABELS = ["seller_state", "customer_state", "primary_payment_type", "product_category"]
DELIVERY_TARGET = "delivery_days"

REVIEW_FEATURES = [
    "delivery_days", "delivery_delay_days", "is_late_int", "price", "freight_value", "freight_ratio",
    "item_count", "product_weight_g", "product_photos_qty", "product_category", "num_installments",
    "seller_avg_review", "comment_length", "has_comment", "distance_km",
]
REVIEW_LABELS = ["product_category"]
REVIEW_TARGET = "is_good_review"


def item_total_columns() -> list[Column]:
    return [
        F.count("order_item_id").alias("item_count"),
        F.coalesce(F.sum("price"), F.lit(0)).alias("total_price"),
        F.coalesce(F.sum("freight_value"), F.lit(0)).alias("total_freight"),
    ]


def item_totals(items: DataFrame) -> DataFrame:
    """Items, price and freight per order."""
    return items.filter("order_id is not null").groupBy("order_id").agg(*item_total_columns())


def order_lines(items: DataFrame) -> DataFrame:
    """First item and totals per order in one pass over the items."""
    placed = items.filter("order_id is not null").select(
        "order_id", "order_item_id", "price", "freight_value", item_place()
    )
    lines = placed.groupBy("order_id").agg(*first_item_places(), *item_total_columns())
    return lines.select("order_id", *first_item_values(), "item_count", "total_price", "total_freight")


def geo_centroids(geo: DataFrame) -> DataFrame:
    """Exact median latitude and longitude per zip prefix."""
    axes = F.array(
        F.struct(F.lit("lat").alias("axis"), F.col("geolocation_lat").alias("degrees")),
        F.struct(F.lit("lng").alias("axis"), F.col("geolocation_lng").alias("degrees")),
    )
    points = geo.filter("geolocation_zip_code_prefix is not null").select(
        F.col("geolocation_zip_code_prefix").alias("zip_prefix"), F.inline(axes)
    )
    medians = group_medians(points, by=["zip_prefix", "axis"], value="degrees")
    return medians.groupBy("zip_prefix").agg(
        F.max(F.when(F.col("axis") == "lat", F.col("median"))).alias("lat"),
        F.max(F.when(F.col("axis") == "lng", F.col("median"))).alias("lng"),
    )


def with_centroid(df: DataFrame, zip_column: str, centroids: DataFrame, prefix: str) -> DataFrame:
    side = centroids.select(
        F.col("zip_prefix").alias(zip_column),
        F.col("lat").alias(f"{prefix}_lat"),
        F.col("lng").alias(f"{prefix}_lng"),
    )
    return df.join(side, zip_column, "left")


def joined_orders(silver: Mapping[str, DataFrame], lines: DataFrame, centroids: DataFrame) -> DataFrame:
    """Orders with payment, review, items, customer, seller, product and both zip centroids.

    Lookups by other keys are attached to narrow rows first: review texts move once, by order.
    """
    review = silver["reviews"].select(
        "order_id", "review_score", "review_comment_message", "review_comment_title"
    )
    customer = with_centroid(
        silver["customers"].select("customer_id", "customer_state", "customer_zip_code_prefix"),
        "customer_zip_code_prefix", centroids, "cust",
    )
    seller = with_centroid(
        silver["sellers"].select("seller_id", "seller_state", "seller_zip_code_prefix"),
        "seller_zip_code_prefix", centroids, "sell",
    )
    product = silver["products"].select(
        "product_id", "product_category_name", "product_weight_g", "product_volume_cm3", "product_photos_qty"
    )
    return (
        silver["orders"]
        .join(silver["payments"], "order_id", "left")
        .join(review, "order_id", "left")
        .join(with_sellers_and_products(lines, seller, product), "order_id", "left")
        .join(customer_of_order(silver["orders"], customer), "order_id", "left")
    )


def seller_history(orders: DataFrame, reviews: DataFrame, lines: DataFrame) -> DataFrame:
    """Per order, the mean delivery days and score of its seller's earlier orders.

    Earlier means bought earlier, so a score that was given later may be included. Running sums
    are cut by order of time, not by seller, so a very busy seller is spread over many tasks.
    """
    sold = (
        orders.select("order_id", BOUGHT, "delivery_days")
        .join(reviews.select("order_id", "review_score"), "order_id", "left")
        .join(lines.select("order_id", "seller_id"), "order_id")
        .filter("seller_id is not null")
    )
    days, score = F.col("delivery_days"), F.col("review_score")
    totals = running_totals(
        sold,
        by=["seller_id"],
        order=[F.col(BOUGHT).asc_nulls_last(), F.col("order_id").asc()],
        sums={
            "_days": days.cast("bigint"),
            "_days_n": days.isNotNull().cast("bigint"),
            "_score": score.cast("bigint"),
            "_score_n": score.isNotNull().cast("bigint"),
        },
    )

    def earlier_mean(name: str) -> Column:
        return F.try_divide(F.col(f"{name}_before").cast("double"), F.col(f"{name}_n_before").cast("double"))

    return totals.select(
        "order_id",
        earlier_mean("_days").alias("seller_avg_delivery"),
        earlier_mean("_score").alias("seller_avg_review"),
    )


def top_categories(orders: DataFrame, lines: DataFrame, products: DataFrame, k: int) -> DataFrame:
    """The k categories with most orders, by each order's first item."""
    first = orders.select("order_id").join(lines.select("order_id", "product_id"), "order_id")
    per_product = first.filter("product_id is not null").groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    named = per_product.join(products.select("product_id", "product_category_name"), "product_id")
    counts = named.filter("product_category_name is not null").groupBy("product_category_name").agg(
        F.sum("n").alias("orders")
    )
    return top_k(counts, "orders", k, tie_break="product_category_name")


def with_category(df: DataFrame, top: DataFrame) -> DataFrame:
    """The listed categories by name, everything else and null as 'other'. `top` has k rows."""
    listed = top.select("product_category_name", F.lit(True).alias("_listed"))
    named = df.join(F.broadcast(listed), "product_category_name", "left")
    category = F.when(F.col("_listed"), F.col("product_category_name")).otherwise("other")
    return named.withColumn("product_category", category).drop("_listed")


def with_order_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "freight_ratio": freight_ratio("total_freight", "total_price").cast("double"),
        "distance_km": haversine_km("cust_lat", "cust_lng", "sell_lat", "sell_lng"),
        "comment_length": comment_length("review_comment_message", "review_comment_title"),
    }).withColumn("has_comment", (F.col("comment_length") > 0).cast("int"))


def feature_frame(silver: Mapping[str, DataFrame], geo: DataFrame, *, k: int = 20) -> DataFrame:
    """The wide rows are only joined; sorting and counting are done on narrow ones beforehand."""
    lines = materialise(order_lines(silver["items"]))
    centroids = materialise(geo_centroids(geo))
    history = seller_history(silver["orders"], silver["reviews"], lines)
    top = top_categories(silver["orders"], lines, silver["products"], k)
    by_order = lines.join(history, "order_id", "left")
    joined = joined_orders(silver, by_order, centroids)
    return with_order_features(with_category(joined, top)).drop("cust_lat", "cust_lng", "sell_lat", "sell_lng")


def delivery_training(features: DataFrame) -> DataFrame:
    """Delivered orders with known days."""
    kept = features.filter("delivery_days is not null and order_status = 'delivered'")
    return kept.select("order_id", *DELIVERY_FEATURES, F.col(DELIVERY_TARGET).cast("double").alias("label"))


def review_training(features: DataFrame) -> DataFrame:
    """Reviewed orders; a score of four or five is good."""
    kept = features.filter("review_score is not null").withColumn("is_late_int", flag_to_int("is_late"))
    return kept.select("order_id", *REVIEW_FEATURES, (F.col("review_score") >= 4).cast("int").alias("label"))
