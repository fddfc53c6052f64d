"""Raw tables to typed, cleaned and deduplicated ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tradewinds.functions import clean_text, day_gap, parse_timestamp
from tradewinds.operators.relational import all_columns_ascending, first_per_key
from tradewinds.schemas import NOT_PROGRESSED

_ORDER_TIMES = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]


def typed_orders(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: parse_timestamp(c) for c in _ORDER_TIMES})


def with_delivery_metrics(orders: DataFrame) -> DataFrame:
    """Day counts and lateness. Lateness compares times and the delay counts calendar days, so an
    order can be late by zero days."""
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    late = F.col(delivered) > F.col(promised)
    return orders.withColumns({
        "delivery_days": day_gap(delivered, "order_purchase_timestamp"),
        "estimated_delivery_days": day_gap(promised, "order_purchase_timestamp"),
        "is_late": late,
        "delivery_delay_days": F.when(late, day_gap(delivered, promised)).otherwise(0),
    })


def with_purchase_parts(orders: DataFrame) -> DataFrame:
    bought = "order_purchase_timestamp"
    return orders.withColumns({
        "order_year": F.year(bought),
        "order_month": F.month(bought),
        "order_day_of_week": F.dayofweek(bought),  # 1 is Sunday
    })


def progressed(orders: DataFrame, drop_statuses: Sequence[str]) -> DataFrame:
    """Orders outside the listed statuses; a null status is dropped too."""
    return orders.filter(~F.col("order_status").isin(*drop_statuses))


def silver_orders(raw: DataFrame, *, drop_statuses: Sequence[str] = NOT_PROGRESSED) -> DataFrame:
    """One row per order: the earliest purchase."""
    kept = first_per_key(
        progressed(typed_orders(raw), drop_statuses),
        "order_id",
        [
            F.col("order_purchase_timestamp").asc_nulls_last(),
            F.col("order_approved_at").asc_nulls_last(),
            F.col("order_delivered_customer_date").asc_nulls_last(),
            F.col("order_status").asc_nulls_last(),
            *all_columns_ascending(
                raw, skip=["order_id", "order_purchase_timestamp", "order_approved_at",
                           "order_delivered_customer_date", "order_status"]
            ),
        ],
    )
    return with_purchase_parts(with_delivery_metrics(kept))


def silver_customers(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumn("customer_city", clean_text("customer_city"))
    return first_per_key(cleaned, "customer_id", all_columns_ascending(cleaned, skip=["customer_id"]))


def silver_sellers(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumn("seller_city", clean_text("seller_city"))
    return first_per_key(cleaned, "seller_id", all_columns_ascending(cleaned, skip=["seller_id"]))


def clean_products(raw: DataFrame) -> DataFrame:
    """Category in lower case, missing counts as 0, volume when all three sides are there."""
    counts = ["product_name_lenght", "product_description_lenght", "product_photos_qty"]
    sides = ["product_length_cm", "product_height_cm", "product_width_cm"]
    cleaned = raw.withColumn("product_category_name", clean_text("product_category_name"))
    cleaned = cleaned.fillna({c: 0 for c in counts if c in raw.columns})
    if set(sides) <= set(raw.columns):
        length, height, width = (F.col(c) for c in sides)
        cleaned = cleaned.withColumn("product_volume_cm3", length * height * width)
    return cleaned


def silver_products(raw: DataFrame) -> DataFrame:
    cleaned = clean_products(raw)
    return first_per_key(cleaned, "product_id", all_columns_ascending(cleaned, skip=["product_id"]))


def payments_by_type(raw: DataFrame) -> DataFrame:
    """Positive payments per order and type."""
    return (
        raw.filter("payment_value > 0")
        .groupBy("order_id", "payment_type")
        .agg(F.sum("payment_value").alias("type_total"), F.max("payment_installments").alias("installments"))
    )


def silver_payments(raw: DataFrame) -> DataFrame:
    """One row per order with its total, most installments and the type that paid most.

    The total per type is taken first, so both shuffles carry partial sums only.
    """
    main_type = F.min_by("payment_type", F.struct(-F.col("type_total"), F.col("payment_type")))
    return (
        payments_by_type(raw)
        .groupBy("order_id")
        .agg(
            F.sum("type_total").cast("decimal(18,2)").alias("total_payment"),
            F.max("installments").alias("num_installments"),
            main_type.alias("_main_type"),
        )
        .withColumn("primary_payment_type", F.when(F.col("order_id").isNotNull(), F.col("_main_type")))
        .drop("_main_type")
    )


def typed_reviews(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "review_score": F.col("review_score").try_cast("int"),
        "review_creation_date": parse_timestamp("review_creation_date"),
        "review_answer_timestamp": parse_timestamp("review_answer_timestamp"),
    }).fillna({"review_comment_title": "", "review_comment_message": ""})


def silver_reviews(raw: DataFrame) -> DataFrame:
    """The latest answer per review id, then per order."""
    answered = F.col("review_answer_timestamp").desc_nulls_last()
    created = F.col("review_creation_date").desc_nulls_last()
    per_review = first_per_key(
        typed_reviews(raw),
        "review_id",
        [
            answered, created, F.col("order_id").asc_nulls_last(), F.col("review_score").desc_nulls_last(),
            F.col("review_comment_message").asc(), F.col("review_comment_title").asc(),
        ],
    )
    return first_per_key(per_review, "order_id", [answered, created, F.col("review_id").asc_nulls_last()])


def silver_items(raw: DataFrame) -> DataFrame:
    return raw.withColumn("shipping_limit_date", parse_timestamp("shipping_limit_date"))


# silver name -> (raw name, job)
SILVER = {
    "orders": ("orders", silver_orders),
    "products": ("products", silver_products),
    "customers": ("customers", silver_customers),
    "sellers": ("sellers", silver_sellers),
    "payments": ("order_payments", silver_payments),
    "reviews": ("order_reviews", silver_reviews),
    "items": ("order_items", silver_items),
}
