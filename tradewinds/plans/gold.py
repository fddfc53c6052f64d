"""Star schema: staging renames, joined orders and items, five dimensions and the order fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewinds.functions import (
    date_key, installments_bucket, month_label, quarter_label, state_region, surrogate_key,
)
from tradewinds.operators.relational import date_spine

# silver column -> staging column; columns not listed are left out
STAGING = {
    "orders": {
        "order_id": "order_id", "customer_id": "customer_id", "order_status": "order_status",
        "order_purchase_timestamp": "purchased_at", "order_approved_at": "approved_at",
        "order_delivered_carrier_date": "shipped_at", "order_delivered_customer_date": "delivered_at",
        "order_estimated_delivery_date": "estimated_delivery_at", "delivery_days": "delivery_days",
        "estimated_delivery_days": "estimated_delivery_days", "is_late": "is_late",
        "delivery_delay_days": "delivery_delay_days", "order_year": "order_year",
        "order_month": "order_month", "order_day_of_week": "order_day_of_week",
    },
    "customers": {
        "customer_id": "customer_id", "customer_unique_id": "customer_unique_id",
        "customer_zip_code_prefix": "zip_code_prefix", "customer_city": "customer_city",
        "customer_state": "customer_state",
    },
    "products": {
        "product_id": "product_id", "product_category_name": "product_category",
        "product_name_lenght": "name_length", "product_description_lenght": "description_length",
        "product_photos_qty": "photos_qty", "product_weight_g": "weight_g",
        "product_length_cm": "length_cm", "product_height_cm": "height_cm",
        "product_width_cm": "width_cm", "product_volume_cm3": "volume_cm3",
    },
    "sellers": {
        "seller_id": "seller_id", "seller_zip_code_prefix": "zip_code_prefix",
        "seller_city": "seller_city", "seller_state": "seller_state",
    },
    "payments": {
        "order_id": "order_id", "total_payment": "payment_amount",
        "num_installments": "installments", "primary_payment_type": "payment_type",
    },
    "reviews": {
        "review_id": "review_id", "order_id": "order_id", "review_score": "review_score",
        "review_comment_title": "comment_title", "review_comment_message": "comment_message",
        "review_creation_date": "review_created_at", "review_answer_timestamp": "review_answered_at",
    },
}


def stage(df: DataFrame, table: str) -> DataFrame:
    """Staging names; accepts loaded tables with upper-case names as well."""
    present = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(present[old]).alias(new) for old, new in STAGING[table].items()])


def orders_enriched(orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Staged orders with their payment and review; all three are unique per order."""
    review = reviews.select("order_id", "review_score", "review_id", "review_created_at", "review_answered_at")
    return orders.join(payments, "order_id", "left").join(review, "order_id", "left")


def items_enriched(
    items: DataFrame, products: DataFrame, sellers: DataFrame, translation: DataFrame | None = None
) -> DataFrame:
    """Items with product and seller attributes; a translation table makes the category English."""
    product = products.select(
        "product_id", "product_category", "name_length", "description_length", "photos_qty",
        "weight_g", "volume_cm3",
    )
    if translation is not None:
        product = english_categories(product, translation)
    seller = sellers.select("seller_id", "seller_city", "seller_state")
    joined = items.join(product, "product_id", "left").join(seller, "seller_id", "left")
    return joined.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"), "shipping_limit_date",
        "product_category", "name_length", "description_length", "photos_qty", "weight_g",
        "volume_cm3", "seller_city", "seller_state",
    )


def english_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Category names in English where the translation has one."""
    english = translation.select(
        F.col("product_category_name").alias("product_category"),
        F.col("product_category_name_english").alias("_english"),
    )
    named = products.join(english, "product_category", "left")
    return named.withColumn("product_category", F.coalesce("_english", "product_category")).select(products.columns)


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id", "customer_unique_id", "customer_city", "customer_state",
        state_region("customer_state").alias("customer_region"),
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        surrogate_key("seller_id").alias("seller_key"),
        "seller_id", "seller_city", "seller_state",
        state_region("seller_state").alias("seller_region"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        F.coalesce("product_category", F.lit("unknown")).alias("product_category"),
        "name_length", "description_length", "photos_qty", "weight_g", "length_cm", "height_cm",
        "width_cm", "volume_cm3",
    )


def dim_payment(payments: DataFrame) -> DataFrame:
    """Distinct payment type and installments."""
    pairs = payments.filter("payment_type is not null").select("payment_type", "installments").distinct()
    return pairs.select(
        surrogate_key("payment_type", "installments").alias("payment_key"),
        "payment_type", "installments",
        installments_bucket("installments").alias("installments_bucket"),
    )


def dim_dates(
    spark: SparkSession, start: dt.date = dt.date(2016, 1, 1), end: dt.date = dt.date(2019, 1, 1)
) -> DataFrame:
    """Calendar from start to the day before end; day_of_week 0 is Sunday, ISO day 1 is Monday."""
    days = date_spine(spark, start, end).withColumnRenamed("date_day", "full_date")
    weekday = F.dayofweek("full_date") - 1
    return days.select(
        "full_date",
        date_key("full_date").alias("date_key"),
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.day("full_date").alias("day"),
        F.quarter("full_date").alias("quarter"),
        weekday.alias("day_of_week"),
        (F.weekday("full_date") + 1).alias("day_of_week_iso"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        quarter_label("full_date").alias("year_quarter"),
        month_label("full_date").alias("year_month"),
    )


def fact_orders(enriched: DataFrame, customers: DataFrame, payment: DataFrame) -> DataFrame:
    """One row per order with keys to the customer, payment and date dimensions."""
    customer = customers.select("customer_key", "customer_id")
    method = payment.select(
        "payment_key",
        F.col("payment_type").alias("_type"),
        F.col("installments").alias("_installments"),
    )
    same_method = (F.col("payment_type") == F.col("_type")) & (
        F.coalesce("installments", F.lit(1)) == F.col("_installments")
    )
    return (
        enriched.join(customer, "customer_id", "left")
        .join(method, same_method, "left")
        .select(
            surrogate_key("order_id").alias("order_key"),
            "order_id",
            "customer_key",
            "payment_key",
            date_key("purchased_at").alias("date_key"),
            "order_status",
            F.coalesce("payment_amount", F.lit(0).cast("decimal(18,2)")).alias("payment_amount"),
            "installments",
            "payment_type",
            "delivery_days",
            "estimated_delivery_days",
            F.coalesce("is_late", F.lit(False)).alias("is_late"),
            F.coalesce("delivery_delay_days", F.lit(0)).alias("delivery_delay_days"),
            "review_score",
            "purchased_at", "approved_at", "shipped_at", "delivered_at", "estimated_delivery_at",
            "order_year", "order_month", "order_day_of_week",
        )
    )
