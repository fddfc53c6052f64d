"""Declared schemas, key and date columns of the raw tables, and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
MONEY = T.DecimalType(18, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Raw tables. Ids, zip prefixes and dates stay text until the silver jobs parse them.
RAW = {
    "orders": _struct(
        order_id=TEXT, customer_id=TEXT, order_status=TEXT, order_purchase_timestamp=TEXT,
        order_approved_at=TEXT, order_delivered_carrier_date=TEXT,
        order_delivered_customer_date=TEXT, order_estimated_delivery_date=TEXT,
    ),
    "customers": _struct(
        customer_id=TEXT, customer_unique_id=TEXT, customer_zip_code_prefix=TEXT,
        customer_city=TEXT, customer_state=TEXT,
    ),
    "order_items": _struct(
        order_id=TEXT, order_item_id=INT, product_id=TEXT, seller_id=TEXT,
        shipping_limit_date=TEXT, price=MONEY, freight_value=MONEY,
    ),
    "order_payments": _struct(
        order_id=TEXT, payment_sequential=INT, payment_type=TEXT, payment_installments=INT,
        payment_value=MONEY,
    ),
    "order_reviews": _struct(
        review_id=TEXT, order_id=TEXT, review_score=TEXT, review_comment_title=TEXT,
        review_comment_message=TEXT, review_creation_date=TEXT, review_answer_timestamp=TEXT,
    ),
    # "lenght" is the spelling of the raw files.
    "products": _struct(
        product_id=TEXT, product_category_name=TEXT, product_name_lenght=INT,
        product_description_lenght=INT, product_photos_qty=INT, product_weight_g=DOUBLE,
        product_length_cm=DOUBLE, product_height_cm=DOUBLE, product_width_cm=DOUBLE,
    ),
    "sellers": _struct(
        seller_id=TEXT, seller_zip_code_prefix=TEXT, seller_city=TEXT, seller_state=TEXT,
    ),
    "geolocation": _struct(
        geolocation_zip_code_prefix=TEXT, geolocation_lat=DOUBLE, geolocation_lng=DOUBLE,
        geolocation_city=TEXT, geolocation_state=TEXT,
    ),
    "category_translation": _struct(
        product_category_name=TEXT, product_category_name_english=TEXT,
    ),
}

# Columns that must not be null.
NOT_NULL = {
    "orders": ["order_id", "customer_id", "order_status"],
    "customers": ["customer_id", "customer_unique_id"],
    "order_items": ["order_id", "product_id", "seller_id"],
    "order_payments": ["order_id", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "category_translation": ["product_category_name"],
}

# Text columns that must parse as dates.
DATES = {
    "orders": ["order_purchase_timestamp", "order_estimated_delivery_date"],
    "order_items": ["shipping_limit_date"],
    "order_reviews": ["review_creation_date"],
}

# Brazilian state code -> (full name, macro-region).
STATES = {
    "AC": ("Acre", "North"),
    "AL": ("Alagoas", "Northeast"),
    "AM": ("Amazonas", "North"),
    "AP": ("Amapa", "North"),
    "BA": ("Bahia", "Northeast"),
    "CE": ("Ceara", "Northeast"),
    "DF": ("Distrito Federal", "Central-West"),
    "ES": ("Espirito Santo", "Southeast"),
    "GO": ("Goias", "Central-West"),
    "MA": ("Maranhao", "Northeast"),
    "MG": ("Minas Gerais", "Southeast"),
    "MS": ("Mato Grosso do Sul", "Central-West"),
    "MT": ("Mato Grosso", "Central-West"),
    "PA": ("Para", "North"),
    "PB": ("Paraiba", "Northeast"),
    "PE": ("Pernambuco", "Northeast"),
    "PI": ("Piaui", "Northeast"),
    "PR": ("Parana", "South"),
    "RJ": ("Rio de Janeiro", "Southeast"),
    "RN": ("Rio Grande do Norte", "Northeast"),
    "RO": ("Rondonia", "North"),
    "RR": ("Roraima", "North"),
    "RS": ("Rio Grande do Sul", "South"),
    "SC": ("Santa Catarina", "South"),
    "SE": ("Sergipe", "Northeast"),
    "SP": ("Sao Paulo", "Southeast"),
    "TO": ("Tocantins", "North"),
}

# Accepted values of the checked columns.
STAGED_STATUSES = [
    "delivered", "shipped", "canceled", "invoiced", "processing", "approved",
    "unavailable", "created",
]
FACT_STATUSES = ["delivered", "shipped", "canceled", "invoiced", "processing", "approved"]
REGIONS = ["Southeast", "South", "Northeast", "North", "Central-West", "Unknown"]
SCORES = [1, 2, 3, 4, 5]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]

# Statuses left out by the silver job and by the revenue reports.
NOT_PROGRESSED = ["unavailable", "created"]
NOT_REVENUE = ["canceled", "unavailable"]
