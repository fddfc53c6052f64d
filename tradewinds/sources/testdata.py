"""Raw commerce tables derived from the given star tables.

Every column is plain arithmetic on the given columns, so the same tables can be written as SQL.
Dates are text, as in raw files, and some values are missing or malformed on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# State by nation key; XX is no state.
STATE_BY_NATION = "AC AL AM AP BA CE DF ES GO MA MG MS MT PA PB PE PI PR RJ RN RO RR RS SC XX".split()


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _state(nation: str):
    """Null for a key beyond the list, as in the SQL."""
    place = F.col(nation).cast("int") + 1
    beyond = (place == 0) | (F.abs(place) > len(STATE_BY_NATION))
    return F.when(beyond, F.lit(None)).otherwise(F.element_at(F.array(*[F.lit(s) for s in STATE_BY_NATION]), place))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every fiftieth order comes twice, the second time bought a day later."""
    return (
        _table(spark, folder, "orders")
        .selectExpr(
            "o_orderkey AS k",
            "CAST(o_custkey AS STRING) AS person",
            "o_orderstatus AS s",
            "timestampadd(SECOND, CAST(o_orderkey * 7919 % 86400 AS INT), CAST(o_orderdate AS TIMESTAMP_NTZ)) AS p",
            "explode(IF(o_orderkey % 50 = 0, array(0, 1), array(0))) AS copy",
        )
        .selectExpr(
            "k", "p", "copy",
            """CASE WHEN k % 211 = 0 THEN NULL WHEN s = 'F' THEN 'delivered' WHEN s = 'O' THEN 'shipped'
                    ELSE element_at(array('canceled', 'unavailable', 'created', 'invoiced', 'processing'),
                                    CAST(k % 5 AS INT) + 1) END AS status""",
        )
        .selectExpr(
            "CAST(k AS STRING) AS order_id",
            "concat('c', k) AS customer_id",
            "status AS order_status",
            "CAST(timestampadd(DAY, copy, p) AS STRING) AS order_purchase_timestamp",
            """CASE WHEN status = 'created' THEN NULL WHEN k % 101 = 0 THEN 'n/a'
                    ELSE CAST(timestampadd(HOUR, CAST(k % 48 AS INT), p) AS STRING) END AS order_approved_at""",
            """CASE WHEN status IN ('delivered', 'shipped')
                    THEN CAST(timestampadd(DAY, CAST(1 + k % 5 AS INT), p) AS STRING)
               END AS order_delivered_carrier_date""",
            """CASE WHEN status = 'delivered' AND k % 97 <> 0
                    THEN CAST(timestampadd(SECOND, CAST(k * 613 % 86400 AS INT),
                              timestampadd(DAY, CAST(4 * abs(month(p) - 6) + k * 31 % 11 AS INT), p)) AS STRING)
               END AS order_delivered_customer_date""",
            """CAST(timestampadd(DAY, CAST(10 + k * 17 % 30 AS INT),
                    CAST(CAST(p AS DATE) AS TIMESTAMP_NTZ)) AS STRING) AS order_estimated_delivery_date""",
        )
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """One customer per order; the person behind it is the star table's customer.

    Every seventieth customer comes twice, the second time with another city.
    """
    bought = _table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_custkey", "explode(IF(o_orderkey % 70 = 0, array(0, 1), array(0))) AS copy"
    )
    nation = _table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return bought.join(nation, bought["o_custkey"] == nation["c_custkey"]).select(
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("customer_id"),
        F.col("o_custkey").cast("string").alias("customer_unique_id"),
        F.lpad((F.col("o_custkey") % 300).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.when(F.col("copy") == 1, " Other ")
        .otherwise(F.concat(F.lit("  City "), F.col("o_custkey") % 40, F.lit(" ")))
        .alias("customer_city"),
        _state("c_nationkey").alias("customer_state"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    """Every ninth seller comes twice, the second time with another city."""
    copies = F.expr("explode(IF(s_suppkey % 9 = 0, array(0, 1), array(0)))").alias("copy")
    return _table(spark, folder, "supplier").select("*", copies).select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.lpad((F.col("s_suppkey") % 300).cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.when(F.col("copy") == 1, " Twin ")
        .otherwise(F.concat(F.lit(" Town "), F.col("s_suppkey") % 12))
        .alias("seller_city"),
        _state("s_nationkey").alias("seller_state"),
    )


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS price",
        """CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
                AS DECIMAL(18,2)) AS freight_value""",
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return _items(spark, folder).selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id",
        "l_linenumber AS order_item_id",
        "IF((l_partkey + l_linenumber) % 41 = 0, NULL, CAST(l_partkey AS STRING)) AS product_id",
        "CAST(l_suppkey AS STRING) AS seller_id",
        "CAST(CAST(l_shipdate AS TIMESTAMP_NTZ) AS STRING) AS shipping_limit_date",
        "price",
        "freight_value",
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    return _items(spark, folder).selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id",
        "l_linenumber AS payment_sequential",
        """CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'credit_card'
                WHEN l_returnflag = 'N' THEN 'boleto' WHEN l_linestatus = 'F' THEN 'voucher'
                ELSE 'debit_card' END AS payment_type""",
        "IF(l_partkey % 31 = 0, NULL, CAST(l_quantity AS INT) % 15) AS payment_installments",
        """CAST(CASE WHEN l_discount <> 0 THEN price + freight_value WHEN l_partkey % 7 = 0 THEN -price ELSE 0 END
                AS DECIMAL(18,2)) AS payment_value""",
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return _items(spark, folder).selectExpr(
        "concat('r', l_orderkey, '-', l_partkey % 2) AS review_id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "CAST(1 + l_partkey % 5 AS STRING) AS review_score",
        "IF(l_suppkey % 2 = 0, NULL, 'title') AS review_comment_title",
        "IF(l_suppkey % 3 = 0, NULL, concat('msg ', l_partkey)) AS review_comment_message",
        "CAST(CAST(l_shipdate AS TIMESTAMP_NTZ) AS STRING) AS review_creation_date",
        """IF(l_suppkey % 13 = 0, NULL, CAST(timestampadd(DAY, l_linenumber, CAST(l_shipdate AS TIMESTAMP_NTZ))
                AS STRING)) AS review_answer_timestamp""",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Every fortieth product comes again without photos, every sixtieth as an equal row."""
    copies = """explode(concat(array(0), IF(p_partkey % 40 = 0, array(1), array()),
                IF(p_partkey % 60 = 0, array(2), array()))) AS copy"""
    return _table(spark, folder, "part").selectExpr("*", copies).selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        "IF(p_partkey % 23 = 0, NULL, concat(' ', p_type, '_', p_brand, ' ')) AS product_category_name",
        "IF(p_partkey % 7 = 0, NULL, length(p_name)) AS product_name_lenght",
        "IF(p_partkey % 7 = 0, NULL, p_size * 10) AS product_description_lenght",
        "IF(p_partkey % 6 = 0 OR copy = 1, NULL, CAST(p_partkey % 6 AS INT)) AS product_photos_qty",
        "IF(p_partkey % 31 = 0, NULL, CAST(p_size * 100 AS DOUBLE)) AS product_weight_g",
        "CAST(10 + p_size AS DOUBLE) AS product_length_cm",
        "CAST(2 + p_partkey % 20 AS DOUBLE) AS product_height_cm",
        "CAST(6 + p_partkey % 15 AS DOUBLE) AS product_width_cm",
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "customer").select(
        F.lpad((F.col("c_custkey") % 250).cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        F.expr("CAST(-30 + (c_custkey * 37 % 3500) / 100D AS DOUBLE)").alias("geolocation_lat"),
        F.expr("CAST(-70 + (c_custkey * 53 % 3500) / 100D AS DOUBLE)").alias("geolocation_lng"),
        F.concat(F.lit("city "), F.col("c_custkey") % 40).alias("geolocation_city"),
        _state("c_nationkey").alias("geolocation_state"),
    )


def category_translation(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "part")
        .selectExpr("lower(concat(p_type, '_', p_brand)) AS product_category_name")
        .distinct()
        .withColumn("product_category_name_english", F.concat(F.lit("en "), F.col("product_category_name")))
    )


RAW_TABLES = {
    "orders": orders,
    "customers": customers,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: build(spark, folder) for name, build in RAW_TABLES.items()}
