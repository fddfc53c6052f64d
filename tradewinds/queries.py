"""One named query per operator and report, over tables derived from the given ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradewinds import functions as fn, schemas
from tradewinds.ml import evaluate, features as ft, score, train
from tradewinds.operators import quality, relational as rel
from tradewinds.operators.materialise import losses, materialise, run_folder
from tradewinds.operators.ordered import join_ranks, places, value_ranks
from tradewinds.plans import cohort, dashboard as dash, declared, gold, revenue, rfm, sellers, silver
from tradewinds.plans.warehouse import Warehouse
from tradewinds.sources import artifacts, csv_tables, tables
from tradewinds.sources.testdata import raw_tables

QUERIES: dict[str, Callable[["Context"], DataFrame]] = {}


class Context(Warehouse):
    """The warehouse of one folder of given tables in one session, plus files written for reading."""

    trees, rounds = 200, 300

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(raw_tables(spark, folder))
        self.spark = spark

    def scratch(self, name: str) -> str:
        return f"{run_folder(self.spark)}/{name}-{uuid4().hex}"

    @cached_property
    def _csv_folder(self) -> str:
        return self.scratch("csv")

    @cached_property
    def _csv_written(self) -> set[str]:
        return set()

    def delivered_csv(self, *names: str) -> str:
        """Folder with the named raw tables, or all of them, as CSV; each is written once."""
        for name in names or self.raw:
            if name in self.raw and name not in self._csv_written:
                csv_tables.write_csv(self.raw[name], f"{self._csv_folder}/{name}.csv")
                self._csv_written.add(name)
        return self._csv_folder

    def bought_days(self) -> tuple[dt.date, dt.date]:
        """First day with an order, and the day after the last one."""
        day = F.col(dash.BOUGHT).cast("date")
        row = self.silver("orders").agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
        return row["first"], row["last"] + dt.timedelta(days=1)

    def dim_dates(self) -> DataFrame:
        return gold.dim_dates(self.spark, *self.bought_days())

    def tested_tables(self) -> dict[str, DataFrame]:
        cleaned = {name: table for name, table in self.silver_tables().items() if name in gold.STAGING}
        star = {
            "fact_orders": self.fact_orders(), "dim_customers": self.dim_customers(), "dim_sellers": self.dim_sellers(),
            "dim_products": self.dim_products(), "dim_dates": self.dim_dates(), "dim_payment": self.dim_payment(),
        }
        return {
            **{f"source.{name}": table for name, table in cleaned.items()},
            **{f"staging.{name}": gold.stage(table, name) for name, table in cleaned.items()},
            **{f"gold.{name}": table for name, table in star.items()},
        }

    def overview(self) -> DataFrame:
        return dash.overview_orders(self.enriched())

    def sold(self) -> DataFrame:
        return dash.seller_orders(self.enriched())

    def board(self) -> DataFrame:
        return dash.seller_leaderboard(self.sold())

    @cached_property
    def scored(self) -> DataFrame:
        return sellers.scored_sellers(self.fact_orders(), self.silver("items"), self.dim_sellers())

    @cached_property
    def card(self) -> DataFrame:
        return sellers.seller_scorecard(self.fact_orders(), self.silver("items"), self.dim_sellers())

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm.rfm(self.fact_orders(), self.dim_customers())

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return dash.customer_rfm(dash.delivered_orders(self.enriched()))

    @cached_property
    def features(self) -> DataFrame:
        return materialise(ft.feature_frame(self.silver_tables(), self.raw["geolocation"]))

    @cached_property
    def delivery_model(self) -> train.Trained:
        return train.train_delivery(self.features, trees=self.trees, rounds=self.rounds)

    @cached_property
    def review_model(self) -> train.Trained:
        return train.train_review(self.features, trees=self.trees, rounds=self.rounds)

    def day_predictions(self) -> DataFrame:
        """A fixed rule in place of a model, for checking the metrics."""
        known = self.silver("orders").filter("order_status = 'delivered' and delivery_days is not null")
        return known.select(
            "order_id", F.col("delivery_days").cast("double").alias("label"),
            (10 + F.col("order_id").cast("bigint") % 20).cast("double").alias("prediction"),
        )

    def class_predictions(self) -> DataFrame:
        known = self.enriched().filter("review_score is not null")
        return known.select(
            "order_id", (F.col("review_score") >= 4).cast("int").alias("label"),
            (F.col("delivery_delay_days") == 0).cast("int").alias("prediction"),
        )


_contexts: dict[tuple[str, str], tuple[int, Context]] = {}


def context(spark: SparkSession, folder: str) -> Context:
    """The folder's warehouse, a new one when tables written for the last one have gone."""
    key, gone = (spark.sparkContext.applicationId, folder), losses(spark)
    if key not in _contexts or _contexts[key][0] != gone:
        _contexts[key] = gone, Context(spark, folder)
    return _contexts[key][1]


def query(function: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def plain_types(df: DataFrame) -> DataFrame:
    """Integers as bigint and decimals as double, so that results of two engines compare."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# ---- sources and sinks ------------------------------------------------------------------------

def _from_csv(c: Context, table: str) -> DataFrame:
    return csv_tables.read_table(c.spark, f"{c.delivered_csv(table)}/{table}.csv", table)


@query
def s1_orders_csv(c):
    return _from_csv(c, "orders")


@query
def s2_customers_csv(c):
    return _from_csv(c, "customers")


@query
def s2_sellers_csv(c):
    return _from_csv(c, "sellers")


@query
def s2_products_csv(c):
    return _from_csv(c, "products")


@query
def s2_payments_csv(c):
    return _from_csv(c, "order_payments")


@query
def s3_reviews_csv(c):
    quoted = F.concat(F.lit('he said "'), F.col("review_comment_message"), F.lit('",\nthen left'))
    path = c.scratch("reviews")
    reviews = c.raw["order_reviews"].withColumn("review_comment_message", quoted)
    csv_tables.write_csv(reviews, path)
    return csv_tables.read_table(c.spark, path, "order_reviews")


@query
def s3_reviews_split(c):
    """Files with line breaks inside quotes, each read by as many tasks as it has blocks."""
    quoted = F.concat(F.lit('he said "'), F.col("review_comment_message"), F.lit('",\n\nthen left'))
    path = c.scratch("reviews")
    csv_tables.write_csv(c.raw["order_reviews"].withColumn("review_comment_message", quoted), path)
    return csv_tables.read_table(c.spark, path, "order_reviews", split=True)


@query
def s4_write_silver(c):
    folder = c.scratch("silver")
    job = silver.silver_customers(c.raw["customers"])
    tables.write_silver(job, folder, "customers")
    tables.write_silver(job, folder, "customers")  # a second run replaces the first
    return tables.read_silver(c.spark, folder, "customers")


@query
def s5_silver_scan(c):
    return tables.table_counts(c.spark, {n: c.silver(n) for n in silver.SILVER})


@query
def s6_land_snapshot(c):
    landed = csv_tables.land_snapshot(c.spark, c.delivered_csv(), c.scratch("bronze"), run_date=dt.date(2024, 1, 2))
    dated = landed["orders"].withColumn("run_date", F.col("run_date").cast("string"))
    counts = tables.table_counts(c.spark, {**landed, "orders of the day": dated.filter("run_date = '2024-01-02'")})
    return counts


@query
def s5_saved_sellers(c):
    folder = c.scratch("silver")
    tables.write_silver(c.silver("sellers"), folder, "sellers")
    return tables.read_silver(c.spark, folder, "sellers")


@query
def s6_landed_sellers(c):
    """Every row of every landed date."""
    folder = c.scratch("bronze")
    for day in (1, 2):
        csv_tables.land_snapshot(
            c.spark, c.delivered_csv("sellers"), folder, run_date=dt.date(2024, 1, day), tables=["sellers"]
        )
    landed = csv_tables.read_snapshot(c.spark, folder, "sellers")
    return landed.withColumn("run_date", F.col("run_date").cast("date"))


@query
def s7_latest_snapshot(c):
    folder = c.scratch("bronze")
    for day in (1, 2):
        csv_tables.land_snapshot(
            c.spark, c.delivered_csv("sellers"), folder, run_date=dt.date(2024, 1, day), tables=["sellers"]
        )
    latest = csv_tables.latest_snapshot(c.spark, folder, "sellers")
    return latest.withColumn("run_date", F.col("run_date").cast("date"))


@query
def s8_load_table(c):
    tables.load_table(c.silver("orders"), "STG_ORDERS_CHECK", folder=c.scratch("warehouse"))
    return c.spark.table("STG_ORDERS_CHECK")


@query
def s9_load_all(c):
    return tables.load_all(c.spark, c.silver_tables(), folder=c.scratch("warehouse"))


@query
def s10_reconcile(c):
    bronze = tables.table_counts(c.spark, {name: c.raw[raw] for name, (raw, _) in silver.SILVER.items()})
    clean = tables.table_counts(c.spark, c.silver_tables())
    given = {name: c.silver(name) for name in tables.WAREHOUSE_NAMES}
    return tables.reconcile(bronze, clean, tables.load_all(c.spark, given, folder=c.scratch("warehouse")))


@query
def s11_artifacts(c):
    folder = c.scratch("models")
    artifacts.write_artifacts(c.delivery_model, folder, "delivery")
    return _weights(artifacts.read_importance(c.spark, folder, "delivery"))


@query
def s12_model_comparison(c):
    folder = c.scratch("models")
    artifacts.write_artifacts(c.review_model, folder, "review")
    return _comparison(artifacts.read_metrics(c.spark, folder, "review"), train.REVIEW)


# ---- validation -------------------------------------------------------------------------------

@query
def v1_readable(c):
    checks = [
        csv_tables.malformed_rows(c.spark, f"{c.delivered_csv()}/{t}.csv", t) for t in [*schemas.RAW, "absent"]
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


@query
def v2_row_count(c):
    return quality.row_count(c.raw["order_items"])


@query
def v3_column_names(c):
    raw = c.raw["order_items"].withColumnRenamed("price", " price ").drop("seller_id").withColumn("note", F.lit("x"))
    missing, extra = quality.column_difference(raw, schemas.RAW["order_items"].names)
    return raw.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(",".join(missing)).alias("missing"), F.lit(",".join(extra)).alias("extra")
    )


@query
def v4_null_counts(c):
    return quality.null_counts(c.raw["order_items"], schemas.NOT_NULL["order_items"])


@query
def v5_duplicate_rows(c):
    return quality.duplicate_rows(c.raw["products"])


@query
def v6_unparseable_dates(c):
    return quality.unparseable_counts(c.raw["orders"], ["order_purchase_timestamp", "order_approved_at"])


@query
def v7_validation_reports(c):
    reports = quality.validate_all(c.spark, c.raw)
    return reports.select(
        "file_name", "status", "row_count",
        F.array_join("checks_passed", ",").alias("passed"), F.array_join("checks_failed", ",").alias("failed"),
    )


@query
def v8_gate(c):
    """What the lenient gate lets through by name, and whether the strict one stops the run."""
    reports = quality.validate_all(c.spark, {**c.raw, "geolocation": None})
    flagged = quality.gate(reports, strict=False)
    try:
        quality.gate(reports)
        stops = False
    except quality.CriticalTables:
        stops = True
    return reports.filter(F.col("file_name").isin(*flagged)).select("file_name", "status", F.lit(stops).alias("stops"))


@query
def v9_unique(c):
    return quality.not_unique(c.raw["products"], "product_id")


@query
def v10_not_null(c):
    return quality.null_rows(c.raw["order_items"], "product_id")


@query
def v11_accepted_values(c):
    return quality.unaccepted_values(c.raw["orders"], "order_status", schemas.FACT_STATUSES)


@query
def v11_declared_tests(c):
    """All declared tests of sources, staging and star schema."""
    return declared.run_tests(c.tested_tables())


@query
def v11_declared_tests_of_raw(c):
    """The sources' tests on tables before they are cleaned, where some fail."""
    raw = {"source.orders": c.raw["orders"], "source.products": c.raw["products"], "source.reviews": c.raw["order_reviews"]}
    results = declared.run_tests(raw, {name: declared.DECLARED[name] for name in raw})
    failed = declared.stop_on_failures(results, strict=False)
    return results.withColumn("stops", F.col("table").isin(*failed))


@query
def v12_negative_delivery_days(c):
    orders = silver.with_delivery_metrics(silver.typed_orders(c.raw["orders"]))
    return quality.negative_rows(orders, "delivery_days").select("order_id", "delivery_days")


@query
def v13_negative_payments(c):
    return quality.negative_rows(c.fact_orders(), "payment_amount").select("order_id", "payment_amount")


@query
def v13_negative_after_refund(c):
    """Payments from which more is taken back than was paid."""
    refunded = c.fact_orders().withColumn("payment_amount", F.col("payment_amount") - 50_000)
    return quality.negative_rows(refunded, "payment_amount").select("order_id", "payment_amount")


@query
def v14_silver_checks(c):
    return quality.silver_checks(c.silver_tables())


# ---- projections, predicates, scalar expressions ----------------------------------------------

@query
def p1_staged_orders(c):
    return c.staged("orders")


@query
def p1_staged_customers(c):
    return c.staged("customers")


@query
def p1_staged_products(c):
    return c.staged("products")


@query
def p1_staged_sellers(c):
    return c.staged("sellers")


@query
def p1_staged_payments(c):
    return c.staged("payments")


@query
def p1_staged_reviews(c):
    return c.staged("reviews")


@query
def p2_parse_times(c):
    return silver.typed_orders(c.raw["orders"])


@query
def p3_review_casts(c):
    return silver.typed_reviews(c.raw["order_reviews"])


@query
def p4_clean_text(c):
    return c.raw["customers"].select("customer_id", fn.clean_text("customer_city").alias("customer_city"))


@query
def p5_fill_nulls(c):
    return silver.clean_products(c.raw["products"]).select(
        "product_id", "product_name_lenght", "product_description_lenght", "product_photos_qty"
    )


@query
def p6_volume(c):
    return silver.clean_products(c.raw["products"]).select("product_id", "product_volume_cm3")


def _measured(c: Context) -> DataFrame:
    return silver.with_purchase_parts(silver.with_delivery_metrics(silver.typed_orders(c.raw["orders"])))


@query
def p7_day_counts(c):
    return _measured(c).select("order_id", "order_purchase_timestamp", "delivery_days", "estimated_delivery_days")


@query
def p8_lateness(c):
    return _measured(c).select("order_id", "order_purchase_timestamp", "is_late", "delivery_delay_days")


@query
def p9_purchase_parts(c):
    return _measured(c).select(
        "order_id", "order_purchase_timestamp", "order_year", "order_month", "order_day_of_week"
    )


@query
def p10_status_filter(c):
    return silver.progressed(c.raw["orders"], schemas.NOT_PROGRESSED).select("order_id", "order_status")


@query
def p11_positive_payments(c):
    return c.raw["order_payments"].filter("payment_value > 0")


@query
def p12_regions(c):
    return c.silver("customers").select(
        "customer_id", fn.state_region("customer_state").alias("region"),
        fn.state_region("customer_state", default=None).alias("known_region"),
    )


@query
def p13_installments_bucket(c):
    return c.raw["order_payments"].select(
        "order_id", "payment_sequential", "payment_installments",
        fn.installments_bucket("payment_installments").alias("bucket"),
    )


@query
def p14_surrogate_keys(c):
    return c.raw["order_payments"].select(
        "order_id", "payment_type", "payment_installments",
        fn.surrogate_key("payment_type", "payment_installments").alias("payment_key"),
    )


@query
def p15_date_key(c):
    return c.staged("orders").select("order_id", fn.date_key("purchased_at").alias("date_key"))


@query
def p16_defaults(c):
    return c.fact_orders().select("order_id", "payment_amount", "is_late", "delivery_delay_days")


@query
def p17_period_labels(c):
    return c.staged("orders").select(
        "order_id", fn.month_label("purchased_at").alias("year_month"),
        fn.quarter_label("purchased_at").alias("year_quarter"),
        fn.month_start("purchased_at").alias("month_start"), F.quarter("purchased_at").alias("quarter"),
    )


@query
def p18_calendar(c):
    days = c.staged("orders").select(F.col("purchased_at").cast("date").alias("full_date")).distinct()
    return days.join(c.dim_dates(), "full_date")


@query
def q2_dim_dates(c):
    return c.dim_dates()


@query
def p19_month_index(c):
    return c.staged("orders").select(
        "order_id", fn.months_apart("estimated_delivery_at", "purchased_at").alias("months")
    )


@query
def p20_rfm_cell(c):
    return c.rfm.select("customer_unique_id", "rfm_cell", "rfm_total")


@query
def p21_rfm_segment(c):
    return c.rfm.select("customer_unique_id", "segment_name")


@query
def p22_total_segment(c):
    return c.customer_rfm.select("customer_id", "rfm_score", "segment")


@query
def p23_safe_ratio(c):
    per_state = c.raw["order_items"].groupBy("seller_id").agg(
        F.sum("price").alias("price"), F.count("product_id").alias("n"),
        F.count_if(F.col("price") < 0).alias("none"),
    )
    return per_state.select(
        "seller_id", fn.ratio(F.col("price"), F.col("n"), 2).alias("mean_price"),
        fn.ratio(F.col("price"), F.col("none"), 2).alias("nothing"),
    )


@query
def p24_reliability(c):
    return c.scored.select("seller_id", "reliability_score")


@query
def p25_good_review(c):
    return c.enriched().select("order_id", "review_score", "is_good_review")


@query
def p26_freight_ratio(c):
    return c.raw["order_items"].select(
        "order_id", "order_item_id", fn.freight_ratio("freight_value", "price").alias("freight_ratio")
    )


@query
def p27_comments(c):
    return c.features.select("order_id", "comment_length", "has_comment")


@query
def p28_distance(c):
    return c.features.select("order_id", F.round("distance_km", 6).alias("distance_km"))


@query
def p29_late_flag(c):
    return c.silver("orders").select(
        "order_id", fn.flag_to_int("is_late").alias("is_late_int")
    )


@query
def p30_item_value(c):
    return c.silver("items").select("order_id", "order_item_id", (F.col("price") + F.col("freight_value")).alias("total"))


@query
def p31_page_filters(c):
    e = c.enriched()
    views = {
        "overview": dash.overview_orders(e),
        "overview, whole last day": dash.overview_orders(e, inclusive_day=True),
        "overview, one year": dash.overview_orders(
            e, start=dt.date(1997, 1, 1), end=dt.date(1997, 12, 31), statuses=["delivered", "shipped"]
        ),
        "overview, any status": dash.overview_orders(e, statuses=[]),
        "years": dash.orders_of_years(e, [1996, 1998]),
        "all years": dash.orders_of_years(e),
        "sellers": dash.seller_orders(e),
        "sellers of two states": dash.seller_orders(e, ["MG", "RJ"]),
        "customers": dash.delivered_orders(e),
        "delivery and review": dash.delivery_and_review(dash.delivered_orders(e), longest=30),
    }
    return tables.table_counts(c.spark, views)


@query
def p32_late_label(c):
    return c.silver("orders").select("order_id", fn.late_label("is_late").alias("late_label"))


@query
def p33_names(c):
    return c.silver("customers").select(
        "customer_id", fn.state_name("customer_state").alias("state_name"),
        fn.short_id("customer_id", 3).alias("short_id"),
    )


@query
def p34_scoring_freight_ratio(c):
    return c.raw["order_items"].select(
        "order_id", "order_item_id",
        F.round(fn.freight_ratio_or_zero("freight_value", "price"), 10).alias("freight_ratio"),
    )


@query
def p35_revenue_per_order(c):
    return c.board().select("seller_id", F.round("revenue_per_order", 6).alias("revenue_per_order"))


# ---- joins ------------------------------------------------------------------------------------

@query
def j1_orders_enriched(c):
    return c.orders_enriched()


@query
def j2_customer_key(c):
    customer = c.dim_customers().select("customer_id", "customer_key")
    return c.orders_enriched().join(customer, "customer_id", "left").select("order_id", "customer_key")


@query
def j3_payment_key(c):
    return c.fact_orders().select("order_id", "payment_type", "installments", "payment_key")


@query
def j4_items_enriched(c):
    return gold.items_enriched(c.silver("items"), c.staged("products"), c.staged("sellers"))


@query
def j4_items_in_english(c):
    return gold.items_enriched(
        c.silver("items"), c.staged("products"), c.staged("sellers"), c.raw["category_translation"]
    ).select("order_id", "order_item_id", "product_id", "product_category")


@query
def j5_fact_customers(c):
    person = c.dim_customers().select("customer_key", "customer_unique_id", "customer_state")
    return revenue.revenue_orders(c.fact_orders()).join(person, "customer_key").select(
        "order_id", "customer_unique_id", "customer_state", "payment_amount"
    )


@query
def j6_seller_lines(c):
    return sellers.seller_metrics(c.fact_orders(), c.silver("items"), c.dim_sellers()).select(
        "seller_id", "seller_region", "total_orders", "total_revenue", "review_count"
    )


@query
def j7_activity(c):
    return cohort.active_months(c.fact_orders(), c.dim_customers())


@query
def j8_cohort_size(c):
    return cohort.cohort_retention(c.fact_orders(), c.dim_customers(), max_index=None).select(
        "cohort_label", "months_since_first_order", "cohort_size"
    )


@query
def j9_enriched_orders(c):
    return dash.enriched_orders(c.silver_tables())


@query
def j10_training_join(c):
    return c.features.select(
        "order_id", "customer_state", "seller_state", "product_category_name", "product_weight_g",
        "review_comment_message", "customer_zip_code_prefix", "seller_zip_code_prefix", "item_count",
        "total_price", "total_freight",
    )


@query
def j11_centroids(c):
    centroids = materialise(ft.geo_centroids(c.raw["geolocation"]))
    both = ft.joined_orders(c.silver_tables(), ft.order_lines(c.silver("items")), centroids)
    return both.select("order_id", *[F.round(p, 8).alias(p) for p in ("cust_lat", "cust_lng", "sell_lat", "sell_lng")])


@query
def j12_primary_type(c):
    return silver.silver_payments(c.raw["order_payments"])


@query
def j13_latest_purchase(c):
    return rfm.with_recency(rfm.rfm_base(c.fact_orders(), c.dim_customers())).select(
        "customer_unique_id", "recency_days"
    )


@query
def j14_top_states_only(c):
    e = dash.orders_of_years(c.enriched())
    best = rel.top_k(dash.customer_states(e), "order_count", 10, tie_break="customer_state")
    return rel.keep_listed(e, "customer_state", best).select("order_id", "customer_state")


# ---- aggregations -----------------------------------------------------------------------------

@query
def a1_payments_by_type(c):
    return silver.payments_by_type(c.raw["order_payments"]).drop("installments")


@query
def a2_payments_by_order(c):
    return c.silver("payments").drop("primary_payment_type")


@query
def a3_payment_dimension(c):
    return gold.dim_payment(c.staged("payments"))


@query
def a4_first_months(c):
    activity = cohort.active_months(c.fact_orders(), c.dim_customers())
    return activity.select("customer_unique_id", "cohort_month").distinct()


@query
def a5_cohort_counts(c):
    return cohort.cohort_counts(cohort.active_months(c.fact_orders(), c.dim_customers()))


@query
def a6_rfm_base(c):
    return rfm.rfm_base(c.fact_orders(), c.dim_customers())


@query
def a7_segment_summary(c):
    return rfm.rfm_summary(c.rfm)


@query
def a8_monthly_base(c):
    return revenue.monthly_base(c.fact_orders())


@query
def a9_quarterly(c):
    return revenue.quarterly(c.fact_orders())


@query
def a10_revenue_by_state(c):
    return revenue.revenue_by_state(c.fact_orders(), c.dim_customers())


@query
def a11_seller_metrics(c):
    return sellers.seller_metrics(c.fact_orders(), c.silver("items"), c.dim_sellers())


@query
def a11_seller_metrics_by_order(c):
    return sellers.seller_metrics(c.fact_orders(), c.silver("items"), c.dim_sellers(), grain="order").select(
        "seller_id", "late_orders", "on_time_rate_pct"
    )


@query
def a12_seller_states(c):
    return sellers.seller_states(c.scored)


@query
def a13_kpis(c):
    return dash.kpis(c.overview())


@query
def a14_orders_per_month(c):
    return rel.orders_per_period(c.overview(), dash.BOUGHT, "order_id", freq="month")


@query
def a14_orders_per_week(c):
    return rel.orders_per_period(c.overview(), dash.BOUGHT, "order_id", freq="week")


@query
def a14_orders_per_quarter(c):
    return rel.orders_per_period(c.overview(), dash.BOUGHT, "order_id", freq="quarter")


@query
def a15_revenue_by_month(c):
    return dash.revenue_by_month(c.overview())


@query
def a16_payment_types(c):
    return rel.value_counts(c.overview(), "primary_payment_type")


@query
def a17_review_scores(c):
    return rel.value_counts(c.overview(), "review_score").orderBy("review_score")


@query
def a18_statuses(c):
    return rel.value_counts(c.enriched(), "order_status")


@query
def a19_delivery_histogram(c):
    return rel.histogram(c.overview(), "delivery_days", bins=50)


@query
def a20_customer_states(c):
    return dash.customer_states(dash.orders_of_years(c.enriched()))


@query
def a20_customer_state_table(c):
    return dash.customer_state_table(dash.orders_of_years(c.enriched()))


@query
def a21_seller_states(c):
    return dash.seller_state_metrics(dash.orders_of_years(c.enriched()))


@query
def a22_regions(c):
    return dash.orders_by_region(dash.customer_states(dash.orders_of_years(c.enriched())))


@query
def a23_delivery_heat(c):
    return dash.delivery_heat(dash.orders_of_years(c.enriched()))


@query
def a23_delivery_heat_matrix(c):
    return dash.delivery_heat_matrix(dash.orders_of_years(c.enriched()))


@query
def a24_customer_rfm_base(c):
    people = dash.customer_rfm_base(dash.delivered_orders(c.enriched()))
    return dash.with_elapsed_recency(people).drop("last_order")


@query
def a25_segment_spend(c):
    return dash.segment_spend(c.customer_rfm)


@query
def a25_segment_summary(c):
    return dash.segment_summary(c.customer_rfm)


@query
def a26_review_by_lateness(c):
    return dash.review_by_lateness(dash.delivered_orders(c.enriched()))


@query
def a27_orders_by_month(c):
    return dash.orders_by_month(dash.delivered_orders(c.enriched()))


@query
def a28_seller_leaderboard(c):
    board = c.board()
    return board.withColumns({
        "avg_delivery_days": F.round("avg_delivery_days", 8),
        "avg_review_score": F.round("avg_review_score", 8),
        "revenue_per_order": F.round("revenue_per_order", 6),
    })


@query
def a29_seller_kpis(c):
    return dash.seller_kpis(c.board())


@query
def a30_seller_state_revenue(c):
    return dash.seller_state_revenue(c.board())


@query
def a31_seller_delivery_histogram(c):
    means = c.board().select(F.round("avg_delivery_days", 8).alias("avg_delivery_days"))
    binned = rel.histogram(means, "avg_delivery_days", bins=40)
    return binned.withColumn("bin_start", F.round("bin_start", 6))


@query
def a32_item_totals(c):
    return ft.item_totals(c.silver("items"))


@query
def a33_zip_medians(c):
    centroids = ft.geo_centroids(c.raw["geolocation"])
    return centroids.select("zip_prefix", F.round("lat", 8).alias("lat"), F.round("lng", 8).alias("lng"))


@query
def a34_top_categories(c):
    return c.features.groupBy("product_category").agg(F.count(F.lit(1)).alias("orders"))


@query
def a35_review_trend(c):
    return dash.review_trend(dash.delivery_and_review(dash.delivered_orders(c.enriched())))


@query
def a36_cohort_matrix(c):
    return cohort.cohort_matrix(cohort.cohort_retention(c.fact_orders(), c.dim_customers()))


@query
def a37_date_domain(c):
    return dash.date_domain(dash.bought(c.enriched()))


@query
def a37_status_domain(c):
    return dash.filter_domain(c.enriched(), "order_status")


@query
def a37_year_domain(c):
    return dash.filter_domain(c.enriched(), "order_year")


@query
def a37_state_domain(c):
    return dash.filter_domain(c.sold(), "seller_state")


# ---- windows ----------------------------------------------------------------------------------

@query
def w1_dedup_orders(c):
    return silver.silver_orders(c.raw["orders"]).select("order_id", "order_purchase_timestamp", "order_status")


@query
def w2_dedup_customers(c):
    return silver.silver_customers(c.raw["customers"])


@query
def w2_dedup_sellers(c):
    return silver.silver_sellers(c.raw["sellers"])


@query
def w2_dedup_products(c):
    return silver.silver_products(c.raw["products"])


@query
def w3_dedup_reviews(c):
    return silver.silver_reviews(c.raw["order_reviews"])


@query
def w4_primary_payment(c):
    return c.silver("payments").select("order_id", "primary_payment_type")


@query
def w5_rfm_tiles(c):
    return c.rfm.select("customer_unique_id", "r_score", "f_score", "m_score")


@query
def w6_month_growth(c):
    return revenue.with_growth(revenue.monthly_base(c.fact_orders())).select(
        "period_start", "prev_month_gmv", "prev_month_orders", "mom_gmv_growth_pct"
    )


@query
def w7_state_shares(c):
    return revenue.state_revenue(c.fact_orders(), c.dim_customers()).select("customer_state", "gmv_share_pct")


@query
def w8_rolling_mean(c):
    return revenue.with_growth(revenue.monthly_base(c.fact_orders())).select("period_start", "rolling_3m_avg_gmv")


@query
def w9_seller_ranks(c):
    return c.card.select(
        "seller_id", "revenue_rank", "volume_rank", "review_rank", "ontime_rank", "reliability_rank"
    )


@query
def w9_order_amount_ranks(c):
    """The same ranking over the whole fact, with many ties and nulls."""
    facts = c.fact_orders().select("order_id", "review_score", "payment_amount")
    ranks = value_ranks(facts, ["review_score", "payment_amount"], descending=True)
    return join_ranks(facts, ranks, {
        "score_rank": ("review_score", "dense_rank"), "amount_rank": ("payment_amount", "rank"),
    }).select("order_id", "score_rank", "amount_rank")


@query
def w10_state_rank(c):
    return sellers.seller_states(c.scored).select("seller_state", "state_review_rank")


@query
def w11_quartile_scores(c):
    return c.customer_rfm.select("customer_id", "recency_score", "frequency_score", "monetary_score")


@query
def w12_seller_history(c):
    return c.features.select(
        "order_id", "seller_id", F.round("seller_avg_delivery", 8).alias("seller_avg_delivery"),
        F.round("seller_avg_review", 8).alias("seller_avg_review"),
    )


@query
def w13_first_items(c):
    return dash.first_items(c.silver("items"))


# ---- order, limit, sampling, generation -------------------------------------------------------

@query
def l1_report_order(c):
    """Places are read off the report as it is sorted, so another sort would show."""
    return places(c.rfm).select("customer_unique_id", "rfm_total", "monetary", "place")


@query
def l1_cohort_order(c):
    report = cohort.cohort_retention(c.fact_orders(), c.dim_customers())
    return places(report).select("cohort_label", "months_since_first_order", "place")


@query
def l1_trend_order(c):
    return places(revenue.monthly_trend(c.fact_orders())).select("year_month", "place")


@query
def l1_scorecard_order(c):
    return places(c.card).select("seller_id", "reliability_rank", "place")


@query
def l2_top_customer_states(c):
    states = dash.customer_states(dash.orders_of_years(c.enriched()))
    return rel.top_k(states, "revenue", 10, tie_break="customer_state").select("customer_state", "revenue")


@query
def l2_top_seller_states(c):
    states = dash.seller_state_metrics(dash.orders_of_years(c.enriched()))
    return rel.top_k(states, "order_count", 10, tie_break="seller_state")


@query
def l3_top_sellers(c):
    return dash.top_sellers(c.board())


@query
def l4_bottom_sellers(c):
    return sellers.bottom_sellers(c.scored)


@query
def l5_seller_detail(c):
    return dash.seller_detail(c.board(), sort_by="avg_review_score")


@query
def l6_sample(c):
    points = dash.delivery_and_review(dash.delivered_orders(c.enriched()))
    return rel.sample_rows(points, 500, key=fn.shuffled_key("order_id", 42))


@query
def l7_date_spine(c):
    days = rel.date_spine(c.spark, *c.bought_days())
    bought = c.silver("orders").groupBy(F.col(dash.BOUGHT).cast("date").alias("date_day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return days.join(bought, "date_day", "left")


@query
def l8_distinct(c):
    return c.silver("payments").select("primary_payment_type", "num_installments").distinct()


# ---- models -----------------------------------------------------------------------------------
# What another engine can state of a fitted model: names, ranges, sizes and that parts agree.

def _weights(importance: DataFrame) -> DataFrame:
    whole = importance.agg(F.abs(F.sum("importance") - 1) < 1e-6).scalar()
    return importance.select("feature", (F.col("importance") >= 0).alias("not_negative"), whole.alias("adds_up"))


def _comparison(metrics: DataFrame, task: train.Task) -> DataFrame:
    """Each candidate's measures: in range, and the chosen one has the best score."""
    rows = artifacts.model_comparison(metrics)
    best = rows.filter(F.col("measure") == task.score).agg((F.max if task.greater_is_better else F.min)("value")).scalar()
    in_range = F.when(F.col("measure") == "R2", F.col("value") <= 1).when(
        F.col("measure").isin("MAE", "RMSE"), F.col("value") >= 0
    ).otherwise(F.col("value").between(0, 1))
    holds = ~F.col("is_best") | (F.col("measure") != task.score) | (F.col("value") == best)
    return rows.select("model", "measure", in_range.alias("in_range"), holds.alias("choice_holds"))


def _whole_days() -> Column:
    days = F.col("predicted_days")
    return days.isNotNull() & (F.bround(days, 1) == days)


def _consistent_class() -> Column:
    good, p = F.col("predicted_class") == 1, F.col("probability_good")
    label = F.when(good, "good (>= 4)").otherwise("bad (< 4)")
    return p.between(0, 1) & F.when(good, p >= 0.5).otherwise(p <= 0.5) & (F.col("label") == label)


@query
def m1_features(c):
    return c.features.select(
        "order_id", "product_category", F.col("freight_ratio"), "item_count", "price", "freight_value",
        "product_weight_g", "product_volume_cm3", "product_photos_qty", "num_installments",
        "primary_payment_type", "order_day_of_week", "order_month", "comment_length", "has_comment",
    )


@query
def m2_delivery_training(c):
    return ft.delivery_training(c.features).select("order_id", "label")


@query
def m2_review_training(c):
    return ft.review_training(c.features).select("order_id", "is_late_int", "label")


@query
def m3_label_codes(c):
    return evaluate.label_codes(ft.delivery_training(c.features), ft.DELIVERY_LABELS)


@query
def m4_medians(c):
    numeric = [f for f in ft.DELIVERY_FEATURES if f not in ft.DELIVERY_LABELS]
    medians = evaluate.feature_medians(ft.delivery_training(c.features), numeric)
    return medians.withColumn("median", F.round("median", 6))


@query
def m5_split(c):
    return evaluate.split(ft.delivery_training(c.features)).select("order_id", "is_test")


@query
def m5_stratified_split(c):
    return evaluate.split(ft.review_training(c.features), stratify="label").select("order_id", "label", "is_test")


@query
def m6_regression_candidates(c):
    return _comparison(c.delivery_model.metrics, train.DELIVERY)


@query
def m7_regression_metrics(c):
    return evaluate.regression_metrics(c.day_predictions())


@query
def m8_best_model(c):
    chosen = _comparison(c.delivery_model.metrics, train.DELIVERY).agg(F.every("choice_holds")).scalar()
    return c.delivery_model.metrics.select("train_samples", "test_samples", "target", chosen.alias("best_is_best"))


@query
def m9_feature_importance(c):
    return _weights(c.delivery_model.importance)


@query
def m10_classification_candidates(c):
    return _comparison(c.review_model.metrics, train.REVIEW)


@query
def m10_class_weights(c):
    weighted = train.with_class_weights(ft.review_training(c.features))
    return weighted.groupBy("label").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.max("balanced"), 8).alias("balanced"),
        F.round(F.max("positives"), 8).alias("positives"),
    )


@query
def m11_classification_metrics(c):
    return evaluate.classification_metrics(c.class_predictions())


@query
def m12_confusion_matrix(c):
    return evaluate.confusion_matrix(c.class_predictions())


@query
def m13_class_balance(c):
    balance = evaluate.class_balance(ft.review_training(c.features))
    return balance.select(F.round("good_pct", 8).alias("good_pct"), F.round("bad_pct", 8).alias("bad_pct"))


@query
def m14_delivery_scores(c):
    scored = score.score_delivery(c.features, c.delivery_model.model)
    return scored.select("order_id", _whole_days().alias("scored"))


@query
def m15_review_scores(c):
    scored = score.score_reviews(c.features.withColumn("is_late_int", fn.flag_to_int("is_late")), c.review_model.model)
    return scored.select("order_id", _consistent_class().alias("consistent"))


@query
def m16_prepare_scoring(c):
    known = {"seller_state": ["MG", "RJ", "unknown"], "product_category": ["economy_brand#1", "other"]}
    few = c.features.select("order_id", "seller_state", "product_category", "price")
    ready = score.prepare_scoring(few, features=["seller_state", "product_category", "price", "distance_km"], labels=known)
    return ready.select("order_id", "seller_state", "product_category", "price", "distance_km")


@query
def m17_chained_scores(c):
    scored = score.score_orders(c.features, c.delivery_model.model, c.review_model.model)
    return scored.select("order_id", _whole_days().alias("scored"), _consistent_class().alias("consistent"))


# ---- reports ----------------------------------------------------------------------------------

@query
def q1_silver_orders(c):
    return silver.silver_orders(c.raw["orders"])


@query
def q1_silver_customers(c):
    return silver.silver_customers(c.raw["customers"])


@query
def q1_silver_sellers(c):
    return silver.silver_sellers(c.raw["sellers"])


@query
def q1_silver_products(c):
    return silver.silver_products(c.raw["products"])


@query
def q1_silver_payments(c):
    return silver.silver_payments(c.raw["order_payments"])


@query
def q1_silver_reviews(c):
    return silver.silver_reviews(c.raw["order_reviews"])


@query
def q1_silver_items(c):
    return silver.silver_items(c.raw["order_items"])


@query
def q2_fact_orders(c):
    return gold.fact_orders(c.orders_enriched(), c.dim_customers(), c.dim_payment())


@query
def q2_dim_customers(c):
    return c.dim_customers()


@query
def q2_dim_sellers(c):
    return c.dim_sellers()


@query
def q2_dim_products(c):
    return c.dim_products()


@query
def q2_dim_payment(c):
    return c.dim_payment()


@query
def q3_rfm(c):
    return rfm.rfm(c.fact_orders(), c.dim_customers())


@query
def q3_rfm_summary(c):
    return rfm.rfm_summary(c.rfm)


@query
def q4_cohort_retention(c):
    return cohort.cohort_retention(c.fact_orders(), c.dim_customers())


@query
def q4_cohort_matrix(c):
    return cohort.cohort_matrix(cohort.cohort_retention(c.fact_orders(), c.dim_customers()))


@query
def q5_quarterly(c):
    return revenue.quarterly(c.fact_orders())


@query
def q5_revenue_by_state(c):
    return revenue.revenue_by_state(c.fact_orders(), c.dim_customers())


@query
def q5_monthly_trend(c):
    return revenue.monthly_trend(c.fact_orders())


@query
def q6_seller_scorecard(c):
    return sellers.seller_scorecard(c.fact_orders(), c.silver("items"), c.dim_sellers())


@query
def q6_bottom_sellers(c):
    return sellers.bottom_sellers(c.scored)


@query
def q6_seller_states(c):
    return sellers.seller_states(c.scored)


@query
def q7_customer_segments(c):
    return dash.customer_rfm(dash.delivered_orders(c.enriched()))


@query
def q8_features(c):
    frame = ft.feature_frame(c.silver_tables(), c.raw["geolocation"])
    return frame.select(
        "order_id", *[f for f in ft.DELIVERY_FEATURES if f not in ("distance_km", "seller_avg_delivery")],
        F.round("distance_km", 6).alias("distance_km"),
        F.round("seller_avg_delivery", 8).alias("seller_avg_delivery"),
    )
