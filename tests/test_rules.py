"""Hand-made frames for rules the given tables cannot show."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradewinds import functions as fn
from tradewinds.ml import evaluate, features as ft, score
from tradewinds.operators import quality, relational as rel
from tradewinds.plans import cohort, dashboard as dash, gold, revenue, rfm, sellers, silver
from tradewinds.schemas import RAW, STATES
from tradewinds.sources import testdata


def column(df, name):
    return [r[name] for r in df.collect()]


def raw_order(order_id, status="delivered", bought="2017-01-05 10:00:00", delivered=None, promised=None):
    return (order_id, f"c{order_id}", status, bought, None, None, delivered, promised)


def test_malformed_and_lenient_timestamps(spark):
    rows = [raw_order("1", bought="n/a"), raw_order("2", bought="2017-1-5"), raw_order("3")]
    got = silver.silver_orders(spark.createDataFrame(rows, RAW["orders"])).orderBy("order_id")
    assert column(got, "order_purchase_timestamp") == [None, dt.datetime(2017, 1, 5), dt.datetime(2017, 1, 5, 10)]
    assert column(got, "order_year") == [None, 2017, 2017]


def test_late_by_zero_days_and_unknown_lateness(spark):
    rows = [
        raw_order("1", delivered="2017-01-09 15:00:00", promised="2017-01-09 00:00:00"),
        raw_order("2", delivered="2017-01-12 01:00:00", promised="2017-01-09 00:00:00"),
        raw_order("3", delivered="2017-01-08 23:00:00", promised="2017-01-09 00:00:00"),
        raw_order("4", promised="2017-01-09 00:00:00"),
    ]
    got = silver.silver_orders(spark.createDataFrame(rows, RAW["orders"])).orderBy("order_id").collect()
    assert [(r["is_late"], r["delivery_delay_days"], r["delivery_days"]) for r in got] == [
        (True, 0, 4), (True, 3, 7), (False, 0, 3), (None, 0, None),
    ]


def test_null_status_is_dropped_with_the_listed_ones(spark):
    rows = [raw_order("1", None), raw_order("2", "created"), raw_order("3", "unavailable"), raw_order("4", "canceled")]
    assert column(silver.silver_orders(spark.createDataFrame(rows, RAW["orders"])), "order_id") == ["4"]


def test_earliest_purchase_is_kept_and_null_comes_last(spark):
    rows = [
        raw_order("1", bought="2017-01-07 00:00:00"), raw_order("1", bought="2017-01-05 00:00:00"),
        raw_order("2", bought=None), raw_order("2", bought="2018-01-01 00:00:00"),
    ]
    got = silver.silver_orders(spark.createDataFrame(rows, RAW["orders"])).orderBy("order_id")
    assert column(got, "order_purchase_timestamp") == [dt.datetime(2017, 1, 5), dt.datetime(2018, 1, 1)]


def test_reviews_are_deduplicated_by_review_then_by_order(spark):
    def review(review_id, order_id, answered, score="5"):
        return (review_id, order_id, score, None, None, "2018-01-01", answered)

    rows = [
        # r1 is kept for order b, so order a is left with r2 although r1 answered it later
        review("r1", "a", "2018-01-05"), review("r1", "b", "2018-01-06"), review("r2", "a", "2018-01-02"),
        review("r3", "c", None), review("r4", "c", "2018-01-01", "x"),
    ]
    got = silver.silver_reviews(spark.createDataFrame(rows, RAW["order_reviews"])).orderBy("order_id").collect()
    assert [(r["order_id"], r["review_id"]) for r in got] == [("a", "r2"), ("b", "r1"), ("c", "r4")]
    assert got[2]["review_score"] is None and got[0]["review_comment_title"] == ""


def test_primary_payment_type_by_total_with_ties_and_null_order(spark):
    rows = [
        ("1", 1, "voucher", 1, Decimal("5")), ("1", 2, "voucher", 3, Decimal("6")), ("1", 3, "boleto", 1, Decimal("10")),
        ("2", 1, "voucher", 1, Decimal("5")), ("2", 2, "boleto", 1, Decimal("5")),
        ("3", 1, "boleto", 1, Decimal("0")), ("3", 2, "boleto", 1, Decimal("-1")),
        (None, 1, "boleto", 2, Decimal("7")),
    ]
    got = silver.silver_payments(spark.createDataFrame(rows, RAW["order_payments"])).collect()
    assert {r["order_id"]: (float(r["total_payment"]), r["num_installments"], r["primary_payment_type"]) for r in got} == {
        "1": (21.0, 3, "voucher"), "2": (10.0, 1, "boleto"), None: (7.0, 2, None),
    }


def test_product_volume_needs_all_sides(spark):
    with_sides = spark.createDataFrame([("p", 1.0, 2.0, 3.0)], "product_id string, product_length_cm double, product_height_cm double, product_width_cm double")
    named = with_sides.withColumn("product_category_name", F.lit(" Toys "))
    assert silver.clean_products(named).first()["product_volume_cm3"] == 6.0
    assert silver.clean_products(named).first()["product_category_name"] == "toys"
    assert "product_volume_cm3" not in silver.clean_products(named.drop("product_width_cm")).columns


def test_first_item_takes_each_column_from_its_first_value(spark):
    rows = [
        ("1", 2, "p2", "s2", None, Decimal("20"), Decimal("2")), ("1", 1, None, "s1", None, Decimal("10"), None),
        ("2", None, "px", "sx", None, Decimal("1"), Decimal("1")), ("2", 5, "p5", "s5", None, Decimal("5"), Decimal("5")),
        (None, 1, "p", "s", None, Decimal("1"), Decimal("1")),
    ]
    got = dash.first_items(spark.createDataFrame(rows, RAW["order_items"])).orderBy("order_id").collect()
    assert [tuple(r) for r in got] == [
        ("1", "p2", "s1", Decimal("10.00"), Decimal("2.00")), ("2", "p5", "s5", Decimal("5.00"), Decimal("5.00")),
    ]


def test_regions_and_names_cover_every_state(spark):
    codes = [*STATES, "XX", None]
    got = spark.createDataFrame([(c,) for c in codes], "s string").select(
        "s", fn.state_region("s").alias("r"), fn.state_region("s", default=None).alias("k"), fn.state_name("s").alias("n")
    ).collect()
    regions = [r["r"] for r in got[:27]]
    assert {r: regions.count(r) for r in set(regions)} == {
        "Southeast": 4, "South": 3, "Northeast": 9, "North": 7, "Central-West": 4,
    }
    assert [tuple(r)[1:] for r in got[27:]] == [("Unknown", None, None)] * 2
    assert got[25]["n"] == "Sao Paulo"


def test_surrogate_key_marks_nulls(spark):
    row = spark.createDataFrame([("a", None)], "x string, y int").select(fn.surrogate_key("x", "y").alias("k")).first()
    import hashlib

    assert row["k"] == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_payment_key_treats_missing_installments_as_one(spark):
    payments = spark.createDataFrame(
        [("1", "boleto", None), ("2", "boleto", 1), ("3", "voucher", None), ("4", None, 2)],
        "order_id string, payment_type string, installments int",
    )
    enriched = payments.selectExpr(
        "*", "'c' AS customer_id", "'delivered' AS order_status", "CAST(NULL AS DECIMAL(18,2)) AS payment_amount",
        "timestamp_ntz '2017-03-04 05:06:07' AS purchased_at", "CAST(NULL AS TIMESTAMP_NTZ) AS approved_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS shipped_at", "CAST(NULL AS TIMESTAMP_NTZ) AS delivered_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS estimated_delivery_at", "CAST(NULL AS INT) AS delivery_days",
        "CAST(NULL AS INT) AS estimated_delivery_days", "CAST(NULL AS BOOLEAN) AS is_late",
        "CAST(NULL AS INT) AS delivery_delay_days", "CAST(NULL AS INT) AS review_score",
        "2017 AS order_year", "3 AS order_month", "7 AS order_day_of_week",
    )
    customers = spark.createDataFrame([("k", "c")], "customer_key string, customer_id string")
    dim = gold.dim_payment(payments)
    keys = {(r["payment_type"], r["installments"]): r["payment_key"] for r in dim.collect()}
    fact = gold.fact_orders(enriched, customers, dim).orderBy("order_id").collect()
    assert [r["payment_key"] for r in fact] == [keys["boleto", 1], keys["boleto", 1], None, None]
    assert (fact[0]["date_key"], float(fact[0]["payment_amount"]), fact[0]["is_late"], fact[0]["delivery_delay_days"]) == (20170304, 0.0, False, 0)


def test_calendar(spark):
    days = {r["full_date"]: r for r in gold.dim_dates(spark).collect()}
    assert len(days) == 1096
    sunday = days[dt.date(2017, 1, 1)]
    assert (sunday["day_of_week"], sunday["day_of_week_iso"], sunday["day_name"], sunday["is_weekend"]) == (0, 7, "Sunday", True)
    assert (sunday["year_quarter"], sunday["year_month"], sunday["date_key"]) == ("2017-Q1", "2017-01", 20170101)
    assert days[dt.date(2016, 2, 29)]["month_name"] == "February"


def test_months_apart_counts_boundaries(spark):
    df = spark.sql("SELECT date '2017-02-01' AS b, date '2017-01-31' AS a, date '2016-12-31' AS c")
    row = df.select(fn.months_apart("b", "a").alias("x"), fn.months_apart("b", "c").alias("y")).first()
    assert tuple(row) == (1, 2)


def test_ratios_round_exactly_and_survive_zero(spark):
    df = spark.sql("SELECT 2.01BD AS s, 2L AS n, 0L AS z, 0.25BD AS q, 1L AS one")
    row = df.select(
        fn.ratio(F.col("s"), F.col("n"), 2), fn.ratio(F.col("s"), F.col("z"), 2),
        fn.ratio(F.col("q"), F.col("one"), 1), fn.ratio(F.col("q"), F.col("one"), 1, half_even=True),
    ).first()
    assert [None if v is None else float(v) for v in row] == [1.01, None, 0.3, 0.2]


def test_freight_ratios_of_a_free_order(spark):
    df = spark.sql("SELECT CAST(0 AS DECIMAL(18,2)) AS f, CAST(0 AS DECIMAL(18,2)) AS p")
    assert tuple(df.select(fn.freight_ratio("f", "p"), fn.freight_ratio_or_zero("f", "p")).first()) == (None, 0.0)


def test_haversine(spark):
    df = spark.sql("SELECT 0D AS a, 0D AS b, 0D AS c, 180D AS d, CAST(NULL AS DOUBLE) AS e")
    row = df.select(fn.haversine_km("a", "b", "c", "d"), fn.haversine_km("a", "b", "a", "b"), fn.haversine_km("a", "b", "c", "e")).first()
    assert row[0] == pytest.approx(3.141592653589793 * 6371) and row[1] == 0.0 and row[2] is None


def test_segment_rules_and_the_unreachable_label(spark):
    scores = spark.sql("SELECT r AS r_score, f AS f_score, m AS m_score FROM (SELECT explode(sequence(1,5)) r), (SELECT explode(sequence(1,5)) f), (SELECT explode(sequence(1,5)) m)")
    label = {tuple(r)[:3]: r["s"] for r in scores.withColumn("s", rfm.segment()).collect()}
    assert "At Risk" not in label.values()
    assert label[5, 5, 5] == "Champions" and label[1, 3, 3] == "Loyal Customers" and label[5, 2, 5] == "Recent Customers"
    assert label[3, 2, 2] == "Potential Loyalists" and label[1, 5, 1] == "Cannot Lose Them"
    assert label[2, 1, 1] == "Needs Attention" and label[1, 1, 1] == "Lost" and label[1, 1, 5] == "Other"


def test_periods_fill_gaps_and_end_on_sunday(spark):
    rows = [("1", dt.datetime(2018, 1, 1, 5)), ("2", dt.datetime(2018, 1, 7, 23)), (None, dt.datetime(2018, 1, 2)), ("3", dt.datetime(2018, 1, 22)), ("4", None)]
    df = spark.createDataFrame(rows, "order_id string, at timestamp_ntz")
    weeks = rel.orders_per_period(df, "at", "order_id", freq="week").orderBy("date").collect()
    assert [(r["date"].day, r["orders"]) for r in weeks] == [(7, 2), (14, 0), (21, 0), (28, 1)]
    quarters = rel.orders_per_period(df, "at", "order_id", freq="quarter").collect()
    assert [(r["date"], r["orders"]) for r in quarters] == [(dt.date(2018, 3, 31), 3)]
    assert rel.orders_per_period(df.filter("at is null"), "at", "order_id").collect() == []


def test_end_date_is_midnight_unless_the_day_is_included(spark):
    rows = [("1", dt.datetime(2018, 1, 1, 0)), ("2", dt.datetime(2018, 1, 3, 0)), ("3", dt.datetime(2018, 1, 3, 9))]
    df = spark.createDataFrame(rows, "order_id string, order_purchase_timestamp timestamp_ntz")
    assert column(dash.in_date_range(df), "order_id") == ["1", "2"]
    assert column(dash.in_date_range(df, inclusive_day=True), "order_id") == ["1", "2", "3"]
    assert column(dash.in_date_range(df, end=dt.date(2018, 1, 2)), "order_id") == ["1"]


def test_histogram_keeps_the_greatest_value_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10)] + [(None,)], "v double")
    assert [tuple(r) for r in rel.histogram(df, "v", bins=5).orderBy("bin").collect()] == [(0, 0.0, 2), (1, 2.0, 1), (4, 8.0, 2)]
    assert [tuple(r) for r in rel.histogram(df.filter("v = 9"), "v", bins=5).collect()] == [(0, 9.0, 1)]


def fact(spark, rows):
    """(order_id, customer_key, status, bought, amount, score, days, late)"""
    return spark.createDataFrame(
        [(o, c, s, b, None if a is None else Decimal(a), r, d, l) for o, c, s, b, a, r, d, l in rows],
        "order_id string, customer_key string, order_status string, purchased_at timestamp_ntz, payment_amount decimal(18,2), "
        "review_score int, delivery_days int, is_late boolean",
    )


def test_retention_with_a_skipped_month(spark):
    day = lambda month: dt.datetime(2018, month, 28)
    facts = fact(spark, [
        ("1", "k1", "delivered", day(1), "1", 5, 1, False), ("2", "k2", "delivered", day(3), "1", 5, 1, False),
        ("3", "k3", "delivered", day(1), "1", 5, 1, False), ("4", "k4", "canceled", day(2), "1", 5, 1, False),
    ])
    customers = spark.createDataFrame([("k1", "A"), ("k2", "A"), ("k3", "B"), ("k4", "B")], "customer_key string, customer_unique_id string")
    retention = cohort.cohort_retention(facts, customers)
    assert [tuple(map(str, r)) for r in retention.collect()] == [("2018-01", "2", "0", "2", "100.00"), ("2018-01", "2", "2", "1", "50.00")]
    matrix = cohort.cohort_matrix(retention).first()
    assert (float(matrix["Month 0"]), matrix["Month 1"], float(matrix["Month 2"])) == (100.0, None, 50.0)


def test_on_time_rate_by_item_can_fall_below_zero(spark):
    facts = fact(spark, [("1", "k", "delivered", dt.datetime(2018, 1, 1), "1", 4, 9, True), ("2", "k", "canceled", dt.datetime(2018, 1, 1), "1", 1, 9, True)])
    items = spark.createDataFrame(
        [("1", i, "p", "s", None, Decimal("10"), Decimal("1")) for i in (1, 2, 3)] + [("2", 1, "p", "s", None, Decimal("99"), Decimal("1"))],
        RAW["order_items"],
    )
    shops = spark.createDataFrame([("s", "x", "SP", "Southeast")], "seller_id string, seller_city string, seller_state string, seller_region string")
    by_item = sellers.seller_metrics(facts, items, shops).first()
    by_order = sellers.seller_metrics(facts, items, shops, grain="order").first()
    assert (by_item["total_orders"], by_item["late_orders"], float(by_item["on_time_rate_pct"])) == (1, 3, -200.0)
    assert (by_order["late_orders"], float(by_order["on_time_rate_pct"]), float(by_order["total_revenue"])) == (1, 0.0, 30.0)


def test_growth_after_a_month_without_revenue(spark):
    facts = fact(spark, [
        ("1", "a", "delivered", dt.datetime(2018, 1, 1), "0", 4, 9, True), ("2", "b", "delivered", dt.datetime(2018, 2, 1), "10", None, 9, False),
        ("3", "b", "delivered", dt.datetime(2018, 3, 1), "5", 5, 9, False), ("4", "b", "unavailable", dt.datetime(2018, 3, 1), "5", 5, 9, False),
    ])
    got = revenue.monthly_trend(facts).collect()
    assert [None if r["mom_gmv_growth_pct"] is None else float(r["mom_gmv_growth_pct"]) for r in got] == [None, None, -50.0]
    assert [float(r["rolling_3m_avg_gmv"]) for r in got] == [0.0, 5.0, 5.0]
    assert float(got[0]["late_delivery_pct"]) == 100.0 and got[1]["avg_review_score"] is None


def test_duplicates_count_null_as_equal(spark):
    df = spark.createDataFrame([("a", None)] * 3 + [("a", 1)] * 2 + [("b", None)], "x string, y int")
    assert quality.duplicate_rows(df).first()[0] == 3
    assert quality.duplicate_rows(df.limit(0)).first()[0] == 0


def test_validation_statuses(spark):
    good = spark.createDataFrame([("a", "en a"), ("b", "en b")], RAW["category_translation"])
    args = {"name": "t", "required": RAW["category_translation"].names, "not_null": ["product_category_name"]}
    assert quality.validate_table(good, **args).first()["status"] == "PASS"
    empty = quality.validate_table(good.limit(0), **args).first()
    assert (empty["status"], empty["checks_failed"], empty["details"]) == ("CRITICAL", ["critical_error"], {"error": "Empty file: t"})
    missing = quality.validate_table(good.drop("product_category_name_english"), **args).first()
    assert missing["status"] == "CRITICAL" and "product_category_name_english" in missing["details"]["error"]
    spaced = good.withColumnRenamed("product_category_name", " product_category_name ").withColumn("more", F.lit(1))
    report = quality.validate_table(spaced, **args).first()
    assert report["status"] == "PASS" and report["details"]["extra_columns"] == "more"
    bad = good.union(spark.createDataFrame([(None, "x"), ("a", "en a")], RAW["category_translation"]))
    report = quality.validate_table(bad, **args).first()
    assert report["status"] == "FAIL" and report["checks_failed"] == ["no_key_nulls", "no_full_duplicates"]
    assert report["details"]["null_counts"] == "product_category_name (1 null)"
    dated = spark.createDataFrame([("2018-01-01",), ("soon",), (None,)], "d string")
    report = quality.validate_table(dated, name="d", required=["d"], dates=["d"]).first()
    assert report["checks_failed"] == ["date_columns_parseable"] and report["details"]["unparseable_dates"] == "d (1 unparseable)"


def test_validation_compares_rows_of_one_hash(spark, monkeypatch):
    df = spark.createDataFrame([("a", "b")] * 3 + [("a", None)] * 2 + [("c", "d")], RAW["category_translation"])
    args = {"name": "t", "required": RAW["category_translation"].names}
    assert quality.validate_table(df, **args).first()["details"]["duplicate_rows"] == "3"
    monkeypatch.setattr(quality.F, "xxhash64", lambda *columns: F.lit(1).cast("bigint"))  # all rows collide
    report = quality.validate_table(df, **args, not_null=["product_category_name_english"]).first()
    assert report["details"]["duplicate_rows"] == "3" and report["row_count"] == 6
    assert report["details"]["null_counts"] == "product_category_name_english (2 null)"


def test_quarters_without_joins(spark):
    values = [None, 1, 1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    df = spark.createDataFrame([(i, v, None) for i, v in enumerate(values)], "id int, v int, nothing int")
    got = dash.quartile_scores(df, {"q": ("v", False), "r": ("v", True), "n": ("nothing", False)})
    ranks = pd.Series(values).rank(pct=True, method="average")
    expected = [4 if pd.isna(p) else 1 + (p > 0.25) + (p > 0.5) + (p > 0.75) for p in ranks]
    rows = got.orderBy("id").collect()
    assert [r["q"] for r in rows] == expected and [r["r"] for r in rows] == [5 - q for q in expected]
    assert {r["n"] for r in rows} == {4}
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_gate_stops_on_critical_only_when_strict(spark):
    reports = quality.validate_all(spark, {})
    assert column(quality.summary_line(reports), "summary")[0] == "[CRITICAL] orders | rows=0 | passed=0 | failed=1"
    with pytest.raises(quality.CriticalTables):
        quality.gate(reports)
    assert len(quality.gate(reports, strict=False)) == 9


def test_a_table_that_cannot_be_read_leaves_the_others_alone(spark, tmp_path):
    path = str(tmp_path / "gone")
    spark.createDataFrame([("a", "b")], RAW["category_translation"]).write.parquet(path)
    gone = spark.read.parquet(path)
    import shutil

    shutil.rmtree(path)
    sound = spark.createDataFrame([("s", "00001", "x", "SP")], RAW["sellers"])
    reports = quality.validate_all(spark, {"category_translation": gone, "sellers": sound})
    status = {r["file_name"]: r["status"] for r in reports.collect()}
    assert status["category_translation"] == "CRITICAL" and status["sellers"] == "PASS"


def test_macro_metrics_with_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)], "label int, prediction int")
    row = evaluate.classification_metrics(df).first()
    assert tuple(row) == (0.75, 0.375, 0.5, 0.4286)
    assert [tuple(r) for r in evaluate.confusion_matrix(df).collect()] == [(0, 0, 1), (1, 0, 3)]


def test_unseen_labels_fall_back(spark):
    df = spark.createDataFrame([("SP",), ("ZZ",), (None,)], "s string")
    assert column(df.select(score.known_label("s", ["RJ", "SP", "unknown"]).alias("v")), "v") == ["SP", "unknown", "unknown"]
    assert column(df.select(score.known_label("s", ["RJ", "SP"]).alias("v")), "v") == ["SP", "RJ", "RJ"]
    ready = score.prepare_scoring(df, features=["s", "n"], labels={"s": ["SP"]})
    assert dict(ready.dtypes) == {"s": "string", "n": "double"}


def test_history_uses_earlier_orders_of_the_same_seller_only(spark):
    at = lambda d: dt.datetime(2018, 1, d)
    orders = spark.createDataFrame(
        [("1", at(1), 4), ("2", at(2), None), ("3", at(3), 8), ("4", at(4), 1), ("5", None, 9)],
        "order_id string, order_purchase_timestamp timestamp_ntz, delivery_days int",
    )
    reviews = spark.createDataFrame([("1", 5), ("2", 2)], "order_id string, review_score int")
    lines = spark.createDataFrame([("1", "s"), ("2", "s"), ("3", "s"), ("4", "t"), ("5", "s")], "order_id string, seller_id string")
    got = {r["order_id"]: (r["seller_avg_delivery"], r["seller_avg_review"]) for r in ft.seller_history(orders, reviews, lines).collect()}
    assert got == {"1": (None, None), "2": (4.0, 5.0), "3": (4.0, 3.5), "4": (None, None), "5": (6.0, 3.5)}


def test_nations_beyond_the_list_have_no_state(spark):
    nations = spark.createDataFrame([(i, n) for i, n in enumerate([0, 24, 25, 1499, -1, -27])], "i int, n int")
    assert column(nations.withColumn("s", testdata._state("n")).orderBy("i"), "s") == ["AC", "XX", None, None, None, None]
