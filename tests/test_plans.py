"""Physical plans: nothing but small, bounded rows may meet in one task."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tradewinds.operators.ordered import places
from tradewinds.operators.quality import CriticalTables
from tradewinds.plans import cohort, dashboard as dash, declared, gold, revenue, rfm, sellers, silver
from tradewinds.ml import features as ft


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def windows_over_one_partition(text: str) -> list[str]:
    """Window nodes whose input (through a sort) is a single-partition exchange."""
    found, lines = [], text.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            below = [x for x in lines[i + 1:i + 4] if "Sort" in x or "Exchange" in x or "Project" in x]
            if any("Exchange SinglePartition" in x for x in below):
                found.append(line.strip())
    return found


def test_dedup_limits_groups_before_the_shuffle(tables):
    for job, raw in [(silver.silver_orders, "orders"), (silver.silver_customers, "customers"), (silver.silver_reviews, "order_reviews")]:
        text = plan(job(tables.raw[raw]))
        assert "WindowGroupLimit" in text and "Partial" in text


def test_payments_are_added_up_before_both_shuffles(tables):
    text = plan(silver.silver_payments(tables.raw["order_payments"]))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in text and "partial_min_by" in text


@pytest.mark.parametrize("build", [
    lambda t: gold.fact_orders(t.orders_enriched(), t.dim_customers(), t.dim_payment()),
    lambda t: dash.enriched_orders(t.silver_tables()),
    lambda t: rfm.rfm(t.fact_orders(), t.dim_customers()),
    lambda t: cohort.cohort_retention(t.fact_orders(), t.dim_customers()),
    lambda t: sellers.seller_scorecard(t.fact_orders(), t.silver("items"), t.dim_sellers()),
    lambda t: dash.customer_rfm(dash.delivered_orders(t.enriched())),
    lambda t: dash.seller_leaderboard(t.sold()),
    lambda t: ft.feature_frame(t.silver_tables(), t.raw["geolocation"]),
])
def test_no_single_task_window_no_cross_join_no_python(tables, build):
    text = plan(build(tables))
    # the only windows allowed over one partition hold one row per slice or per class
    assert all("_slice" in w for w in windows_over_one_partition(text))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "InPandas" not in text and "ArrowEval" not in text


def test_report_reads_only_its_columns(tables):
    text = plan(revenue.monthly_trend(tables.fact_orders()))
    scan = next(line for line in text.splitlines() if "ReadSchema" in line)
    schema = scan.split("ReadSchema:")[1]
    assert "payment_amount" in schema and "approved_at" not in schema and "payment_key" not in schema
    assert "IsNotNull(order_status)" in scan or "order_status" in scan.split("PushedFilters")[1]


def test_years_reach_the_scan(spark, tables):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(dash.orders_of_years(tables.enriched(), [1996, 1998]))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in text.splitlines() if "PushedFilters" in line)
    pushed = scan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual" in pushed and "LessThan" in pushed


def test_all_declared_tests_of_a_table_share_one_scan_and_shuffle(tables):
    text = plan(declared.table_tests(tables.fact_orders(), declared.DECLARED["gold.fact_orders"]))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_declared_tests_stop_a_strict_run(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", None), (None, "z"), (None, "x")], "k string, v string")
    results = declared.run_tests({"t": rows}, {"t": {"k": declared.KEY, "v": [["x", "y"]]}})
    assert sorted(map(tuple, results.collect())) == [("t", "k", "not_null", 2), ("t", "k", "unique", 1), ("t", "v", "accepted_values", 1)]
    assert declared.stop_on_failures(results, strict=False) == ["t"]
    with pytest.raises(CriticalTables):
        declared.stop_on_failures(results)
    nothing = declared.run_tests({"t": rows.limit(0)}, {"t": {"k": declared.KEY}})
    assert [r.failing for r in nothing.collect()] == [0, 0] and declared.stop_on_failures(nothing) == []


def test_places_follow_the_frame(spark):
    frame = spark.range(0, 1000, 1, 7).withColumn("v", F.xxhash64("id"))
    for order in (F.col("v").asc(), F.col("v").desc()):
        placed = places(frame.orderBy(order)).orderBy("place").collect()
        assert [r.place for r in placed] == list(range(1000))
        assert [r.id for r in placed] == [r.id for r in frame.orderBy(order).collect()]


def test_the_wide_order_moves_by_order_only(spark, tables):
    """Without broadcasts, no exchange by another key carries the order's own columns."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.maxToStringFields", 200)
    try:
        frame = dash.enriched_orders(tables.silver_tables())
        lines = frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxToStringFields")
    exchanges = [i for i, line in enumerate(lines) if line.startswith("(") and "Exchange" in line]
    by_key = {key: [lines[i + 1] for i in exchanges if f"hashpartitioning({key}#" in lines[i + 2]] for key in ("customer_id", "seller_id", "product_id")}
    assert all(by_key.values())
    assert not [line for found in by_key.values() for line in found if "order_purchase_timestamp" in line or "review_score" in line]


def test_seller_lines_are_written_before_they_are_joined(spark, monkeypatch):
    """Else the shuffles of lines by seller and order, and by order, lie on the disks at the same time."""
    from tradewinds.operators import materialise as written

    fact = spark.createDataFrame(
        [(f"o{i}", "delivered", 1 + i % 5, i % 9, i % 4 == 0) for i in range(40)],
        "order_id string, order_status string, review_score int, delivery_days int, is_late boolean",
    )
    items = spark.createDataFrame(
        [(f"s{i % 7}", f"o{i % 45}", f"{i}.25", "1.50") for i in range(120)],
        "seller_id string, order_id string, price string, freight_value string",
    ).withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "freight_value")})
    shops = spark.createDataFrame(
        [(f"s{i}", "town", "SP", "Southeast") for i in range(7)],
        "seller_id string, seller_city string, seller_state string, seller_region string",
    )
    frames, write = [], written.materialise
    monkeypatch.setattr(sellers, "materialise", lambda df, **how: frames.append(df) or write(df, **how))
    here = written._written.setdefault(spark.sparkContext.applicationId, [])
    before = len(here)
    scored = sellers.scored_sellers(fact, items, shops)
    assert not any("Join" in plan(df) and "partial_sum(freight_value" in plan(df) for df in frames)
    assert len(here) == before + 1  # the lines have gone
    metrics = sellers.seller_metrics(fact, items, shops)
    assert sorted(scored.select(metrics.columns).collect()) == sorted(metrics.collect())
