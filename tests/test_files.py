"""CSV and snapshot reading, warehouse loads, the whole run, saved models."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tradewinds.ml import score, train
from tradewinds.operators.quality import CriticalTables
from tradewinds.plans.run import run_snapshot
from tradewinds.schemas import RAW
from tradewinds.sources import artifacts, csv_tables, quoted_csv, tables as saved


@pytest.fixture(scope="module")
def delivered(tables):
    return tables.delivered_csv()


def test_quoted_newlines_and_quotes(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        ",".join(RAW["order_reviews"].names) + "\n"
        + 'r1,o1,5,"said ""hi""","two\nlines",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
        + "r2,o2,4,,,2018-01-01 00:00:00,\n"
    )
    rows = csv_tables.read_table(spark, str(path), "order_reviews").orderBy("review_id").collect()
    assert rows[0]["review_comment_title"] == 'said "hi"' and rows[0]["review_comment_message"] == "two\nlines"
    assert rows[1]["review_comment_title"] is None and rows[1]["review_answer_timestamp"] is None


def test_zip_prefix_keeps_its_zeros_and_bad_numbers_become_null(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(",".join(RAW["order_items"].names) + "\no1,x,p,s,2018-01-01,1.50,free\n")
    row = csv_tables.read_table(spark, str(path), "order_items").first()
    assert (row["order_item_id"], str(row["price"]), row["freight_value"]) == (None, "1.50", None)


def test_malformed_lines_are_counted(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("product_category_name,product_category_name_english\na,b\na,b,c\na\n")
    row = csv_tables.malformed_rows(spark, str(path), "category_translation").first()
    assert tuple(row) == ("category_translation", True, 2)


def test_nothing_is_landed_when_a_table_is_missing(spark, delivered, tmp_path):
    with pytest.raises(csv_tables.MissingTables, match="absent"):
        csv_tables.land_snapshot(spark, delivered, str(tmp_path / "b"), tables=["orders", "absent"])
    assert not (tmp_path / "b").exists()
    with pytest.raises(csv_tables.NoSnapshot):
        csv_tables.read_snapshot(spark, str(tmp_path / "b"), "orders")


def test_landing_twice_keeps_the_first_and_the_latest_date_is_read(spark, delivered, tmp_path):
    bronze = str(tmp_path / "bronze")
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 3), dt.date(2024, 1, 3)):
        csv_tables.land_snapshot(spark, delivered, bronze, run_date=day, tables=["sellers"])
    everything = csv_tables.read_snapshot(spark, bronze, "sellers")
    latest = csv_tables.latest_snapshot(spark, bronze, "sellers")
    assert everything.count() == 2 * latest.count()
    assert [str(r[0]) for r in latest.select("run_date").distinct().collect()] == ["2024-01-03"]


def test_warehouse_types_and_isolated_failures(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, true AS flag, timestamp '2018-01-01 00:00:00' AS at")
    assert saved.warehouse_columns(df).dtypes == [("ID", "int"), ("FLAG", "bigint"), ("AT", "timestamp_ntz")]
    broken = df.withColumn("id", F.raise_error(F.lit("no")).cast("int"))
    loaded = saved.load_all(
        spark, {"a": df, "b": broken, "c": None}, names={"a": "STG_A", "b": "STG_B", "c": "STG_C"}, folder=str(tmp_path)
    )
    assert {r["table"]: r["rows"] for r in loaded.collect()} == {"STG_A": 1, "STG_B": -1}
    assert saved.load_table(df.union(df), "STG_A", folder=str(tmp_path)) == 2
    assert spark.table("STG_A").count() == 2


def test_reconciliation_marks_what_is_missing(spark):
    bronze = spark.createDataFrame([("a", 5), ("b", -1), ("c", 7)], saved.LOADED)
    silver = spark.createDataFrame([("a", 4)], saved.LOADED)
    loaded = spark.createDataFrame([("STG_A", 4), ("STG_C", -1)], saved.LOADED)
    assert {tuple(r) for r in saved.reconcile(bronze, silver, loaded, names={"a": "STG_A", "b": "STG_B", "c": "STG_C"}).collect()} == {
        ("a", 5, 4, "4"), ("b", -1, -1, "skipped"), ("c", 7, -1, "FAILED"),
    }


def test_whole_run(spark, delivered, tables, tmp_path):
    target = str(tmp_path / "lake")
    first = run_snapshot(spark, delivered, target, run_date=dt.date(2024, 1, 1), skip_load=True)
    counts = {r["table"]: (r["bronze"], r["silver"], r["loaded"]) for r in first.collect()}
    assert counts["orders"] == (tables.raw["orders"].count(), tables.silver("orders").count(), "skipped")
    assert len(counts) == 7
    again = run_snapshot(spark, delivered, target, run_date=dt.date(2024, 1, 1), skip_silver=True, skip_load=True)
    assert {r["table"]: r["silver"] for r in again.collect()} == {t: c[1] for t, c in counts.items()}


def test_whole_run_with_the_load_counts_every_table(spark, delivered, tables, tmp_path):
    counts = run_snapshot(spark, delivered, str(tmp_path / "lake"), run_date=dt.date(2024, 1, 1)).collect()
    loaded = {r["table"]: r["loaded"] for r in counts}
    assert loaded["items"] == str(tables.silver("items").count())
    assert len(loaded) == 7 and all(n.isdigit() for n in loaded.values())


def test_strict_run_stops_on_an_empty_table(spark, delivered, tmp_path):
    import shutil

    source = tmp_path / "source"
    shutil.copytree(delivered, source)
    shutil.rmtree(source / "sellers.csv")
    (source / "sellers.csv").write_text(",".join(RAW["sellers"].names) + "\n")
    with pytest.raises(CriticalTables, match="sellers"):
        run_snapshot(spark, str(source), str(tmp_path / "lake"), strict=True)


def test_saved_model_scores_like_the_fitted_one(spark, tables, tmp_path):
    folder = str(tmp_path)
    assert artifacts.read_metrics(spark, folder, "review").count() == 0
    assert artifacts.read_importance(spark, folder, "review").count() == 0
    trained = tables.review_model
    artifacts.write_artifacts(trained, folder, "review")
    metrics = artifacts.read_metrics(spark, folder, "review").first()
    assert metrics["train_samples"] + metrics["test_samples"] == tables.enriched().filter("review_score is not null").count()
    assert set(metrics["all_models"]) == set(train.classifiers())
    assert sum(map(sum, metrics["confusion_matrix"])) == metrics["test_samples"]
    best = max(m["f1_macro"] for m in metrics["all_models"].values())
    assert metrics["best_metrics"]["f1_macro"] == best
    importance = artifacts.read_importance(spark, folder, "review")
    assert importance.count() == 15
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1, abs=1e-6)

    new = tables.features.select("order_id", "price", "freight_value", "product_category", "num_installments")
    loaded = artifacts.read_model(spark, folder, "review")
    one = score.score_reviews(new, trained.model).select("order_id", "probability_good").collect()
    two = score.score_reviews(new, loaded).select("order_id", "probability_good").collect()
    assert sorted(one) == sorted(two) and len(one) == new.count()


def test_feature_without_any_value_is_left_out_by_name(spark, tables):
    from tradewinds.ml import features as ft

    rows = ft.delivery_training(tables.features).withColumn("distance_km", F.lit(None).cast("double"))
    _, used = train.preparation(rows, train.DELIVERY)
    assert "distance_km" not in used and len(used) == 14


@pytest.mark.parametrize("block", [7, 23, 64, 1000])
def test_quoted_records_across_every_border(spark, tmp_path, block):
    """Blocks of a few bytes, so that quotes, records and blank lines stand across their borders."""
    draw = random.Random(block)
    names = RAW["order_reviews"].names
    for part in range(2):
        lines = [",".join(names)]
        for i in range(60):
            words = draw.choices(["a", '""', "\n", "\n\n", ",", "é🙂", " ", "\r\n"], k=draw.randint(1, 12))
            comment = '"' + "".join(words) + '"' if draw.random() < 0.7 else draw.choice(["", "plain"])
            lines.append(f"r{part}-{i},o{i},{draw.choice(['5', 'x', ''])},,{comment},2018-01-01 00:00:00," + draw.choice(["", "soon"]))
            lines += [""] * draw.choice([0, 0, 1])
        (tmp_path / f"{part}.csv").write_bytes(("\n".join(lines) + draw.choice(["", "\n"])).encode())
    plain = csv_tables.read_table(spark, str(tmp_path), "order_reviews")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        assert block == 1000 or quoted_csv.quoted_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
        split = csv_tables.read_table(spark, str(tmp_path), "order_reviews", split=True)
        text = csv_tables.read_as_text(spark, str(tmp_path), "order_reviews", split=True)
        assert split.schema.simpleString() == plain.schema.simpleString()
        key = lambda r: repr(tuple(r))
        assert sorted(split.collect(), key=key) == sorted(plain.collect(), key=key)
        assert text.columns == names and text.count() == plain.count() == 120
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quoted_records_defined_cases(spark, tmp_path):
    header = ",".join(RAW["category_translation"].names)
    read = lambda: sorted(map(tuple, quoted_csv.read_quoted(spark, str(tmp_path / "t.csv"), RAW["category_translation"]).collect()))
    (tmp_path / "t.csv").write_bytes(f"﻿{header}\r\na,b\r\n\r\nc\r\n\"d\r\ne\",f".encode())
    assert read() == [("a", "b"), ("c", None), ("d\r\ne", "f")]
    (tmp_path / "t.csv").write_text(f"{header}\n")
    assert read() == []
    (tmp_path / "t.csv").write_text("")
    assert read() == []
    (tmp_path / "t.csv").write_text("one,two\na,b\n")
    with pytest.raises(quoted_csv.WrongHeader, match="one,two"):
        read()


def test_a_query_builds_again_what_has_gone(spark, monkeypatch):
    """Another may empty the folder of written tables between two queries of a session."""
    from tests.conftest import SMALL
    from tradewinds import queries
    from tradewinds.operators import materialise as written

    for module, name in ((queries, "_contexts"), (written, "_written"), (written, "_losses")):
        monkeypatch.setattr(module, name, {})
    tables = queries.context(spark, SMALL)
    sellers = sorted(tables.silver("sellers").collect())
    assert queries.context(spark, SMALL) is tables
    written._delete(spark, written._written[spark.sparkContext.applicationId][-1])
    assert sorted(queries.context(spark, SMALL).silver("sellers").collect()) == sellers


def test_warehouse_tables_leave_no_shuffle_files(spark, tmp_path):
    """The shuffles of all tables together would fill the disks; items are a projection and not written at all."""
    import glob
    import tempfile
    import time

    from tradewinds.operators import materialise as written
    from tradewinds.plans.warehouse import Warehouse

    def shuffles():
        return set(glob.glob(f"{spark.conf.get('spark.local.dir', tempfile.gettempdir())}/blockmgr-*/*/shuffle_*.data"))

    def folders():
        return len(written._written.get(spark.sparkContext.applicationId, []))

    people = [(f"c{i % 50}", f"p{i % 50}", "00001", f" City {i % 3} ", "SP") for i in range(400)]
    spark.createDataFrame(people, RAW["customers"]).write.parquet(f"{tmp_path}/customers")
    lines = [(f"o{i % 30}", i, "p1", "s1", "2018-01-02 00:00:00", None, None) for i in range(90)]
    spark.createDataFrame(lines, RAW["order_items"]).write.parquet(f"{tmp_path}/items")
    warehouse = Warehouse({
        "customers": spark.read.parquet(f"{tmp_path}/customers"), "order_items": spark.read.parquet(f"{tmp_path}/items"),
    })
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name, None)
    before, tables_before = shuffles(), folders()
    customers = warehouse.silver("customers")
    for _ in range(20):  # files go in the background
        if not shuffles() - before:
            break
        time.sleep(0.5)
    assert not shuffles() - before
    assert spark.conf.get(name, None) == setting
    assert customers.count() == 50 and customers.filter("customer_city = 'city 0'").count() == 50
    assert warehouse.silver("items").filter("shipping_limit_date = timestamp_ntz '2018-01-02 00:00:00'").count() == 90
    assert folders() == tables_before + 1


def test_a_session_without_a_checkpoint_folder_writes_to_its_warehouse(spark, tmp_path):
    """Spark does not let a running session name one: every query that writes a table ended there."""
    import os
    import subprocess
    import sys

    spark.createDataFrame([(1, "All rights reserved.", "en", "a", 20)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/given/documents.parquet")
    (tmp_path / "conf").mkdir()  # without the machine's own settings
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config(map={{"spark.ui.enabled": "false", "spark.sql.warehouse.dir": "{tmp_path}/warehouse", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "2"}}).getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from tradewinds.operators.materialise import materialise, release
from tradewinds.plans.warehouse import Warehouse
from tradewinds.schemas import RAW
from tradewinds.llm.queries import QUERIES
assert materialise(spark.range(9)).count() == 9
shops = spark.createDataFrame([("s1", "00001", " Town ", "SP")], RAW["sellers"])
assert [r["seller_city"] for r in Warehouse({{"sellers": shops}}).silver("sellers").collect()] == ["town"]
assert [r["base_labels"] for r in QUERIES["op4_license_scan"](spark, "{tmp_path}/given").collect()] == ["reserved"]
release(spark)
"""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_GATEWAY_PORT"} | {"SPARK_CONF_DIR": f"{tmp_path}/conf", "PYTHONPATH": here}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert os.listdir(tmp_path / "warehouse" / "checkpoints") == []


def test_on_a_cluster_a_plain_folder_is_tried(spark, monkeypatch, tmp_path):
    """It may be mounted by all machines; one that cannot hold what executors write is left for the warehouse."""
    from tradewinds.operators import materialise as written

    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    monkeypatch.setattr(written, "_tried", {}, raising=False)
    for name in ("_written", "_losses"):
        monkeypatch.setattr(written, name, {})
    named = spark.conf.get("spark.checkpoint.dir")
    assert ":" not in named
    table = written.materialise(spark.range(9))
    assert table.count() == 9 and f"{named}/tradewinds-" in table.inputFiles()[0]
    monkeypatch.setattr(written, "_SETTING", "spark.tradewinds.folder")
    (tmp_path / "taken").write_text("a file, not a folder")
    spark.conf.set("spark.tradewinds.folder", f"{tmp_path}/taken")
    try:
        table = written.materialise(spark.range(9))
        assert table.count() == 9 and "/warehouse" in table.inputFiles()[0]
    finally:
        spark.conf.unset("spark.tradewinds.folder")
