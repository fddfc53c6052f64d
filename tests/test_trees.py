"""The tree learner: both ways of growing, what it learns, and its trees as a table that SQL can score with."""

from __future__ import annotations

from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tradewinds.ml import evaluate, features as ft, score, train, trees

FOREST = trees.Settings(trees=6, depth=4, least_rows=5, boosting=False)
BOOSTED = trees.Settings(trees=45, depth=3, least_rows=5, boosting=True, rate=0.3, row_share=0.8)
CANDIDATES = {
    "forest": FOREST, "boosted": BOOSTED, "second": replace(BOOSTED, second_order=True, l2=1.0, feature_share=0.7),
}
CLASSES = {
    "forest": replace(FOREST, logistic=True, features_a_node=True, feature_share=0.7, weight=(2.0, 1.0)),
    "boosted": replace(BOOSTED, logistic=True), "second": replace(BOOSTED, logistic=True, second_order=True, l2=1.0, weight=(1.0, 0.5)),
}


@pytest.fixture(scope="module")
def data(spark):
    """A target that no line fits: 10 where a and b are on the same side of 0, and c never matters."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(1500, 3)), 2)
    rows = [(i, *map(float, r), float(10 * (r[0] * r[1] > 0) + rng.normal(0, 0.1))) for i, r in enumerate(x)]
    frame = spark.createDataFrame(rows, "id int, a double, b double, c double, label double")
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(frame)
    return ready.repartition(4, "id").sortWithinPartitions("id").cache()


@pytest.fixture(scope="module")
def classes(data):
    return data.withColumn("label", (F.col("label") > 5).cast("int")).cache()


def scored(rows, nodes, name, settings):
    return trees.Ensemble.read(nodes, name, settings).transform(rows)


def test_learns_what_no_line_fits(data, classes):
    nodes = trees.fit(data, 3, CANDIDATES)
    for name, settings in CANDIDATES.items():
        r2 = evaluate.regression_metrics(scored(data, nodes, name, settings)).first()["R2"]
        assert r2 > (0.7 if name == "forest" else 0.95), name
        weights = trees.Ensemble.read(nodes, name, settings).importance(3)
        assert weights.sum() == pytest.approx(1) and weights[2] < 0.1
    nodes = trees.fit(classes, 3, CLASSES)
    for name, settings in CLASSES.items():
        result = scored(classes, nodes, name, settings)
        assert evaluate.classification_metrics(result).first()["accuracy"] > 0.85, name
        assert result.filter("good < 0 or good > 1 or prediction <> int(good > 0.5)").count() == 0


@pytest.mark.parametrize("kind", ["numbers", "classes"])
def test_growing_in_tasks_and_by_passes_is_the_same(data, classes, kind, monkeypatch):
    """More trees than between two refreshes, fewer rows in a block than there are, several trees at a time."""
    monkeypatch.setattr(trees, "_BLOCK_ROWS", 200)
    rows, candidates = (data, CANDIDATES) if kind == "numbers" else (classes, CLASSES)
    here = trees.fit(rows, 3, candidates)
    passes = trees.fit(rows, 3, candidates, local_rows=0)
    order = ["model", "tree", "node"]
    for a, b in zip(here.orderBy(*order).collect(), passes.orderBy(*order).collect(), strict=True):
        assert (a.model, a.tree, a.node, a.feature, a.cut) == (b.model, b.tree, b.node, b.feature, b.cut)
        assert a.value == pytest.approx(b.value, abs=1e-9) and a.base == b.base


def test_sql_scores_with_the_table_of_nodes(data):
    """Predictions follow from the table alone: walk down from node 1 by the cuts, add up the values."""
    nodes = trees.fit(data, 3, CANDIDATES)
    con = duckdb.connect()
    con.register("n", nodes.toArrow())
    con.register("x", data.select("id", vector_to_array("features").alias("x")).toArrow())
    for name, settings in CANDIDATES.items():
        got = {r.id: r.prediction for r in scored(data, nodes, name, settings).select("id", "prediction").collect()}
        total = "any_value(base) + sum(value)" if settings.boosting else "avg(value)"
        expected = con.execute(f"""
            with recursive m as (select * from n where model = '{name}'),
            walk as (
              select id, x, tree, 1 as node from x, (select distinct tree from m)
              union all
              select id, x, w.tree, case when x[feature + 1] > cut then 2 * w.node + 1 else 2 * w.node end
              from walk w join m on m.tree = w.tree and m.node = w.node where feature >= 0
            )
            select id, {total} from walk w join m on m.tree = w.tree and m.node = w.node where feature < 0 group by id""").fetchall()
        assert len(expected) == len(got) and all(got[i] == pytest.approx(p, abs=1e-9) for i, p in expected)


def test_awkward_rows(spark):
    schema = "a double, b double, label double"
    assembler = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    for rows in ([(1.0, 2.0, 3.0)] * 30, [(1.0, 2.0, 3.0)], [(float(i), 0.0, 1.0) for i in range(40)]):
        frame = assembler.transform(spark.createDataFrame(rows, schema))
        nodes = trees.fit(frame, 2, CANDIDATES)
        predicted = scored(frame, nodes, "boosted", BOOSTED).agg(F.min("prediction"), F.max("prediction")).first()
        assert predicted[0] == predicted[1] == pytest.approx(rows[0][2])
    nothing = assembler.transform(spark.createDataFrame([], schema))
    assert trees.fit(nothing, 2, CANDIDATES).count() == 0
    assert scored(nothing, trees.fit(nothing, 2, CANDIDATES), "boosted", BOOSTED).count() == 0


def test_delivery_days_are_learnt(tables):
    """The target follows the month in a way no line does, and noise leaves an R2 of 0.83 at best."""
    results = tables.delivery_model.metrics.first()
    r2 = {name: measures["R2"] for name, measures in results["all_models"].items()}
    assert min(r2[n] for n in train.regressors() if n != "LinearRegression") > 0.7 > 0.5 > r2["LinearRegression"]
    assert tables.delivery_model.importance.first()["feature"] == "order_month"
    delivered = tables.features.filter("order_status = 'delivered' and delivery_days is not null")
    days = score.score_delivery(delivered, tables.delivery_model.model)
    good = days.withColumns({"label": F.col("delivery_days").cast("double"), "prediction": F.col("predicted_days")})
    assert evaluate.regression_metrics(good).first()["R2"] > 0.7
    shuffled = delivered.withColumn("order_month", F.lit(6))
    wrong = score.score_delivery(shuffled, tables.delivery_model.model)
    assert wrong.agg(F.avg(F.abs(F.col("predicted_days") - F.col("delivery_days")))).first()[0] > 5
    assert ft.DELIVERY_FEATURES[13] == "order_month"
