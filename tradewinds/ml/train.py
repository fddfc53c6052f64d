"""Candidate models, their choice, refit, importance and metrics: linear ones of MLlib, trees of `trees`."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from uuid import uuid4

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradewinds.ml import evaluate, features as ft
from tradewinds.ml.trees import Ensemble, Settings, fit as fit_trees
from tradewinds.operators.materialise import materialise, run_folder

SEED = 42
_ROWS_A_PART = 50_000

METRICS = T.StructType([
    T.StructField("best_model", T.StringType()),
    T.StructField("all_models", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))),
    T.StructField("best_metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("class_labels", T.ArrayType(T.StringType())),
    T.StructField("train_samples", T.LongType()),
    T.StructField("test_samples", T.LongType()),
    T.StructField("target", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())),
])

IMPORTANCE = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("importance", T.DoubleType()),
])


@dataclass(frozen=True)
class Task:
    features: Sequence[str]
    labels: Sequence[str]
    target: str
    score: str
    greater_is_better: bool


DELIVERY = Task(ft.DELIVERY_FEATURES, ft.DELIVERY_LABELS, ft.DELIVERY_TARGET, "RMSE", False)
REVIEW = Task(ft.REVIEW_FEATURES, ft.REVIEW_LABELS, ft.REVIEW_TARGET, "f1_macro", True)


@dataclass(frozen=True)
class Model:
    """What prepares rows and what predicts from their features; `nodes` holds the trees as a table."""

    stages: PipelineModel
    last: object
    nodes: DataFrame | None
    name: str

    def transform(self, df: DataFrame) -> DataFrame:
        return predict(self.last, self.stages.transform(df))


@dataclass(frozen=True)
class Trained:
    model: Model
    metrics: DataFrame
    importance: DataFrame
    confusion: DataFrame | None


def regressors(*, trees: int = 200, rounds: int = 300) -> dict[str, object]:
    """Linear, forest and two boosted candidates; the second is of second order and samples features too."""
    boosted = Settings(trees=rounds, depth=5, least_rows=10, boosting=True, rate=0.05, row_share=0.8, seed=SEED)
    return {
        "LinearRegression": LinearRegression(),
        "RandomForestRegressor": Settings(trees=trees, depth=12, least_rows=5, boosting=False, seed=SEED),
        "GradientBoostingRegressor": boosted,
        "FeatureSampledBoostingRegressor": replace(boosted, least_rows=5, second_order=True, l2=1.0, feature_share=0.8),
    }


def classifiers(*, trees: int = 200, rounds: int = 300) -> dict[str, object]:
    """Balanced logistic and forest, plain boosting, second-order boosting with weighted positives."""
    boosted = Settings(trees=rounds, depth=4, least_rows=10, boosting=True, logistic=True, rate=0.05, row_share=0.8, seed=SEED)
    return {
        "LogisticRegression": LogisticRegression(maxIter=1000, weightCol="balanced"),
        "RandomForestClassifier": Settings(
            trees=trees, depth=12, least_rows=5, boosting=False, logistic=True, features_a_node=True,
            feature_share=len(REVIEW.features) ** -0.5, weight="balanced", seed=SEED,
        ),
        "GradientBoostingClassifier": boosted,
        "WeightedBoostingClassifier": replace(
            boosted, least_rows=5, second_order=True, l2=1.0, feature_share=0.8, weight="positives"
        ),
    }


def with_class_weights(df: DataFrame) -> DataFrame:
    """`balanced` = rows / (2 * rows of the class); `positives` = negatives / positives for class 1."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("good")
    ).select("n", "good", (F.col("n") - F.col("good")).alias("bad"))
    size = counts.select(F.struct("n", "good", "bad")).scalar()
    of_class = F.when(F.col("label") == 1, size["good"]).otherwise(size["bad"])
    ratio = size["bad"].cast("double") / F.greatest(size["good"], F.lit(1))
    return df.withColumns({
        "balanced": size["n"].cast("double") / (2 * of_class),
        "positives": F.when(F.col("label") == 1, ratio).otherwise(F.lit(1.0)),
    })


def preparation(train: DataFrame, task: Task) -> tuple[list, list[str]]:
    """Stages learnt from the training rows, and the features that go into the model.

    Missing labels become 'unknown', missing numbers the training median. A numeric feature
    without a single value is left out by name.
    """
    numeric = [f for f in task.features if f not in task.labels]
    rows = evaluate.feature_medians(train, numeric).collect()  # one row per feature
    medians = {r["feature"]: r["median"] for r in rows}
    used = [f for f in task.features if f in task.labels or f in medians]
    filled = [
        f"coalesce({f}, 'unknown') AS {f}_filled" if f in task.labels
        else f"coalesce(CAST({f} AS DOUBLE), {medians[f]!r}D) AS {f}_filled"
        for f in used
    ]
    indexed = [f"{f}_code" if f in task.labels else f"{f}_filled" for f in used]
    stages = [
        SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__"),
        StringIndexer(
            inputCols=[f"{f}_filled" for f in task.labels], outputCols=[f"{f}_code" for f in task.labels],
            stringOrderType="alphabetAsc", handleInvalid="keep",
        ),
        VectorAssembler(inputCols=indexed, outputCol="features"),
    ]
    return stages, used


def feature_importance(spark: SparkSession, last: object, used: Sequence[str]) -> DataFrame:
    """Importance per feature name: gains of the trees, or absolute coefficients made to add up to 1."""
    if isinstance(last, Ensemble):
        weights = last.importance(len(used))
    else:
        size = np.abs(last.coefficients.toArray())
        weights = size / (size.sum() + 1e-9)
    rows = [(name, float(weight)) for name, weight in zip(used, weights, strict=True)]
    return spark.createDataFrame(rows, IMPORTANCE).orderBy(F.col("importance").desc(), "feature")


def predict(last: object, ready: DataFrame) -> DataFrame:
    """Add `prediction`, and for classes `good`, the probability of class 1."""
    scored = last.transform(ready)
    if "probability" in scored.columns:
        return scored.withColumn("good", vector_to_array("probability")[1]).drop("probability", "rawPrediction")
    return scored


def _fit_linear(estimator, prepared: DataFrame):
    """Fitted model. One that holds a training summary is saved and read back: the summary refers to
    the session, which executors cannot be sent."""
    model = estimator.fit(prepared)
    if not getattr(model, "hasSummary", False):
        return model
    path = f"{run_folder(prepared.sparkSession)}/model-{uuid4().hex}"
    model.write().save(path)
    return type(model).load(path)


def _class_weights(rows: DataFrame) -> dict[str, tuple[float, float]]:
    """Weights of classes 0 and 1 under each name, 1 for a class without rows."""
    names = [c for c in ("balanced", "positives") if c in rows.columns]
    of_class = {r["label"]: r for r in rows.groupBy("label").agg(*[F.max(c).alias(c) for c in names]).collect()} if names else {}
    return {name: tuple(of_class[c][name] if c in of_class else 1.0 for c in (0, 1)) for name in names}


@dataclass(frozen=True)
class Prepared:
    """Rows made ready once for all candidates, and what made them."""

    stages: PipelineModel
    used: list[str]
    rows: DataFrame

    def rest(self, df: DataFrame) -> DataFrame:
        return materialise(self.stages.transform(df))

    def fit(self, candidates: dict[str, object]) -> tuple[dict[str, object], DataFrame | None]:
        """Fitted models by name and the table of nodes of those made of trees, which are fitted together."""
        weights = _class_weights(self.rows)
        of_trees = {
            name: replace(c, weight=weights[c.weight]) if c.weight else c for name, c in candidates.items() if isinstance(c, Settings)
        }
        nodes = fit_trees(self.rows, len(self.used), of_trees) if of_trees else None
        models = {name: Ensemble.read(nodes, name, settings) for name, settings in of_trees.items()}
        for name, estimator in candidates.items():
            if name not in models:
                models[name] = _fit_linear(estimator, self.rows)
        return models, nodes


def prepare(df: DataFrame, task: Task) -> Prepared:
    stages, used = preparation(df, task)
    fitted = Pipeline(stages=stages).fit(df)
    weights = [c for c in ("balanced", "positives") if c in df.columns]
    ready = fitted.transform(df).select("label", "features", *weights)
    parts = max(1, -(-df.count() // _ROWS_A_PART))
    return Prepared(fitted, used, materialise(ready.repartition(parts)))


def evaluate_candidates(
    train: DataFrame, test: DataFrame, task: Task, candidates: dict[str, object]
) -> tuple[dict[str, object], dict[str, dict[str, float]], DataFrame]:
    """Fit every candidate on the training rows and measure it on the others, which come back ready."""
    measure = evaluate.classification_metrics if task.greater_is_better else evaluate.regression_metrics
    prepared = prepare(train, task)
    rest = prepared.rest(test)
    fitted, _ = prepared.fit(candidates)
    results = {name: measure(predict(fitted[name], rest)).first().asDict() for name in candidates}  # one row of metrics each
    return fitted, results, rest


def best_candidate(results: dict[str, dict[str, float]], task: Task) -> str:
    choose = max if task.greater_is_better else min
    return choose(results, key=lambda name: results[name][task.score])


def train(df: DataFrame, *, task: Task, candidates: dict[str, object]) -> Trained:
    """Measure the candidates on a held-out fifth, then fit the best one anew on all rows."""
    spark = df.sparkSession
    stratify = "label" if task.greater_is_better else None
    marked = materialise(evaluate.split(df, seed=SEED, stratify=stratify))
    train_rows, test_rows = marked.filter("not is_test"), marked.filter("is_test")
    if task.greater_is_better:
        train_rows, test_rows = with_class_weights(train_rows), test_rows
    fitted, results, rest = evaluate_candidates(train_rows, test_rows, task, candidates)
    best = best_candidate(results, task)
    confusion = evaluate.confusion_matrix(predict(fitted[best], rest)) if task.greater_is_better else None

    everything = with_class_weights(marked) if task.greater_is_better else marked
    prepared = prepare(everything, task)
    models, nodes = prepared.fit({best: candidates[best]})
    final = Model(prepared.stages, models[best], nodes, best)

    sizes = marked.agg(F.count_if(~F.col("is_test")).alias("a"), F.count_if("is_test").alias("b")).first()
    cells = [[r["predicted_0"], r["predicted_1"]] for r in confusion.orderBy("actual").collect()] if confusion else None
    row = (
        best, results, results[best], cells, ["bad (< 4)", "good (>= 4)"] if confusion else None,
        sizes["a"], sizes["b"], task.target, list(task.features),
    )
    metrics = spark.createDataFrame([row], METRICS)
    return Trained(final, metrics, feature_importance(spark, final.last, prepared.used), confusion)


def train_delivery(features: DataFrame, *, trees: int = 200, rounds: int = 300) -> Trained:
    return train(ft.delivery_training(features), task=DELIVERY, candidates=regressors(trees=trees, rounds=rounds))


def train_review(features: DataFrame, *, trees: int = 200, rounds: int = 300) -> Trained:
    return train(ft.review_training(features), task=REVIEW, candidates=classifiers(trees=trees, rounds=rounds))
