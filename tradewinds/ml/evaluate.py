"""Splits, encodings, medians and metrics, all as DataFrame jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tradewinds.functions import shuffled_key
from tradewinds.operators.ordered import group_medians, positions


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Alphabetical code of every label per column, null counted as 'unknown'."""
    entries = [
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("label"))
        for c in columns
    ]
    labels = df.select(F.inline(F.array(*entries))).distinct()
    # one row per label of a column
    code = F.row_number().over(Window.partitionBy("feature").orderBy("label")) - 1
    return labels.withColumn("code", code)


def feature_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per numeric column; a column without any value has no row."""
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    long = df.select(F.inline(F.array(*entries)))
    return group_medians(long, by=["feature"], value="value")


def _test_rows(classes: DataFrame, test_share: float) -> DataFrame:
    """Test rows per class (columns `_class`, `_n`): the training rows, all rows minus the upper
    rounded test share, go to the classes by largest remainder."""
    everything = Window.partitionBy()  # one row per class
    total = F.sum("_n").over(everything)
    train_rows = total - F.ceil(total * F.lit(test_share))
    shares = classes.select(
        "_class", "_n", train_rows.alias("_train"), (F.col("_n") * train_rows / total).alias("_exact")
    ).withColumn("_whole", F.floor("_exact").cast("bigint"))
    by_remainder = Window.orderBy((F.col("_exact") - F.col("_whole")).desc(), F.col("_class").asc())
    left_over = F.col("_train") - F.sum("_whole").over(everything)
    extra = (F.row_number().over(by_remainder) <= left_over).cast("bigint")
    return shares.select("_class", (F.col("_n") - F.col("_whole") - extra).alias("_test"))


def split(
    df: DataFrame, *, test_share: float = 0.2, seed: int = 42, stratify: str | None = None, key: str = "order_id"
) -> DataFrame:
    """Add `is_test`: exactly the upper rounded share of the rows, in a repeatable random order.

    With `stratify` every class keeps its share. Only ids are sorted, to find the last test row of
    each class; the rows themselves are compared with it where they are.
    """
    label = F.col(stratify).cast("string") if stratify else F.lit("all")
    drawn = df.select(label.alias("_class"), shuffled_key(key, seed).alias("_draw"), F.col(key).alias("_id"))
    placed = positions(drawn, [F.col("_draw").asc(), F.col("_id").asc()], by=["_class"], name="_place")
    classes = drawn.groupBy("_class").agg(F.count(F.lit(1)).alias("_n"))
    sizes = F.broadcast(_test_rows(classes, test_share))
    last = placed.join(sizes, "_class").filter(F.col("_place") == F.col("_test") - 1).select(
        F.col("_class").alias("_of"), F.struct("_draw", "_id").alias("_last")
    )
    row = F.struct(shuffled_key(key, seed).alias("_draw"), F.col(key).alias("_id"))
    marked = df.join(F.broadcast(last), label == F.col("_of"), "left")  # one row per class
    return marked.withColumn("is_test", F.coalesce(row <= F.col("_last"), F.lit(False))).drop("_of", "_last")


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of good and bad rows in percent."""
    good = F.try_divide(F.sum(label).cast("double"), F.count(F.lit(1)).cast("double"))
    return df.agg(good.alias("_good")).select(
        (F.col("_good") * 100).alias("good_pct"), ((1 - F.col("_good")) * 100).alias("bad_pct")
    )


def regression_metrics(predictions: DataFrame) -> DataFrame:
    """One row: MAE, RMSE and R2 of label and prediction."""
    error = F.col("label") - F.col("prediction")
    sums = predictions.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(F.abs(error)).cast("double").alias("absolute"),
        F.sum(error * error).cast("double").alias("squared"),
        F.sum("label").cast("double").alias("total"),
        F.sum(F.col("label") * F.col("label")).cast("double").alias("squares"),
    )
    spread = F.col("squares") - F.col("total") * F.col("total") / F.col("n")
    return sums.filter("n > 0").select(
        F.round(F.col("absolute") / F.col("n"), 3).alias("MAE"),
        F.round(F.sqrt(F.col("squared") / F.col("n")), 3).alias("RMSE"),
        F.round(1 - F.try_divide(F.col("squared"), spread), 4).alias("R2"),
    )


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """One row with the four counts of a two-class prediction."""
    actual, guess = F.col("label").cast("int"), F.col("prediction").cast("int")
    return predictions.agg(*[
        F.count_if((actual == a) & (guess == g)).alias(f"actual_{a}_predicted_{g}") for a in (0, 1) for g in (0, 1)
    ])


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Two rows by actual class, two columns by predicted class, empty cells as 0."""
    counts = confusion_counts(predictions)
    rows = F.array(*[
        F.struct(
            F.lit(a).alias("actual"),
            F.col(f"actual_{a}_predicted_0").alias("predicted_0"),
            F.col(f"actual_{a}_predicted_1").alias("predicted_1"),
        )
        for a in (0, 1)
    ])
    return counts.select(F.inline(rows))


def classification_metrics(predictions: DataFrame) -> DataFrame:
    """One row: accuracy and macro precision, recall and F1; a division by zero counts as 0.

    Only classes that occur among labels or predictions take part in the macro means.
    """
    n = {(a, g): F.col(f"actual_{a}_predicted_{g}").cast("double") for a in (0, 1) for g in (0, 1)}

    def safe(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    precision, recall, f1, used = [], [], [], []
    for c in (0, 1):
        other = 1 - c
        hit, predicted, actual = n[c, c], n[c, c] + n[other, c], n[c, c] + n[c, other]
        precision.append(safe(hit, predicted))
        recall.append(safe(hit, actual))
        f1.append(safe(2 * hit, predicted + actual))
        used.append(F.when(predicted + actual > 0, 1.0).otherwise(0.0))
    classes = used[0] + used[1]
    rows = n[0, 0] + n[0, 1] + n[1, 0] + n[1, 1]
    return confusion_counts(predictions).select(
        F.round(safe(n[0, 0] + n[1, 1], rows), 4).alias("accuracy"),
        F.round(safe(precision[0] + precision[1], classes), 4).alias("precision_macro"),
        F.round(safe(recall[0] + recall[1], classes), 4).alias("recall_macro"),
        F.round(safe(f1[0] + f1[1], classes), 4).alias("f1_macro"),
    )
