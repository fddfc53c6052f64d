"""Deduplication, top-k, shares, histograms and calendars."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in a total order.

    Spark turns `row_number = 1` into a group limit on both sides of the shuffle, so a key with
    very many copies sends one row per map task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def all_columns_ascending(df: DataFrame, *, skip: Sequence[str] = ()) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in df.columns if c not in skip]


def top_k(df: DataFrame, metric: str, k: int, *, tie_break: str, descending: bool = True) -> DataFrame:
    """The k rows with the greatest (or least) metric, nulls last."""
    column = F.col(metric)
    order = column.desc_nulls_last() if descending else column.asc_nulls_last()
    return df.orderBy(order, F.col(tie_break).asc()).limit(k)


def keep_listed(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose value occurs in a top-k list of the same column."""
    return df.join(F.broadcast(listed.select(column)), column, "left_semi")


def sample_rows(df: DataFrame, size: int, *, key: Column) -> DataFrame:
    """At most `size` rows in a repeatable pseudo-random order."""
    return df.orderBy(key).limit(size)


def value_counts(df: DataFrame, column: str, *, count: str = "count") -> DataFrame:
    """Rows per non-null value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count))


def histogram(df: DataFrame, column: str, *, bins: int) -> DataFrame:
    """Rows per equal-width bin between the least and the greatest value; empty bins left out."""
    values = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()  # one scan
    low, high = ends["low"], ends["high"]
    width = F.when(high > low, (high - low) / bins).otherwise(F.lit(1.0))
    place = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
    binned = values.select(place.alias("bin"), low.alias("_low"), width.alias("_width"))
    start = F.first("_low") + F.col("bin") * F.first("_width")
    return binned.groupBy("bin").agg(start.alias("bin_start"), F.count(F.lit(1)).alias("count"))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per calendar day, end excluded."""
    last = end - dt.timedelta(days=1)
    days = F.sequence(F.lit(start), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


# name -> (unit of date_trunc, step of the calendar)
_PERIODS = {"month": "interval 1 month", "week": "interval 7 day", "quarter": "interval 3 month"}


def _period_start(column: str, freq: str) -> Column:
    return F.trunc(F.col(column).cast("date"), freq)


def _period_end(start: Column, freq: str) -> Column:
    if freq == "week":  # Monday to Sunday
        return F.date_add(start, 6)
    return F.last_day(F.add_months(start, 2)) if freq == "quarter" else F.last_day(start)


def orders_per_period(df: DataFrame, timestamp: str, counted: str, *, freq: str = "month") -> DataFrame:
    """Non-null `counted` per period between the first and the last one, empty periods as zero.

    The label is the last day of the period.
    """
    counts = (
        df.filter(F.col(timestamp).isNotNull())
        .groupBy(_period_start(timestamp, freq).alias("start"))
        .agg(F.count(counted).alias("orders"))
    )
    ends = counts.agg(F.min("start").alias("first"), F.max("start").alias("last"))
    steps = F.sequence("first", "last", F.expr(_PERIODS[freq]))
    calendar = ends.filter("first is not null").select(F.explode(steps).alias("start"))
    return calendar.join(counts, "start", "left").select(
        _period_end(F.col("start"), freq).alias("date"),
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
    )
