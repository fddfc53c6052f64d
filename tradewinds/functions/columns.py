"""Scalar expressions. All are native Columns, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tradewinds.schemas import STATES

# Fixed value: what stands for a null inside a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def parse_timestamp(column: str) -> Column:
    """Text to timestamp without zone; malformed text becomes null."""
    return F.col(column).try_cast("timestamp_ntz")


def clean_text(column: str) -> Column:
    return F.lower(F.trim(F.col(column)))


def day_gap(end: str, start: str) -> Column:
    """Calendar days from start to end, null when either is null."""
    return F.date_diff(F.col(end), F.col(start))


def surrogate_key(*columns: str) -> Column:
    """MD5 of the key columns as text, joined by '-', with a fixed marker for nulls."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def date_key(column: str) -> Column:
    return F.date_format(F.col(column), "yyyyMMdd").cast("int")


def _state_lookup(column: str, position: int) -> Column:
    pairs = [F.lit(text) for code, entry in STATES.items() for text in (code, entry[position])]
    return F.create_map(*pairs)[F.col(column)]


def state_name(column: str) -> Column:
    return _state_lookup(column, 0)


def state_region(column: str, default: str | None = "Unknown") -> Column:
    """Macro-region of a state code; `default=None` leaves unknown codes null."""
    region = _state_lookup(column, 1)
    return region if default is None else F.coalesce(region, F.lit(default))


def installments_bucket(column: str) -> Column:
    n = F.col(column)
    return (
        F.when(n == 1, "1 (cash)")
        .when(n.between(2, 3), "2-3")
        .when(n.between(4, 6), "4-6")
        .when(n.between(7, 12), "7-12")
        .when(n > 12, "12+")
        .otherwise("unknown")
    )


def month_label(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM")


def quarter_label(column: str) -> Column:
    return F.concat(F.year(column).cast("string"), F.lit("-Q"), F.quarter(column).cast("string"))


def month_start(column: str) -> Column:
    return F.trunc(F.col(column).cast("date"), "month")


def months_apart(later: str, earlier: str) -> Column:
    """Month boundaries crossed between two dates (31 January to 1 February is one)."""
    later_index = F.year(later) * 12 + F.month(later)
    return later_index - (F.year(earlier) * 12 + F.month(earlier))


def ratio(part: Column, whole: Column, places: int | None = None, *, half_even: bool = False) -> Column:
    """Exact decimal division, rounded once; null when `whole` is zero or null.

    Sums arrive here as exact decimals or integers, so the result does not depend on the order
    in which partitions were added up. Reports written in SQL round half up, the dashboard and
    the features round half to even.
    """
    quotient = F.try_divide(part.cast("decimal(24,2)"), whole.cast("decimal(14,0)"))
    if places is None:
        return quotient
    return F.bround(quotient, places) if half_even else F.round(quotient, places)


def share_pct(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole for two amounts with at most two decimals."""
    quotient = F.try_divide((part * 100).cast("decimal(26,2)"), whole.cast("decimal(24,2)"))
    return F.round(quotient, places)


def mean(column: str, places: int | None = None, *, half_even: bool = False) -> Column:
    """Exact mean of the non-null values of an integer or two-decimal column."""
    return ratio(F.sum(column), F.count(column), places, half_even=half_even)


def plain_mean(column: str) -> Column:
    """Unrounded mean as one double division of an exact sum by a count."""
    total = F.sum(column).cast("double")
    return F.try_divide(total, F.count(column).cast("double"))


def freight_ratio(freight: str, price: str) -> Column:
    """Freight as a share of price plus freight, four decimals, null when the order cost nothing."""
    cost = F.col(price) + F.col(freight)
    quotient = F.try_divide(F.col(freight).cast("decimal(24,2)"), cost.cast("decimal(24,2)"))
    return F.bround(quotient, 4)


def freight_ratio_or_zero(freight: str, price: str) -> Column:
    """Scoring-time form: 0 instead of null for an order that cost nothing."""
    cost = F.col(price) + F.col(freight)
    quotient = F.try_divide(F.col(freight).cast("double"), cost.cast("double"))
    return F.when(cost > 0, quotient).otherwise(F.lit(0.0))


def comment_length(message: str, title: str) -> Column:
    return F.length(F.coalesce(F.col(message), F.lit(""))) + F.length(F.coalesce(F.col(title), F.lit("")))


def flag_to_int(column: str) -> Column:
    """True/False as boolean or text to 1/0, anything else to 0."""
    return F.when(F.lower(F.col(column).cast("string")) == "true", 1).otherwise(0)


def is_good_review(score: str) -> Column:
    return F.coalesce(F.col(score) >= 4, F.lit(False)).cast("int")


def late_label(column: str) -> Column:
    return (
        F.when(F.col(column), "Late").when(~F.col(column), "On Time").otherwise("Unknown")
    )


def short_id(column: str, length: int) -> Column:
    return F.concat(F.substring(column, 1, length), F.lit("…"))


def haversine_km(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    """Great-circle distance in km on a sphere of radius 6371, null if a coordinate is missing."""
    north = F.radians(F.col(lat2)) - F.radians(F.col(lat1))
    east = F.radians(F.col(lng2)) - F.radians(F.col(lng1))
    chord = (
        F.pow(F.sin(north / 2), F.lit(2.0))
        + F.cos(F.radians(F.col(lat1))) * F.cos(F.radians(F.col(lat2))) * F.pow(F.sin(east / 2), F.lit(2.0))
    )
    # greatest/least skip nulls, so the null case is spelt out.
    clipped = F.when(chord.isNotNull(), F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0)))
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(clipped))


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first rule that holds."""
    (condition, label), *rest = rules
    chain = F.when(condition, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain.otherwise(otherwise)


def shuffled_key(column: str, seed: int) -> Column:
    """Repeatable pseudo-random order of rows by id."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(column)))
