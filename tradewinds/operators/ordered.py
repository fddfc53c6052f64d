"""Order-dependent results over whole tables or over groups of any size.

A window without a partition key, or with one hot key, sends every row of it to a single task.
Here the rows are range-sorted instead, so a hot group is cut across as many slices as it needs.
The sorted rows are written once with their slice and place; only one small row per slice is then
needed to carry a running total from slice to slice. All results are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tradewinds.operators.materialise import materialise

_PLACE_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def _slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Written copy of the frame in the given total order, or the one it has, with slice number and place in it."""
    row = F.monotonically_increasing_id()
    tagged = (df.orderBy(*order) if order else df).withColumn("_row", row)
    return materialise(
        tagged.withColumn("_slice", F.shiftright("_row", _PLACE_BITS))
        .withColumn("_at", F.col("_row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
        .drop("_row")
    )


def _key(by: Sequence[str]) -> list[Column]:
    """Slice and group of a small side, renamed for the join."""
    return [F.col("_slice").alias("_in_slice"), *[F.col(c).alias(f"_in_{c}") for c in by]]


def _same_group(by: Sequence[str]) -> Column:
    equal = [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in by]
    return reduce(lambda a, b: a & b, equal, F.col("_slice") == F.col("_in_slice"))


def running_totals(
    df: DataFrame,
    *,
    by: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column],
    totals: bool = False,
) -> DataFrame:
    """Add `<name>_before` for each sum: the earlier rows of the group in the given order, added up.

    `totals` adds `<name>_total` over the whole group as well. `order` must be a total order inside
    each group.
    """
    valued = df.select("*", *[value.alias(name) for name, value in sums.items()])
    rows = _slices(valued, [*[F.col(c).asc_nulls_first() for c in by], *order])

    inside = Window.partitionBy("_slice", *by)
    earlier = inside.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(
        "*",
        *[F.sum(name).over(earlier).alias(f"{name}_before") for name in sums],
        *[F.sum(name).over(inside).alias(f"{name}_total") for name in sums if totals],
    )

    # One row per slice and group. Only groups cut by a slice border need a carry, and each border
    # cuts one group, so the broadcast side holds at most two rows per slice.
    pieces = rows.groupBy("_slice", *by).agg(*[F.sum(name).alias(name) for name in sums])
    group = Window.partitionBy(*by)
    previous = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = pieces.select(
        *_key(by),
        F.count(F.lit(1)).over(group).alias("_pieces"),
        *[F.sum(name).over(previous).alias(f"{name}_carry") for name in sums],
        *[F.sum(name).over(group).alias(f"{name}_whole") for name in sums],
    ).filter("_pieces > 1")
    joined = local.join(F.broadcast(cut), _same_group(by), "left")

    def or_zero(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    results = []
    for name in sums:
        before = or_zero(f"{name}_before") + or_zero(f"{name}_carry")
        results.append(before.alias(f"{name}_before"))
        if totals:
            total = F.coalesce(f"{name}_whole", f"{name}_total", F.lit(0))
            results.append(total.alias(f"{name}_total"))
    return joined.select(*df.columns, *results)


def positions(
    df: DataFrame, order: Sequence[Column], *, by: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Add the zero-based place of every row in a total order, and `<name>_count`, the rows there are.

    `by` numbers the rows of a few groups separately (scores, classes): the broadcast side has one
    row per slice plus one per group. Rows are sorted once and not shuffled again.
    """
    rows = _slices(df, [*[F.col(c).asc_nulls_first() for c in by], *order])
    pieces = rows.groupBy("_slice", *by).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    # one row per slice and group, so even a window without a key is small
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        *_key(by), "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(group).alias("_count"),
    )
    placed = rows.join(F.broadcast(starts), _same_group(by))
    place = F.col("_start") + F.col("_at") - F.col("_first")
    return placed.select(*df.columns, place.alias(name), F.col("_count").alias(f"{name}_count"))


def places(df: DataFrame, *, name: str = "place") -> DataFrame:
    """Number the rows, from 0, in the order the frame has: that of a report that ends in a sort."""
    return positions(df, [], name=name).drop(f"{name}_count")


def _common_type(df: DataFrame) -> T.DataType:
    """Type that holds the values of all columns unchanged; the cast fails on more than 38 digits."""
    types = [field.dataType for field in df.schema]
    if all(isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) for t in types):
        return T.DoubleType()
    if not all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        raise ValueError(f"no exact common type of {[t.simpleString() for t in types]}")
    return T.DecimalType(38, max((t.scale for t in types if isinstance(t, T.DecimalType)), default=0))


def with_ntiles(df: DataFrame, tiles: int, scores: Mapping[str, Column], *, tie_break: str) -> DataFrame:
    """Add NTILE(tiles) columns over the whole frame, each ascending in its value, then in the id.

    Tiles differ by at most one row. Every score needs only its `tiles - 1` border rows, so one
    sort of narrow rows finds the borders of all scores and the frame itself is never sorted.
    The frame is read twice: pass a written one. Values are integers and decimals, or all floating.
    """
    frame = df
    id_type = frame.schema[tie_break].dataType
    common = _common_type(frame.select(*[value.alias(name) for name, value in scores.items()]))
    entries = [
        F.struct(F.lit(name).alias("score"), value.cast(common).alias("value"), F.col(tie_break).alias("id"))
        for name, value in scores.items()
    ]
    narrow = frame.select(F.inline(F.array(*entries)))
    placed = positions(
        narrow, [F.col("value").asc_nulls_first(), F.col("id").asc_nulls_first()], by=["score"], name="row"
    )
    # tile j ends before row j * (n div k) + min(j, n mod k)
    size = F.floor(F.col("row_count") / tiles).cast("bigint")
    spare = F.col("row_count") % tiles
    ends = [F.lit(j) * size + F.least(F.lit(j), spare) for j in range(1, tiles)]
    is_last = reduce(lambda a, b: a | b, [F.col("row") == end - 1 for end in ends])
    borders = placed.filter(is_last).select("score", "value", "id").collect()  # tiles - 1 rows a score

    for name, value in scores.items():
        row = F.struct(value.cast(common).alias("value"), F.col(tie_break).alias("id"))
        tile = F.lit(1)
        for border in borders:
            if border["score"] == name:
                last = F.struct(
                    F.lit(border["value"]).cast(common).alias("value"),
                    F.lit(border["id"]).cast(id_type).alias("id"),
                )
                tile = tile + F.when(row > last, 1).otherwise(0)
        frame = frame.withColumn(name, tile)
    return frame


def value_ranks(df: DataFrame, metrics: Sequence[str], *, descending: bool) -> DataFrame:
    """Ranks of every distinct value of each metric (integers and decimals, or all floating).

    One row per metric and value: `rank`, `dense_rank`, `mean_rank_pct` (ties share the mean of
    their places, divided by the number of non-null rows). Descending order puts nulls first and
    ascending order puts them last.
    """
    common = _common_type(df.select(*metrics))
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).cast(common).alias("value")) for m in metrics]
    counts = df.select(F.inline(F.array(*entries))).groupBy("metric", "value").agg(
        F.count(F.lit(1)).alias("peers")
    )
    value = F.col("value")
    placed = running_totals(
        counts,
        by=["metric"],
        order=[value.desc_nulls_first() if descending else value.asc_nulls_last()],
        sums={
            "rows": F.col("peers"),
            "values": F.lit(1).cast("bigint"),
            "present": F.when(value.isNotNull(), F.col("peers")).otherwise(0).cast("bigint"),
        },
        totals=True,
    )
    middle = F.col("present_before") + (F.col("peers") + 1) / 2
    return materialise(
        placed.select(
            "metric",
            "value",
            (F.col("rows_before") + 1).alias("rank"),
            (F.col("values_before") + 1).alias("dense_rank"),
            F.when(value.isNotNull(), middle / F.col("present_total")).alias("mean_rank_pct"),
        )
    )


def rank_borders(ranks: DataFrame, shares: Sequence[float]) -> dict[str, list]:
    """Per metric, the greatest value whose mean rank is within each share of the rows; None if there is none."""
    within = [F.max(F.when(F.col("mean_rank_pct") <= share, F.col("value"))) for share in shares]
    return {row[0]: list(row[1:]) for row in ranks.groupBy("metric").agg(*within).collect()}  # one row a metric


def join_ranks(df: DataFrame, ranks: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Attach rank columns: new name -> (metric, kind of rank)."""
    for name, (metric, kind) in columns.items():
        side = ranks.filter(F.col("metric") == metric).select(
            F.col("value").alias("_value"), F.col(kind).alias(name)
        )
        matched = F.col(metric).cast(ranks.schema["value"].dataType).eqNullSafe(F.col("_value"))
        df = df.join(side, matched, "left").drop("_value")
    return df


def group_medians(df: DataFrame, *, by: Sequence[str], value: str) -> DataFrame:
    """Exact median of the non-null values per group, the mean of the two middle ones if even."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("peers"))
    placed = running_totals(
        counts, by=by, order=[F.col(value).asc()], sums={"rows": F.col("peers")}, totals=True
    )
    low = F.floor((F.col("rows_total") - 1) / 2).cast("bigint")
    high = F.floor(F.col("rows_total") / 2).cast("bigint")
    first, after = F.col("rows_before"), F.col("rows_before") + F.col("peers")
    middle = placed.filter((first <= high) & (after > low))
    # at most two distinct values are left in a group
    return middle.groupBy(*by).agg(((F.min(value) + F.max(value)) / 2).alias("median"))
