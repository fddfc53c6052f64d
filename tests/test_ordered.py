"""Order-dependent operators against brute force, with one key holding a third of the rows."""

from __future__ import annotations

import random
from statistics import median

import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from tradewinds.ml import evaluate
from tradewinds.operators.ordered import (
    group_medians, join_ranks, positions, running_totals, value_ranks, with_ntiles,
)


def skewed_rows(n=2000, seed=1):
    """(id, group, at, value): group 'hot' has a third of all rows, one is null, times tie."""
    draw = random.Random(seed)
    groups = ["hot"] * 20 + [f"g{i}" for i in range(38)] + [None, "lone"]
    return [
        (f"i{i:05d}", draw.choice(groups), draw.randrange(50), draw.choice([None, 1, 2, 3, 5, 8, 13]))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def rows():
    return skewed_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, grp string, at int, value int").repartition(8)


def test_running_totals_match_plain_loop(frame, rows):
    result = running_totals(
        frame, by=["grp"], order=[F.col("at").asc(), F.col("id").asc()],
        sums={"v": F.col("value").cast("bigint"), "n": F.lit(1).cast("bigint")},
        totals=True,
    ).collect()
    seen, totals, expected = {}, {}, {}
    for _id, grp, _at, value in rows:
        v, n = totals.get(grp, (0, 0))
        totals[grp] = (v + (value or 0), n + 1)
    for id_, grp, _at, value in sorted(rows, key=lambda r: (r[2], r[0])):
        v, n = seen.get(grp, (0, 0))
        expected[id_] = (v, n, *totals[grp])
        seen[grp] = (v + (value or 0), n + 1)
    assert len(result) == len(rows)
    assert {r["id"]: (r["v_before"], r["n_before"], r["v_total"], r["n_total"]) for r in result} == expected


def test_hot_group_is_cut_into_slices(frame):
    from tradewinds.operators.ordered import _slices

    sliced = _slices(frame, [F.col("grp").asc(), F.col("at").asc(), F.col("id").asc()])
    assert sliced.filter("grp = 'hot'").select("_slice").distinct().count() > 1
    largest = sliced.groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert largest < 2000 / 3


def test_running_totals_over_the_whole_frame(frame, rows):
    result = running_totals(
        frame, by=[], order=[F.col("id").asc()], sums={"n": F.lit(1).cast("bigint")}, totals=True
    ).collect()
    assert {r["id"]: (r["n_before"], r["n_total"]) for r in result} == {
        r[0]: (i, len(rows)) for i, r in enumerate(sorted(rows))
    }


def test_positions(frame, rows):
    placed = positions(frame, [F.col("at").desc(), F.col("id").asc()]).collect()
    expected = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    assert {r["id"]: r["position"] for r in placed} == expected


def test_positions_by_group(frame, rows):
    placed = positions(frame, [F.col("at").desc(), F.col("id").asc()], by=["grp"]).collect()
    groups = {}
    for r in sorted(rows, key=lambda r: (-r[2], r[0])):
        groups.setdefault(r[1], []).append(r[0])
    expected = {id_: (i, len(ids)) for ids in groups.values() for i, id_ in enumerate(ids)}
    assert {r["id"]: (r["position"], r["position_count"]) for r in placed} == expected


@pytest.mark.parametrize("tiles", [4, 5, 7])
def test_ntiles_match_plain_window(frame, tiles):
    scored = with_ntiles(frame, tiles, {"a": -F.col("at"), "b": F.col("value")}, tie_break="id")
    plain = frame.select(
        "id",
        F.ntile(tiles).over(Window.orderBy(F.col("at").desc(), "id")).alias("a"),
        F.ntile(tiles).over(Window.orderBy(F.col("value").asc_nulls_first(), "id")).alias("b"),
    )
    assert sorted(scored.select("id", "a", "b").collect()) == sorted(plain.collect())


def test_ntiles_with_fewer_rows_than_tiles(spark):
    few = spark.createDataFrame([("a", 3), ("b", 1), ("c", 1)], "id string, value int")
    scored = with_ntiles(few, 5, {"t": F.col("value")}, tie_break="id").collect()
    assert {r["id"]: r["t"] for r in scored} == {"b": 1, "c": 2, "a": 3}


def test_ntiles_with_equal_values_and_a_null_id(spark):
    same = spark.createDataFrame([(None if i == 0 else f"{i:02d}", 1) for i in range(11)], "id string, value int")
    scored = with_ntiles(same, 5, {"t": F.col("value")}, tie_break="id")
    sizes = [r["count"] for r in scored.groupBy("t").count().orderBy("t").collect()]
    assert sizes == [3, 2, 2, 2, 2]


def test_ranks_match_plain_window(frame):
    ranks = value_ranks(frame, ["value", "at"], descending=True)
    ranked = join_ranks(frame, ranks, {
        "r": ("value", "rank"), "d": ("value", "dense_rank"), "a": ("at", "rank"),
    }).select("id", "r", "d", "a")
    down = Window.orderBy(F.col("value").desc_nulls_first())
    plain = frame.select(
        "id", F.rank().over(down).alias("r"), F.dense_rank().over(down).alias("d"),
        F.rank().over(Window.orderBy(F.col("at").desc())).alias("a"),
    )
    assert sorted(ranked.collect()) == sorted(plain.collect())


def test_mean_rank_equals_pandas(frame, rows):
    ranks = value_ranks(frame, ["value"], descending=False)
    got = {r["id"]: r["p"] for r in join_ranks(frame, ranks, {"p": ("value", "mean_rank_pct")}).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "grp", "at", "value"]).set_index("id")
    expected = pdf["value"].rank(pct=True, method="average")
    for id_, pct in expected.items():
        assert (got[id_] is None) if pd.isna(pct) else got[id_] == pytest.approx(pct, abs=1e-12)


def test_medians_match_statistics(frame, rows):
    got = {r["grp"]: r["median"] for r in group_medians(frame, by=["grp"], value="value").collect()}
    values = {}
    for _id, grp, _at, value in rows:
        if value is not None:
            values.setdefault(grp, []).append(value)
    assert got == {grp: median(v) for grp, v in values.items()}


def test_all_null_column_has_no_median(spark):
    empty = spark.createDataFrame([("a", None, 1.0), ("b", None, 4.0)], "order_id string, x double, y double")
    assert [tuple(r) for r in evaluate.feature_medians(empty, ["x", "y"]).collect()] == [("y", 2.5)]


def test_split_sizes_and_repeatability(frame):
    first = evaluate.split(frame, key="id").cache()
    assert first.filter("is_test").count() == 400  # the upper rounded fifth of 2000
    again = evaluate.split(frame.repartition(3), key="id")
    assert sorted(first.collect()) == sorted(again.collect())


def test_stratified_split_keeps_shares(spark):
    rows = [(f"r{i}", 1 if i % 3 else 0) for i in range(101)]
    df = spark.createDataFrame(rows, "order_id string, label int")
    got = evaluate.split(df, stratify="label").groupBy("label", "is_test").count().collect()
    sizes = {(r["label"], r["is_test"]): r["count"] for r in got}
    # 101 rows: 21 test and 80 training rows; 34 * 80 / 101 = 26.93 and 67 * 80 / 101 = 53.07
    assert sizes == {(0, False): 27, (0, True): 7, (1, False): 53, (1, True): 14}


def test_finer_values_are_not_rounded(spark):
    fine = spark.createDataFrame([("a", "0.004"), ("b", "0.003"), ("c", "0.002"), ("d", "0.001")], "id string, x string")
    fine = fine.withColumn("value", F.col("x").cast("decimal(10,3)"))
    tiles = {r["id"]: r["t"] for r in with_ntiles(fine, 2, {"t": F.col("value")}, tie_break="id").collect()}
    assert tiles == {"a": 2, "b": 2, "c": 1, "d": 1}
    ranks = value_ranks(fine, ["value"], descending=False)
    got = {r["id"]: r["r"] for r in join_ranks(fine, ranks, {"r": ("value", "rank")}).collect()}
    assert got == {"a": 4, "b": 3, "c": 2, "d": 1}


def test_floating_values_keep_their_type_and_mixtures_are_refused(spark):
    df = spark.createDataFrame([("a", 1e-9, 1), ("b", 2e-9, 2)], "id string, x double, n int")
    assert [r["rank"] for r in value_ranks(df, ["x"], descending=False).orderBy("value").collect()] == [1, 2]
    with pytest.raises(ValueError, match="exact common type"):
        value_ranks(df, ["x", "n"], descending=False)
