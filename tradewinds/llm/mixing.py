"""Mixing sources to target weights with nested hash thresholds.

A document's place in its source is a 60-bit hash of its id and text. A source takes all its
documents `k` times and those with hash below a threshold once more. The threshold is found without
sorting: sizes are summed by source and leading hash bits, the bucket in which the budget runs out is
split by the next bits, and so on until it holds one hash value. Buckets before it are whole, so each
round reads only rows of boundary buckets.

Defined cases: a null text has size 0; a null source is a source of its own and comes last; rows with
equal id and text have equal hashes, and if the threshold falls on them, they are numbered and as many
are taken as fit; a source without words has target 0 and takes nothing; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewinds.llm.common import WORD, text_of
from tradewinds.operators.materialise import materialise
from tradewinds.operators.ordered import positions

_BITS, _STEP = 60, 12


def hash60(column: Column) -> Column:
    """Leading 60 bits of the MD5 of a text, which other engines compute as well."""
    return F.conv(F.substring(F.md5(column), 1, 15), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, *, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Add `target` to rows (source, source_size).

    Sources in code-point order, null last, weigh `weights`, repeating, and divide `share` of all
    sizes. A target above `most` times its source's size stops there; what is over is divided again
    by weight, until none is above. Each round is one small aggregate over the sources.
    """
    placed = positions(sizes, [F.col("source").asc_nulls_last()], name="place")
    turn = F.col("place") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("bigint")
    rows = materialise(placed.select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * most
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    budget, level, full = share * total, 0.0, -1
    while True:
        over = cap.cast("double") <= F.lit(level) * F.col("weight")
        row = rows.agg(
            F.count_if(over).alias("n"), F.sum(F.when(over, cap)).alias("taken"),
            F.sum(F.when(~over, F.col("weight"))).alias("left"),
        ).first()
        if row["n"] == full or not row["left"]:
            break
        full, level = row["n"], max(0.0, (budget - (row["taken"] or 0)) / row["left"])
    over = cap.cast("double") <= F.lit(level) * F.col("weight")
    target = F.when(over, cap.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, *, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, most: int = 3, seed: str = "mix"
) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target and taken (words, repeats counted) per document.

    A source with target t and size s takes every document floor(t / s) times, once more those before
    its threshold, and the later one whose size is nearest to what is then left.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_of())
    slim = materialise(docs.select(
        "doc_id", "source", F.xxhash64(text_of()).alias("text_hash"), word_count(text_of()).alias("size"),
        hash60(name).alias("place"),
    ))
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights=weights, share=share, most=most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.select("*", whole.cast("bigint").alias("whole")).select(
        "*", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("before"),
    )
    state = materialise(state)

    # One boundary bucket per source and round: rows before its first hash are taken whole.
    for known in range(0, _BITS, _STEP):
        bound = state.filter("rest > 0").select(
            F.col("source").alias("in_source"), F.col("prefix").alias("in_prefix"), "rest", "before"
        )
        inside = F.col("source").eqNullSafe(F.col("in_source"))
        if known:
            inside &= F.shiftright("place", _BITS - known) == F.col("in_prefix")
        bucket = F.shiftright("place", _BITS - known - _STEP).alias("bucket")
        sums = slim.join(bound, inside).groupBy("source", "rest", "before", bucket).agg(
            F.sum("size").alias("size"), F.min("place").alias("low"), F.max("place").alias("high"), F.max("size").alias("one"),
        )
        ordered = Window.partitionBy("source").orderBy("bucket")  # at most 2 ** _STEP rows a source
        summed = sums.withColumn("after", F.col("before") + F.sum("size").over(ordered))
        # the first bucket in which the budget runs out; the last one if it never does
        first = summed.groupBy("source").agg(F.min_by(
            F.struct("bucket", "low", "high", "one", (F.col("after") - F.col("size")).alias("before"), "after"),
            F.struct(F.col("after") <= F.col("rest"), F.when(F.col("after") > F.col("rest"), F.col("bucket"))
                     .otherwise(-F.col("bucket"))),
        ).alias("b")).select(F.col("source").alias("in_source"), "b.*")
        joined = state.drop("prefix", "before", "low", "high", "one", "after").join(
            first, F.col("source").eqNullSafe(F.col("in_source")), "left"
        )
        state = materialise(joined.withColumnRenamed("bucket", "prefix").drop("in_source"))
        if state.filter("low < high").isEmpty():
            break

    # Rows at the threshold have one id, text and size: those that fit join. Of the rows beyond, the one that
    # comes nearest to what is then left joins, if it helps.
    left = F.col("rest") - F.col("before")
    fit = F.when((F.col("one") > 0) & (left > 0), F.floor(left / F.col("one"))).otherwise(0).cast("bigint")
    state = materialise(state.select("source", "source_size", "target", "whole", "low", fit.alias("fit"), (left - fit * F.col("one")).alias("gap")))
    bound = state.select(F.col("source").alias("in_source"), F.col("low").alias("limit"), "gap").filter("limit is not null")
    off = F.abs(F.col("size") - F.col("gap"))
    beyond = F.col("source").eqNullSafe(F.col("in_source")) & (F.col("place") >= F.col("limit")) & (off < F.col("gap"))
    filler = materialise(slim.join(bound, beyond).groupBy(F.col("source").alias("fill_source")).agg(
        F.min_by("place", F.struct(off, "place")).alias("fill")
    ))
    cuts = state.select(
        F.col("source").alias("in_source"), "source_size", "target", "whole", "fit", F.col("low").alias("limit")
    ).join(filler, F.col("in_source").eqNullSafe(F.col("fill_source")), "left").drop("fill_source")
    rows = slim.join(cuts, F.col("source").eqNullSafe(F.col("in_source")))
    at, filling = F.col("place").eqNullSafe(F.col("limit")), F.col("place").eqNullSafe(F.col("fill"))
    earlier = rows.filter(~at & ~filling).withColumn("again", F.coalesce(F.col("place") < F.col("limit"), F.lit(False)))
    # The row number breaks ties, so that many equal rows are cut into slices.
    tied = rows.filter(at | filling).withColumn("tie", F.monotonically_increasing_id())
    numbered = positions(tied, [F.col("tie").asc()], by=["source", "place"], name="number")
    wanted = F.when(at, F.col("fit")).otherwise(0) + F.when(filling, 1).otherwise(0)
    taken = earlier.unionByName(numbered.withColumn("again", F.col("number") < wanted).select(earlier.columns))
    times = F.col("whole") + F.col("again").cast("bigint")
    return taken.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", (F.col("size") * times).alias("taken"),
        times.alias("times"),
    )


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of the input.

    Of rows with equal id, text and source, each is taken equally often, or once more if its turn comes first.
    """
    columns = docs.columns
    taken = materialise(mix(docs, **settings).groupBy(
        F.col("doc_id").alias("mix_id"), F.col("text_hash").alias("mix_hash"), F.col("source").alias("mix_source")
    ).agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("alike")).filter("times > 0"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("doc_id").alias("key_id"),
        F.xxhash64(text_of()).alias("key_hash"), F.col("source").alias("key_source"),
    )
    equal = (
        F.col("key_id").eqNullSafe(F.col("mix_id")) & (F.col("key_hash") == F.col("mix_hash"))
        & F.col("key_source").eqNullSafe(F.col("mix_source"))
    )
    each, over = F.expr("times div alike"), F.col("times") % F.col("alike")
    kept = rows.hint("merge").join(taken.withColumn("each", each).filter("each > 0"), equal)
    kept = kept.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("each"))).alias("copy"))
    # Only rows at a threshold can be taken unequally: at most two groups of equal rows a source.
    uneven = taken.withColumn("over", over).filter("over > 0")
    some = rows.join(uneven, equal).select("row", "key_id", "key_hash", "key_source", "over", F.monotonically_increasing_id().alias("tie"))
    turns = positions(some, [F.col("tie").asc()], by=["key_source", "key_id", "key_hash"], name="turn")
    return kept.select("row.*").unionByName(turns.filter(F.col("turn") < F.col("over")).select("row.*"))
