"""Contiguous shards of least capacity over groups of equal texts.

Groups are atoms, ordered by a 62-bit hash of their text. An atom larger than an even share of what
is left takes a shard of its own; the others are cut into contiguous runs of least capacity, found by
binary search with a greedy check. The search runs on a histogram of sizes by leading hash bits. Only
buckets in which a cut can fall are split further, until every such bucket is one atom, so the result
is that of a search over all atoms while the driver sees a few thousand sums a round.

Defined cases: a null text is an empty text of size 1; texts with equal hashes count as one atom;
repeated rows are rows of their own; an empty table gives no row.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradewinds.llm.common import text_of
from tradewinds.operators.materialise import materialise

_BITS, _STEP = 62, 11


@dataclass(frozen=True)
class Run:
    """Atoms whose hashes share `bits` leading bits; `low` and `high` are its first and last hash."""

    prefix: int
    bits: int
    size: int
    low: int
    high: int

    @property
    def one(self) -> bool:
        return self.low == self.high


def _cuts(sums: list[int], capacity: int) -> list[int]:
    """Ends of greedy runs: `sums` are running totals with a leading 0."""
    ends, at = [], 0
    while at < len(sums) - 1:
        end = bisect_right(sums, sums[at] + capacity) - 1
        ends.append(end)
        if end == at:  # an atom above the capacity
            return [*ends, -1]
        at = end
    return ends


def least_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity at which greedy contiguous runs need at most `shards` shards."""
    sums = [0]
    for size in sizes:
        sums.append(sums[-1] + size)
    low, high = max([-(-sums[-1] // shards), *sizes]), sums[-1]
    while low < high:
        middle = (low + high) // 2
        ends = _cuts(sums, middle)
        if ends[-1:] != [-1] and len(ends) <= shards:
            high = middle
        else:
            low = middle + 1
    return high


def _unsettled(runs: list[Run], shards: int, high: int) -> list[int]:
    """Runs of several atoms in which a cut of a capacity up to `high` can fall."""
    sums = [0]
    for run in runs:
        sums.append(sums[-1] + run.size)
    mass = sum(run.size for run in runs)
    low = max([-(-mass // shards), *[run.size for run in runs if run.one]])
    first = last = 0  # least and greatest running total of the cut
    found = set()
    for _ in range(shards - 1):
        to = bisect_right(sums, first + low) - 1
        first = max(first, sums[to])
        last = min(mass, last + high)
        inside = bisect_right(sums, last) - 1
        if inside < len(runs) and runs[inside].one:
            last = sums[inside]
        found.update(i for i in range(to, min(inside, len(runs) - 1) + 1) if not runs[i].one)
    return sorted(found)


def _split(atoms: DataFrame, runs: list[Run], chosen: list[int], giants: list[int]) -> list[Run]:
    """The chosen runs by the next bits of the hash. Runs chosen together may differ in depth."""
    out = {i: [run] for i, run in enumerate(runs)}
    by_depth: dict[int, list[int]] = {}
    for i in chosen:
        by_depth.setdefault(runs[i].bits, []).append(i)
    for bits, ids in by_depth.items():
        deeper = min(_BITS, bits + _STEP)
        prefixes = {runs[i].prefix: i for i in ids}
        side = atoms.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix long")
        inside = atoms.filter(~F.col("place").isin(giants)) if giants else atoms
        inside = inside.join(F.broadcast(side), F.shiftright("place", _BITS - bits) == F.col("prefix"), "left_semi")
        for i in ids:
            out[i] = []
        for run in _runs(inside, deeper):
            out[prefixes[run.prefix >> (deeper - bits)]].append(run)
    return [run for i in range(len(runs)) for run in out[i]]


def _runs(atoms: DataFrame, bits: int) -> list[Run]:
    rows = atoms.groupBy(F.shiftright("place", _BITS - bits).alias("prefix")).agg(
        F.sum("size").alias("size"), F.min("place").alias("low"), F.max("place").alias("high")
    ).collect()  # at most 2 ** _STEP rows for each run that is split
    return [Run(r.prefix, bits, r["size"], r.low, r.high) for r in sorted(rows)]


def shard_cuts(atoms: DataFrame, shards: int) -> tuple[list[int], list[int]]:
    """Hashes of atoms with a shard of their own, and the first hash of each later contiguous shard.

    `atoms` has one row per group: place (hash) and size.
    """
    total = atoms.agg(F.sum("size")).first()[0] or 0
    largest = atoms.orderBy(F.desc("size"), "place").limit(shards - 1).collect() if shards > 1 else []
    giants, left = [], total
    for row in largest:
        if row["size"] * (shards - len(giants)) <= left:
            break
        giants.append(row.place)
        left -= row["size"]
    rest = shards - len(giants)
    ordinary = atoms.filter(~F.col("place").isin(giants)) if giants else atoms
    runs = _runs(ordinary, _STEP)
    while runs:
        capacity = least_capacity([run.size for run in runs], rest)
        open_runs = _unsettled(runs, rest, capacity)
        if not open_runs:
            break
        runs = _split(atoms, runs, open_runs, giants)
    sums = [0]
    for run in runs:
        sums.append(sums[-1] + run.size)
    ends = _cuts(sums, least_capacity([run.size for run in runs], rest)) if runs else []
    return giants, [runs[end].low for end in ends if end < len(runs)]


def shard(docs: DataFrame, shards: int = 8, *, rows_a_slice: int = 50_000) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot per document; equal texts share a shard.

    Slots number the rows of a shard from 0. A shard is numbered in hash slices of about
    `rows_a_slice` rows, so no task holds a whole shard or a whole group.
    """
    spark: SparkSession = docs.sparkSession
    text = text_of()
    slim = materialise(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - _BITS).alias("place"),
        F.xxhash64(F.col("doc_id"), text).alias("row_hash"),
    ))
    atoms = materialise(slim.groupBy("place").agg(F.sum("size").alias("size")))
    giants, starts = shard_cuts(atoms, shards)
    number = F.lit(len(giants))
    for start in starts:
        number = number + (F.col("place") >= start).cast("int")
    for i, place in enumerate(giants):
        number = F.when(F.col("place") == place, i).otherwise(number)

    slices = max(1, -(-slim.count() // rows_a_slice))
    part = F.pmod("row_hash", F.lit(slices)).cast("int")
    dealt = slim.select("doc_id", "size", "text_crc32", "row_hash", number.cast("int").alias("shard"), part.alias("slice"))
    counts = dealt.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("shard").alias("in_shard"), F.col("slice").alias("in_slice"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("shard", "slice").orderBy(F.col("doc_id").asc_nulls_last(), "row_hash")
    placed = dealt.withColumn("at", F.row_number().over(inside) - 1).join(
        before, (F.col("shard") == F.col("in_shard")) & (F.col("slice") == F.col("in_slice"))
    )
    return placed.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("at")).cast("bigint").alias("slot")
    )
