"""Interaction audit of document filters under every order of applying them.

A document's failures are a bit mask, so all documents of a part fall into at most 2^k classes, which
Spark counts. The step at which a class is removed under an order is a min-plus product: the mask
matrix holds 0 where a class fails a filter and infinity elsewhere, the position matrix holds the
inverse of each permutation, and the least sum over the filters is the step of the first filter that
the class fails. Counts of classes are then scattered to (order, step), weighted by rows, good rows
and toxic rows; what fails a filter after its removal is redundant there.

Defined cases: a null text is empty; a null source is the part ''; of rows with equal texts those with
the smallest id are originals, all of them if the id repeats; a null id is neither smaller nor larger
than another and is never a copy; a document is good or toxic if any of its labels says so; documents
without a label are neither, nor are those without an id; repeated rows count as often as they occur.
Texts are equal if their SHA-256 is. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tradewinds.llm.common import ship_package, text_of, words_of
from tradewinds.operators.materialise import materialise

MOST_FILTERS = 6  # 720 orders
NEVER = 99  # stands for infinity: no filter of the class removes it
LABELS = ["n", "good", "toxic"]
RESULT = """part string, filter_order string, step int, kept long, removed long, redundant long,
    unique_fails long, good_lost long, toxic_lost long, shapley long"""


def text_filters() -> dict[str, Column]:
    """Failure conditions on a text column `text`, and on `is_copy`."""
    text, n_words = F.col("text"), F.size("words").cast("bigint")
    distinct = F.size(F.array_distinct("words")).cast("bigint")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("bigint")
    return {
        "A": n_words < 50,
        "B": 100 * distinct < 65 * n_words,
        "C": 100 * capitals > 5 * F.length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
        "E": F.col("is_copy"),
    }


def classes(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], *, after_text: str = "E") -> DataFrame:
    """Rows, good and toxic rows per part and mask (bit i: fails the i-th filter); at most 2^k masks a part.

    Filters on the text are decided where the text is read. Copies (filter `after_text`) are told by the
    smallest id of each text: joined on text and id together, so a large group of copies is no hot key.
    """
    bits = {name: 1 << i for i, name in enumerate(filters)}
    read = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_of().alias("text")).select(
        "*", words_of(F.col("text")).alias("words")
    )
    mask = sum((F.when(fails, bits[name]).otherwise(0) for name, fails in filters.items() if name != after_text), F.lit(0))
    slim = materialise(
        read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
        .groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("rows"))
    )
    known = slim.filter("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("original", F.lit(True))
    said = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    copy = F.when(F.col("original").isNull(), bits.get(after_text, 0)).otherwise(0)
    marked = known.join(first, ["digest", "doc_id"], "left").join(said, "doc_id", "left").select(
        "part", F.col("mask").bitwiseOR(copy).alias("mask"), "rows", "good", "toxic"
    ).unionByName(slim.filter("doc_id is null").select("part", "mask", "rows"), allowMissingColumns=True)
    return marked.groupBy("part", "mask").agg(
        F.sum("rows").alias("n"),
        *[F.sum(F.col("rows") * F.coalesce(name, F.lit(0))).alias(name) for name in LABELS[1:]],
    )


def removal_steps(k: int) -> tuple[np.ndarray, np.ndarray]:
    """(step of removal per mask and order, or NEVER; position of each filter per order), steps from 0."""
    orders = np.array(list(permutations(range(k))), dtype=np.int64).reshape(-1, k)
    positions = np.argsort(orders, axis=1).T  # inverse permutations: filter x order
    fails = (np.arange(2**k)[:, None] >> np.arange(k)) & 1
    masks = np.where(fails == 1, 0, NEVER)  # class x filter
    first = (masks[:, :, None] + positions[None]).min(axis=1, initial=NEVER)
    return np.minimum(first, NEVER), positions


def _report(names: list[str]):
    """Function from batches of (part, counts per mask) to the audit's rows."""
    k = len(names)
    steps, positions = removal_steps(k)
    fails = ((np.arange(2**k)[:, None] >> np.arange(k)) & 1).astype(bool)
    orders = list(permutations(range(k)))
    size = len(orders)
    at_step = np.argsort(positions, axis=0)  # step x order -> filter
    labels = ["".join(names[f] for f in order) for order in orders]

    def part_rows(part: str, counts: np.ndarray) -> dict[str, np.ndarray]:
        lost = {name: np.zeros((size, k + 1), dtype=np.int64) for name in LABELS}
        redundant = np.zeros((size, k), dtype=np.int64)
        every = np.arange(size)
        for mask in np.flatnonzero(counts[0]):
            step = np.minimum(steps[mask], k)  # column k takes what stays
            for row, name in enumerate(LABELS):
                np.add.at(lost[name], (every, step), counts[row, mask])
            later = fails[mask][at_step.T] & (np.arange(k) > step[:, None])
            redundant += later * counts[0, mask]
        gone = lost["n"][:, :k]
        alone = np.array([counts[0, 1 << f] for f in range(k)], dtype=np.int64)
        shapley = np.zeros(k, dtype=np.int64)
        np.add.at(shapley, at_step.T.ravel(), gone.ravel())
        return {
            "part": [part] * (size * k), "filter_order": np.repeat(labels, k), "step": np.tile(np.arange(1, k + 1, dtype=np.int32), size),
            "kept": (counts[0].sum() - gone.cumsum(axis=1)).ravel(), "removed": gone.ravel(), "redundant": redundant.ravel(),
            "unique_fails": alone[at_step.T].ravel(), "good_lost": lost["good"][:, :k].ravel(),
            "toxic_lost": lost["toxic"][:, :k].ravel(), "shapley": shapley[at_step.T].ravel(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.zeros((len(LABELS), 2**k), dtype=np.int64)
                for of_class in row["classes"]:
                    counts[:, of_class["mask"]] += [of_class[name] for name in LABELS]
                yield pa.RecordBatch.from_pydict(part_rows(row["part"], counts))

    return run


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per part, order of the filters and step (from 1), zeros included.

    `kept` after the step; `removed`, `good_lost`, `toxic_lost` at it; `redundant`: failing its filter, removed
    before; `unique_fails`: failing its filter only; `shapley`: its filter's removals added up over all orders.
    """
    filters = dict(filters or text_filters())
    if not 1 <= len(filters) <= MOST_FILTERS:
        raise ValueError(f"{len(filters)} filters: all orders are listed, so 1 to {MOST_FILTERS} can be audited")
    ship_package(docs.sparkSession)
    per_part = classes(docs, labels, filters).groupBy("part").agg(
        F.collect_list(F.struct("mask", *LABELS)).alias("classes")  # at most 2^k
    )
    return per_part.mapInArrow(_report(list(filters)), RESULT)
