"""Forests and boosting on features that are binned once.

A tree asks for sums (rows, targets, weights) per node, feature and bin, a level at a time, and only for
left children: a right child is its parent without its left sibling. Growing is written as a generator of
such questions, so it does not know where its rows are:

- up to `local_rows` rows, every unit (one boosted model, one tree of a forest) is grown in a task of its
  own next to a copy of the binned rows, a byte per feature: all units of all candidates are one Spark job;
- beyond, blocks of rows stay on the executors and all models that grow at a time have their questions
  answered by one pass over the blocks, whose sums are added up as a tree. A pass is a pure function of
  the blocks and of the trees grown since they were last written to the checkpoint folder, so a lost
  executor costs a repetition, not the model.

Both ways draw the same rows and features; only the order in which blocks are added up may differ.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tradewinds.operators.code import ship_code
from tradewinds.operators.materialise import materialise, prepare_checkpoints

BINS = 64
LOCAL_ROWS = 1 << 17  # 2 MB of binned features of this library's models
_BLOCK_ROWS = 1 << 15
_REFRESH = 20  # trees after which the blocks' scores are written again
_TOGETHER = 4  # trees of a forest that grow at a time beyond `local_rows`
_LEAST_GAIN = 1e-9

NODES = "unit string, base double, tree int, node int, feature int, bin int, value double, gain double"


@dataclass(frozen=True)
class Settings:
    """One candidate. Boosting fits residuals; `second_order` weighs rows by the loss's curvature too."""

    trees: int
    depth: int
    least_rows: int
    boosting: bool
    logistic: bool = False
    second_order: bool = False
    l2: float = 0.0
    rate: float = 1.0
    row_share: float = 1.0
    feature_share: float = 1.0
    features_a_node: bool = False
    weight: str | tuple[float, float] | None = None  # of classes 0 and 1, or the name of such a pair
    seed: int = 42


@dataclass
class Tree:
    """Node n has the children 2n and 2n + 1; a node without a feature is a leaf or does not exist."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)  # a bin while growing, a value of the feature afterwards
    value: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 << self.depth
        self.feature = np.full(size, -1, dtype=np.int32)
        self.cut, self.value, self.gain = np.zeros(size), np.zeros(size), np.zeros(size)

    def node_of(self, rows: np.ndarray) -> np.ndarray:
        node, every = np.ones(len(rows), dtype=np.int64), np.arange(len(rows))
        for _ in range(self.depth):
            at = self.feature[node]
            if not (at >= 0).any():
                break
            right = rows[every, np.maximum(at, 0)] > self.cut[node]
            node = np.where(at >= 0, 2 * node + right, node)
        return node


#: A question: trees grown so far, the growing tree, its nodes, and the number that rows are drawn by.
Question = tuple[list[Tree], Tree, list[int], int]


# ---- growing ------------------------------------------------------------------------------------

def _best_splits(sums: np.ndarray, settings: Settings, allowed: np.ndarray):
    """Per node: feature, bin, gain of the best split, and whether there is one. `sums` is (3, node, feature, bin)."""
    def weight(rows, _, curvature):
        return curvature + settings.l2 if settings.second_order or not settings.boosting else rows

    left = sums[..., :-1].cumsum(axis=-1)
    whole = sums.sum(axis=-1, keepdims=True)
    right = whole - left

    def purity(part):
        return part[1] ** 2 / np.maximum(weight(*part), 1e-12)

    gain = purity(left) + purity(right) - purity(whole)
    # a cut after an empty bin is the cut before it: rounding must not choose between them
    fits = (left[0] >= settings.least_rows) & (right[0] >= settings.least_rows) & allowed[..., None] & (sums[0, ..., :-1] > 0)
    gain = np.where(fits, gain, -1.0).reshape(len(allowed), -1)
    best = gain.argmax(axis=1)
    value = gain[np.arange(len(best)), best]
    return best // left.shape[-1], best % left.shape[-1], value, value > _LEAST_GAIN


def _grow(settings: Settings, width: int, number: int, done: list[Tree]) -> Generator[Question, np.ndarray, Tree]:
    """One tree, level by level."""
    draw = np.random.default_rng([settings.seed, number])
    taken = max(1, round(settings.feature_share * width))

    def some() -> np.ndarray:
        chosen = np.zeros(width, dtype=bool)
        chosen[draw.permutation(width)[:taken]] = True
        return chosen

    of_tree = some()
    tree = Tree(settings.depth)
    nodes = [1]
    sums = yield done, tree, nodes, number

    def leaf(part: np.ndarray) -> float:
        return settings.rate * part[1] / (part[2] + settings.l2) if part[2] + settings.l2 > 1e-12 else 0.0

    tree.value[1] = leaf(sums[:, 0, 0].sum(axis=-1))
    for level in range(settings.depth):
        allowed = np.array([some() if settings.features_a_node else of_tree for _ in nodes])
        feature, at, gain, found = _best_splits(sums, settings, allowed)
        parents = [i for i in range(len(nodes)) if found[i]]
        if not parents:
            break
        for i in parents:
            node = nodes[i]
            tree.feature[node], tree.cut[node], tree.gain[node] = feature[i], at[i], gain[i]
            split = sums[:, i, feature[i]]
            for child, part in ((2 * node, split[:, :at[i] + 1]), (2 * node + 1, split[:, at[i] + 1:])):
                tree.value[child] = leaf(part.sum(axis=-1))
        if level + 1 == settings.depth:
            break
        left = yield done, tree, [2 * nodes[i] for i in parents], number
        sums = np.stack([left, sums[:, parents] - left], axis=2).reshape(len(sums), -1, *sums.shape[2:])
        nodes = [child for i in parents for child in (2 * nodes[i], 2 * nodes[i] + 1)]
    return tree


def _grow_all(settings: Settings, width: int, numbers: Sequence[int]) -> Generator[Question, np.ndarray, list[Tree]]:
    """The trees of a boosted model, or one tree of a forest."""
    done: list[Tree] = []
    for number in numbers:
        tree = yield from _grow(settings, width, number, done)
        done = [*done, tree]
    return done


# ---- answering ----------------------------------------------------------------------------------

class Rows:
    """A block of binned rows as one candidate sees it; its scores include the first `applied` trees."""

    def __init__(self, block: int, bins: np.ndarray, label: np.ndarray, settings: Settings, base: float):
        self.block, self.bins, self.label, self.settings = block, bins, label, settings
        self.weight = np.where(label == 1, settings.weight[1], settings.weight[0]) if settings.weight else np.ones(len(label))
        self.score, self.applied = np.full(len(label), base), 0

    def advance(self, done: list[Tree], before: int = 0) -> Rows:
        for tree in done[self.applied - before:]:
            self.score = self.score + tree.value[tree.node_of(self.bins)]
        self.applied = before + len(done)
        return self

    def _targets(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        settings, n = self.settings, len(self.label)
        draw = np.random.default_rng([settings.seed, number, self.block])
        if not settings.boosting:
            times = draw.poisson(1.0, n).astype(float)
            return times, times * self.weight * self.label, times * self.weight
        taken = (draw.random(n) < settings.row_share).astype(float)
        if settings.logistic:
            p = 1 / (1 + np.exp(-self.score))
            return taken, taken * self.weight * (self.label - p), taken * self.weight * p * (1 - p)
        return taken, taken * self.weight * (self.label - self.score), taken * self.weight

    def sums(self, question: Question, before: int = 0) -> np.ndarray:
        """(3, node, feature, bin): rows, weighted targets and weights or curvatures."""
        done, tree, nodes, number = question
        self.advance(done, before)
        place = np.full(2 << tree.depth, -1, dtype=np.int64)
        place[nodes] = np.arange(len(nodes))
        at = place[tree.node_of(self.bins)]
        targets = self._targets(number)
        inside = np.flatnonzero((at >= 0) & (targets[0] > 0))
        first = at[inside] * BINS
        result = np.empty((3, len(nodes), self.bins.shape[1], BINS))
        for column in range(self.bins.shape[1]):
            cell = first + self.bins[inside, column]
            for kind in range(3):
                counted = np.bincount(cell, weights=targets[kind][inside], minlength=len(nodes) * BINS)
                result[kind, :, column] = counted.reshape(len(nodes), BINS)
        return result


def _answer_here(growing: Generator, blocks: list[Rows]) -> list[Tree]:
    """All questions answered from blocks at hand."""
    try:
        question = next(growing)
        while True:
            question = growing.send(sum(rows.sums(question) for rows in blocks))
    except StopIteration as end:
        return end.value


def _answer_by_passes(growing: Mapping[str, Generator], blocks: RDD) -> dict[str, list[Tree]]:
    """Questions of all models answered together, one pass over the blocks (dicts of Rows) each."""
    finished: dict[str, list[Tree]] = {}
    questions: dict[str, Question] = {}
    before = {name: 0 for name in growing}

    def ask(name: str, answer: np.ndarray | None) -> None:
        try:
            questions[name] = growing[name].send(answer)
        except StopIteration as end:
            questions.pop(name, None)
            finished[name] = end.value

    def held(question: Question, start: int) -> Question:
        return question[0][start:], *question[1:]

    for name in growing:
        ask(name, None)
    state = blocks
    while questions:
        if any(len(q[0]) - before[name] >= _REFRESH for name, q in questions.items()):
            grown = {name: (q[0][before[name]:], before[name]) for name, q in questions.items()}
            fresh = state.map(lambda b, g=grown: {n: r.advance(*g[n]) for n, r in b.items() if n in g}).persist(StorageLevel.MEMORY_AND_DISK)
            fresh.checkpoint()
            fresh.count()
            if state is not blocks:
                state.unpersist()
            state, before = fresh, before | {name: len(q[0]) for name, q in questions.items()}
        asked = {name: (held(q, before[name]), before[name]) for name, q in questions.items()}
        answers = state.map(lambda b, a=asked: {n: b[n].sums(*a[n]) for n in a})
        total = answers.treeReduce(lambda x, y: {n: x[n] + y[n] for n in x})
        for name in list(asked):
            ask(name, total[name])
    if state is not blocks:
        state.unpersist()
    return finished


# ---- bins and blocks ----------------------------------------------------------------------------

def borders(rows: DataFrame, width: int) -> list[np.ndarray]:
    """At most `BINS` - 1 borders a feature, quantiles of its values; bin b holds values up to border b."""
    arrays = rows.select(vector_to_array("features").alias("x"))
    shares = [i / BINS for i in range(1, BINS)]
    row = arrays.agg(*[F.percentile_approx(F.col("x")[i], shares, 10_000).alias(f"f{i}") for i in range(width)]).first()
    return [np.unique(np.array(values if values is not None else [], dtype=float)) for values in row]


def binned_blocks(rows: DataFrame, edges: Sequence[np.ndarray]) -> DataFrame:
    """Blocks of at most `_BLOCK_ROWS` rows of (features, label), written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = np.stack(batch.column(0).to_numpy(zero_copy_only=False))
            bins = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)
            label = batch.column(1).to_numpy(zero_copy_only=False).astype("<f8")
            for at in range(0, batch.num_rows, _BLOCK_ROWS):
                part = slice(at, at + _BLOCK_ROWS)
                yield pa.RecordBatch.from_pydict({"bins": [bins[part].tobytes()], "label": [label[part].tobytes()]})

    packed = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"))
    blocks = packed.mapInArrow(run, "bins binary, label binary")
    return materialise(blocks.select(F.monotonically_increasing_id().alias("block"), "bins", "label"))


def _rows_of(row: Mapping, width: int, settings: Settings, base: float) -> Rows:
    label = np.frombuffer(row["label"], dtype="<f8")
    return Rows(row["block"], np.frombuffer(row["bins"], dtype=np.uint8).reshape(len(label), width), label, settings, base)


def _base(settings: Settings, rows: float, labels: float) -> float:
    if not settings.boosting:
        return 0.0
    mean = labels / rows
    return float(np.log(mean / (1 - mean))) if settings.logistic and 0 < mean < 1 else 0.0 if settings.logistic else mean


def _units(candidates: Mapping[str, Settings]) -> dict[str, tuple[Settings, list[int]]]:
    """What grows on its own: a boosted model, or a tree of a forest."""
    units = {}
    for name, settings in candidates.items():
        numbers = list(range(settings.trees))
        parts = [numbers] if settings.boosting else [[n] for n in numbers]
        units |= {f"{name}/{part[0]}": (settings, part) for part in parts if part}
    return units


def _node_rows(unit: str, base: float, numbers: Sequence[int], trees: Sequence[Tree]) -> pa.RecordBatch:
    columns = {name: [] for name in ("tree", "node", "feature", "bin", "value", "gain")}
    for number, tree in zip(numbers, trees):
        used = np.flatnonzero(tree.feature >= 0)
        nodes = np.unique(np.concatenate([[1], used, 2 * used, 2 * used + 1])).astype(np.int32)
        for name, values in (
            ("tree", np.full(len(nodes), number)), ("node", nodes), ("feature", tree.feature[nodes]), ("bin", tree.cut[nodes]),
            ("value", tree.value[nodes]), ("gain", tree.gain[nodes]),
        ):
            columns[name].append(values)
    joined = {name: np.concatenate(parts) for name, parts in columns.items()}
    size = len(joined["node"])
    whole = {name: joined[name].astype(np.int32) for name in ("tree", "node", "feature", "bin")}
    return pa.RecordBatch.from_pydict(
        {"unit": [unit] * size, "base": np.full(size, base), **whole, "value": joined["value"], "gain": joined["gain"]}
    )


def fit(rows: DataFrame, width: int, candidates: Mapping[str, Settings], *, local_rows: int | None = None) -> DataFrame:
    """Nodes of all candidates' trees: model, base, tree, node, feature, cut, value, gain, written.

    A row goes to node 2n + 1 if its feature is above the cut of node n, else to 2n. `rows` (features,
    label) is read several times: pass a written frame. Features are numbers without nulls.
    """
    spark = rows.sparkSession
    ship_code(spark)
    local_rows = LOCAL_ROWS if local_rows is None else local_rows
    edges = borders(rows, width)
    blocks = binned_blocks(rows, edges)
    sizes = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("label").cast("double").alias("labels")).first()
    base = {name: _base(s, sizes["rows"], sizes["labels"]) if sizes["rows"] else 0.0 for name, s in candidates.items()}
    units = _units(candidates)

    def start(unit: str) -> float:
        return base[unit.split("/")[0]]

    if sizes["rows"] <= local_rows:
        def grow(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            unit = key[0].as_py()
            settings, numbers = units[unit]
            held = [_rows_of(row, width, settings, start(unit)) for row in sorted(table.to_pylist(), key=lambda r: r["block"])]
            trees = _answer_here(_grow_all(settings, width, numbers), held)
            return pa.Table.from_batches([_node_rows(unit, start(unit), numbers, trees)])

        names = F.explode(F.array(*[F.lit(unit) for unit in units])).alias("unit")
        grown = blocks.select(names, *blocks.columns).repartition(2 * spark.sparkContext.defaultParallelism, "unit")
        nodes = grown.groupBy("unit").applyInArrow(grow, NODES)
    else:
        prepare_checkpoints(spark)
        boosted = [unit for unit, (settings, _) in units.items() if settings.boosting]
        single = [unit for unit in units if unit not in boosted]
        groups = [boosted] * bool(boosted) + [single[i:i + _TOGETHER] for i in range(0, len(single), _TOGETHER)]
        parts = []
        for group in groups:
            held = blocks.rdd.map(lambda row, g=group: {u: _rows_of(row, width, units[u][0], start(u)) for u in g})
            held = held.persist(StorageLevel.MEMORY_AND_DISK)
            trees = _answer_by_passes({u: _grow_all(units[u][0], width, units[u][1]) for u in group}, held)
            held.unpersist()
            parts += [_node_rows(u, start(u), units[u][1], trees[u]) for u in group]
        nodes = spark.createDataFrame(pa.Table.from_batches(parts))  # bounded by trees x 2 ** depth
    cuts = F.array(*[F.array(*[F.lit(float(v)) for v in e]).cast("array<double>") for e in edges])
    cut = F.when(F.col("feature") >= 0, F.get(F.get(cuts, F.col("feature")), F.col("bin")))
    return materialise(nodes.select(
        F.split("unit", "/")[0].alias("model"), "base", "tree", "node", "feature", cut.alias("cut"), "value", "gain"
    ))


# ---- the fitted ensemble ------------------------------------------------------------------------

@dataclass(frozen=True)
class Ensemble:
    """Trees with cuts in the features' own units; small: trees x 2 ** (depth + 1) nodes at most."""

    settings: Settings
    base: float
    trees: list[Tree]

    @staticmethod
    def read(nodes: DataFrame, name: str, settings: Settings) -> Ensemble:
        table = nodes.filter(F.col("model") == name).orderBy("tree", "node").toArrow().to_pydict()
        trees = [Tree(settings.depth) for _ in range(settings.trees)]
        for at, (number, node) in enumerate(zip(table["tree"], table["node"])):
            tree = trees[number]
            tree.feature[node], tree.value[node], tree.gain[node] = table["feature"][at], table["value"][at], table["gain"][at]
            tree.cut[node] = table["cut"][at] if table["cut"][at] is not None else 0.0
        return Ensemble(settings, table["base"][0] if table["base"] else 0.0, trees)

    def importance(self, width: int) -> np.ndarray:
        """Gains per feature, adding up to 1."""
        gains = np.zeros(width)
        for tree in self.trees:
            split = tree.feature >= 0
            np.add.at(gains, tree.feature[split], tree.gain[split])
        return gains / gains.sum() if gains.sum() > 0 else gains

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += tree.value[tree.node_of(x)]
        return total if self.settings.boosting else total / max(1, len(self.trees))

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add `prediction`, and for classes `good`, the probability of class 1."""
        ship_code(rows.sparkSession)
        shipped = rows.sparkSession.sparkContext.broadcast(self)
        settings = self.settings

        @F.pandas_udf("double")
        def score(features: pd.Series) -> pd.Series:
            return pd.Series(shipped.value.scores(np.stack(features.to_numpy())) if len(features) else np.zeros(0))

        raw = rows.withColumn("score", score(vector_to_array("features")))
        if not settings.logistic:
            return raw.withColumnRenamed("score", "prediction")
        good = 1 / (1 + F.exp(-F.col("score"))) if settings.boosting else F.col("score")
        return raw.withColumn("good", good).drop("score").withColumn("prediction", (F.col("good") > 0.5).cast("double"))
