"""Near duplicates by circulant MinHash, exact verification and connected components.

One permutation (a multiplicative hash to 2 ** 20 places) scatters the shingles of a document; a
second one, a fixed random permutation, is shifted circularly by one place for every further
coordinate of the signature. Coordinates are banded, so that a pair at the threshold is missed with
probability below 1e-5. Candidates are confirmed on the full shingle sets.

Documents with equal shingle sets are one class from the start. Shingles that no other candidate has
bound what a class can share: one with too many of its own is dropped, exactly, before any pair is
made. Pairs inside a bucket are not listed. In a round every class outside a bucket's largest
component meets one centre from it, confirmed links become components, and only buckets that still
hold several components go on. When what is left is small, the remaining pairs of different components are
confirmed. When much is left and a round joined little, as with many texts of one template just below the
threshold, pairs are made by a positional prefix join instead: only classes that share one of their
rarest shingles meet. A pair inside one component needs no check, so no link that could join two
components is left out, while groups of copies cost a few pairs per member.

One node, class or component may hold a third of all rows. `join_unique` sends the one row that such a
key has to each of about sqrt(rows) slices of the key, so that neither side piles up in one task.

Defined cases: documents without words, and null texts, have an empty set and are linked with
nothing; with fewer words than a shingle has, the sequence is one shingle; a null id never names a
component with other ids, and a component without any id has the null one, so all its rows count as
kept; rows that repeat id and text share a class and its component, and are kept alike. `keep_first`
leaves one row of each component all the same: the first by id (null last) and text hash, and any one of
the rows that repeat it; documents without words all stay. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tradewinds.llm.common import ship_package, text_of
from tradewinds.operators.materialise import Scope, materialise

_PLACES = 1 << 20
_ROWS = 6  # coordinates a band
_REMEMBERED = 500_000
_BLOCK = 2048  # shingles whose signatures are gathered at once
_CHUNK = 64  # pairs of one centre that a task reads in a row
_ROUNDS = 4  # with centres; what they leave is then compared in pairs
_FEW, _POOR = 8, 10  # earlier, if few pairs a member are left or fewer than a tenth of the last ones were links


class _Words(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= 100:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = found
        return found


_words = _Words()


def bands_for(percent: int) -> int:
    """Bands that miss a pair at the threshold with probability below 1e-5."""
    return math.ceil(-5 / math.log10(1 - (percent / 100) ** _ROWS))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. Lower-casing and splitting bytes touch ASCII alone."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    hashes = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        hashes = _mix(hashes * np.uint64(0x9E3779B97F4A7C15) + ids[j:len(words) - width + 1 + j])
    return np.unique(hashes)


@lru_cache(maxsize=2)
def _shifts(coordinates: int) -> np.ndarray:
    """Row p holds places p, p + 1, ... of the second permutation: the first entries of all its shifts."""
    order = np.random.default_rng(20_220_101).permutation(_PLACES).astype(np.uint32)
    return sliding_window_view(np.concatenate([order, order[:coordinates]]), coordinates)


def band_hashes(shingles: np.ndarray, bands: int) -> np.ndarray:
    coordinates = bands * _ROWS
    places = ((shingles * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(np.int64)
    signature = np.full(coordinates, np.iinfo(np.uint32).max, dtype=np.uint32)
    for start in range(0, len(places), _BLOCK):
        np.minimum(signature, _shifts(coordinates)[places[start:start + _BLOCK]].min(axis=0), out=signature)
    rows = signature.reshape(bands, _ROWS).astype(np.uint64)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(_ROWS):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return out.view(np.int64)


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("null"))


def sketches(docs: DataFrame, *, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (128-bit hash of the set; null if empty) and band hashes."""
    ship_package(docs.sparkSession)
    bands = bands_for(percent)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("text_hash", T.LongType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ])

    def sketch(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                sizes, ids, lists = [], [], []
                for text in part.column(2).to_pylist():
                    found = shingle_set(text, words)
                    sizes.append(len(found))
                    ids.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    lists.append(band_hashes(found, bands) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                    names=schema.fieldNames(),
                )

    return docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), "text").mapInArrow(sketch, schema)


def confirm(pairs: DataFrame, texts: DataFrame, *, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes with the number of shingles in both, and whether that makes a link.

    `texts` has one text per class.

    The pairs of a centre `a` are dealt into chunks; its text is sent once per chunk, before the others.
    """
    degrees = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / _CHUNK).cast("int").alias("chunks"))
    dealt = pairs.join(degrees, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"))
    # a chunk's first row has no b: it brings the text of the centre
    asked = dealt.unionByName(dealt.select("a", F.lit(None).cast("binary").alias("b"), "chunk").distinct())
    rows = asked.withColumn("of", F.coalesce("b", "a")).hint("merge").join(texts.withColumnRenamed("set_id", "of"), "of").select("a", "chunk", "b", "text")

    def compare(batches):
        centre, shingles = None, None
        for batch in batches:
            a, b, common, linked = [], [], [], []
            for head, other, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                own = shingle_set(text, words)
                if other is None:
                    centre, shingles = head, own
                    continue
                assert head == centre, "a centre comes before its pairs"
                both = len(np.intersect1d(shingles, own, assume_unique=True))
                a.append(head), b.append(other), common.append(both)
                linked.append(100 * both >= percent * (len(shingles) + len(own) - both))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(common, pa.int64()), pa.array(linked, pa.bool_())],
                names=["a", "b", "both", "linked"],
            )

    ordered = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return ordered.mapInArrow(compare, "a binary, b binary, both long, linked boolean")


def _dealt(rows: DataFrame, by: str, slices: int) -> DataFrame:
    return rows.withColumn("_slice", F.pmod(F.xxhash64(by), F.lit(slices)))


def _join_slices(dealt: DataFrame, unique: DataFrame, key: str) -> DataFrame:
    """Inner join of dealt rows with a table that has one row per key and, in `_in`, the slices in use."""
    used = unique.withColumn("_slice", F.explode("_in")).drop("_in")
    return dealt.join(used, [key, "_slice"]).drop("_slice")


def join_unique(rows: DataFrame, unique: DataFrame, key: str, by: str, slices: int) -> DataFrame:
    """Inner join of rows, many of which may have one key, with a table that has one row per key.

    A key's rows are dealt into slices by the hash of column `by`; the table's row goes to the slices in use.
    """
    dealt = _dealt(rows, by, slices)
    used = dealt.groupBy(key).agg(F.collect_set("_slice").alias("_in")).join(unique, key)
    return _join_slices(dealt, used, key)


def _slices(rows: int) -> int:
    """So many that a key with all rows has as many slices as a slice has rows."""
    return math.isqrt(rows) + 1


def _star(edges: DataFrame, slices: int, *, large: bool) -> DataFrame:
    """One step on edges (u, v) with u > v. A node's least neighbour and the slices its edges are in come from one aggregate.

    The large step may repeat an edge; the small one leaves out what is repeated.
    """
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    dealt = _dealt(near, "v", slices)
    least = dealt.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.collect_set("_slice").alias("_in"))
    joined = _join_slices(dealt, least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # the edge to the least neighbour stays, the others go from the neighbour to it
    return joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, the least node of its component, by alternating large and small stars. Written.

    `links` are read twice: pass written ones.
    """
    with Scope(links.sparkSession) as scope:
        edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
        slices = _slices(2 * edges.count())
        while True:
            # only the small step reads it: it stays on the executors' disks, and a lost part is made again
            large = _star(edges, slices, large=True).persist(StorageLevel.DISK_ONLY)
            edges = materialise(_star(large, slices, large=False))
            large.unpersist()
            # done when it is a forest of stars: every node has one centre, and no centre has one
            ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("n"), F.lit(0).alias("centre"))
            centres = edges.select(F.col("v").alias("x"), F.lit(0).alias("n"), F.lit(1).alias("centre"))
            nodes = ends.unionByName(centres).groupBy("x").agg(F.sum("n").alias("n"), F.max("centre").alias("centre"))
            if nodes.filter("n + centre > 1").isEmpty():
                return scope.keep(edges).select(F.col("u").alias("node"), F.col("v").alias("root"))


def _labelled(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("label", F.col("set_id"))
    named = roots.select(F.col("node").alias("set_id"), "root")
    return members.join(named, "set_id", "left").withColumn("label", F.coalesce("root", "set_id")).drop("root")


def _shingles(texts: DataFrame, *, words: int) -> DataFrame:
    """number and shingle, one row per shingle of a class."""
    def lists(batches):
        for batch in batches:
            found = [shingle_set(text, words).view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["number", "shingles"])

    sets = texts.select("number", "text").mapInArrow(lists, "number long, shingles array<long>")
    return sets.select("number", F.explode("shingles").alias("shingle"))


def own_shingles(texts: DataFrame, *, words: int) -> DataFrame:
    """set_id and own, the shingles that no other class has. `texts` has set_id, text and a number."""
    holders = _shingles(texts, words=words).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("number").alias("number")
    )
    own = holders.filter("n = 1").groupBy("number").agg(F.count(F.lit(1)).alias("own"))
    return texts.select("set_id", "number").join(own, "number", "left").select("set_id", F.coalesce("own", F.lit(0)).alias("own"))


def _possible(percent: int, n: Column, own: Column, other: Column) -> Column:
    """Whether a set of n shingles, `own` of them nowhere else, can be linked with one of `other`.

    At most n - own are shared, and a link shares at least percent / (100 + percent) of n + other.
    """
    return (100 + percent) * (n - own) >= percent * (n + other)


def prefix_pairs(members: DataFrame, texts: DataFrame, *, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes with different labels that can be linked, by a positional prefix join.

    `members` has set_id, label and n, `texts` has set_id, text and number, one row per class each.

    The shingles of a class are ranked, those with the fewest holders first. Linked sets of n <= m shingles
    share one of the first floor(n (100 - percent) / (100 + percent)) + 1 of the smaller and the first
    floor(m (100 - percent) / 100) + 1 of the larger. Shingles without another holder come first and
    take up places, but no rows.
    """
    classes = texts.select("set_id", "number").join(members, "set_id")
    rows = materialise(_shingles(texts.join(members.select("set_id"), "set_id", "left_semi"), words=words))
    holders = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    shared = join_unique(rows, holders, "shingle", "number", _slices(rows.count()))
    of_class = Window.partitionBy("number")
    ranked = shared.select(
        "number", "shingle", F.row_number().over(of_class.orderBy("holders", "shingle")).alias("k"), F.count(F.lit(1)).over(of_class).alias("shared")
    )
    placed = ranked.join(classes, "number").withColumn("place", F.col("n") - F.col("shared") + F.col("k"))
    postings = materialise(placed.filter(100 * (F.col("place") - 1) <= (100 - percent) * F.col("n")).select("shingle", "set_id", "label", "n", "place"))
    left, right = (postings.select("shingle", *[F.col(c).alias(f"{new}{side}") for c, new in (
        ("set_id", ""), ("label", "l"), ("n", "n"), ("place", "p"))]) for side in "ab")
    left = left.filter((100 + percent) * (F.col("pa") - 1) <= (100 - percent) * F.col("na"))
    na, nb = F.col("na"), F.col("nb")
    smaller = (na < nb) | (na == nb) & (F.col("a") < F.col("b"))
    most = 1 + F.least(na - F.col("pa"), nb - F.col("pb"))  # shared from the first shared shingle on
    possible = (100 * na >= percent * nb) & ((100 + percent) * most >= percent * (na + nb))
    return left.join(right, (left["shingle"] == right["shingle"]) & (F.col("la") != F.col("lb")) & smaller & possible).select("a", "b")


def linked_classes(classes: DataFrame, texts_of, *, words: int, percent: int) -> DataFrame | None:
    """node and root of linked classes, written; null if there is no link.

    `classes` has set_id, n_shingles and bands; `texts_of(ids)` gives set_id and text of given classes.
    """
    all_rows = classes.select("set_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    often = all_rows.groupBy("bucket").count().filter("count > 1").select("bucket")
    members = materialise(all_rows.join(often, "bucket"))
    if members.isEmpty():
        return None
    texts = materialise(texts_of(members.select("set_id").distinct()).withColumn("number", F.monotonically_increasing_id()))

    # Classes with too many shingles of their own are linked with nothing, or with nothing in a bucket.
    n, own = F.col("n"), F.col("own")
    members = members.join(own_shingles(texts, words=words), "set_id").filter(_possible(percent, n, own, n * percent / 100))
    least = members.groupBy("bucket").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    members = materialise(members.join(least.select("bucket", "least"), "bucket").filter(_possible(percent, n, own, F.col("least"))).drop("least"))

    roots, poor, first = None, False, None
    for turn in range(_ROUNDS + 1):
        # A bucket's centre is from its largest component: first the class with the fewest shingles of
        # its own, which is most like an original, later one by hash.
        rank = F.col("own") if turn == 0 else F.lit(0).cast("long")
        rows = _labelled(members, roots)
        groups = rows.groupBy("bucket", "label").agg(
            F.count(F.lit(1)).alias("many"),
            F.min(F.struct(rank.alias("rank"), F.xxhash64("set_id", F.lit(turn)).alias("hash"), "set_id", "n", "own")).alias("best"),
        )
        buckets = groups.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("labels"), F.sum("many").alias("many"), F.sum(F.col("many") * F.col("many")).alias("squares"),
            F.max_by(F.struct("label", "best"), F.struct("many", -F.col("best.rank"), "label")).alias("main"),
        ).filter("labels > 1")
        unsettled = materialise(buckets.select(
            "bucket", F.col("main.label").alias("main"), F.col("main.best.set_id").alias("a"), F.col("main.best.n").alias("na"),
            F.col("main.best.own").alias("owna"), "many", "squares",
        ))
        size = unsettled.agg(F.sum("many"), F.sum((F.col("many") * F.col("many") - F.col("squares")) / 2)).first()
        if not size[0]:
            break
        few = size[1] <= _FEW * size[0]
        last = turn == _ROUNDS or poor or few
        inside = materialise(rows.join(unsettled.drop("many", "squares"), "bucket"))
        members = inside.select("bucket", "set_id", "n", "own")  # only these go on
        if last and not few:
            apart = materialise(inside.groupBy("set_id").agg(F.first("label").alias("label"), F.first("n").alias("n")))
            pairs = prefix_pairs(apart, texts, words=words, percent=percent)
        elif last:
            # every pair of two components that some bucket holds
            apart = materialise(_with_distance(inside.drop("a", "na", "owna"), first))
            left, right = (apart.select("bucket", *[F.col(c).alias(f"{new}{side}") for c, new in (
                ("set_id", ""), ("label", "l"), ("n", "n"), ("own", "own"), ("s", "s"))]) for side in "ab")
            other = (left["bucket"] == right["bucket"]) & (F.col("la") < F.col("lb"))
            pairs = left.join(right, other & _pair_possible(percent) & _distances_allow(percent))
        else:
            outer = inside.filter("label <> main").withColumnsRenamed({"set_id": "b", "n": "nb", "own": "ownb"})
            pairs = outer.filter(_pair_possible(percent))
        pairs = materialise(pairs.select("a", "b").distinct())
        checked = materialise(confirm(pairs, texts.drop("number"), words=words, percent=percent))
        if first is None:
            first = unsettled.select("bucket", F.col("a").alias("c"), F.col("na").alias("nc")), checked
        found = checked.filter("linked").select("a", "b")
        n_found = found.count()
        poor = _POOR * n_found < pairs.count()
        if n_found:
            # what was joined before goes on as stars
            stars = [] if roots is None else [roots.select(F.col("node").alias("a"), F.col("root").alias("b"))]
            roots = components(reduce(DataFrame.unionByName, stars, found))
        if last:
            break
    return roots


def _with_distance(members: DataFrame, first: tuple[DataFrame, DataFrame] | None) -> DataFrame:
    """Add s, the number of shingles in which a member differs from its bucket's first centre, if known."""
    if first is None:
        return members.withColumn("s", F.lit(None).cast("long"))
    centres, checked = first
    known = checked.select(F.col("a").alias("of"), F.col("b").alias("to"), "both")
    rows = members.join(centres, "bucket", "left").join(known, (F.col("c") == F.col("of")) & (F.col("set_id") == F.col("to")), "left")
    s = F.when(F.col("set_id") == F.col("c"), F.lit(0)).otherwise(F.col("n") + F.col("nc") - 2 * F.col("both"))
    return rows.withColumn("s", s.cast("long")).drop("c", "nc", "of", "to", "both")


def _distances_allow(percent: int) -> Column:
    """Whether two sets can be linked, from what sets them apart from one centre.

    x and y differ in s(x) + s(y) - 2 o shingles, where o counts differences from the centre that both
    have. What only x has is among its differences and is not shared: o <= s(x) - own(x), likewise y.
    """
    sa, sb = F.col("sa"), F.col("sb")
    least = (100 + percent) * (sa + sb) - (100 - percent) * (F.col("na") + F.col("nb"))
    return F.coalesce(least <= 2 * (100 + percent) * F.least(sa - F.col("owna"), sb - F.col("ownb")), F.lit(True))


def _pair_possible(percent: int) -> Column:
    na, nb = F.col("na"), F.col("nb")
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return sizes & _possible(percent, na, F.col("owna"), nb) & _possible(percent, nb, F.col("ownb"), na)


def _found(docs: DataFrame, *, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and first_hash, the text hash of the component's first document."""
    spark = docs.sparkSession
    with Scope(spark) as scope:
        rows = scope.keep(materialise(sketches(docs, words=words, percent=percent)))
        classes = materialise(rows.filter("n_shingles > 0").groupBy("set_id").agg(
            F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one"),
        ))

        def texts_of(ids: DataFrame) -> DataFrame:
            # the text of each class's first document
            one = classes.join(ids, "set_id").select("set_id", F.col("one.doc_id").alias("doc_id"), F.col("one.text_hash").alias("one_hash"))
            one = one.select("set_id", "one_hash", _key().alias("one_key"))
            given = docs.select(_key().alias("key"), F.xxhash64(text_of()).alias("hash"), "text")
            found = given.hint("merge").join(one, (F.col("key") == F.col("one_key")) & (F.col("hash") == F.col("one_hash"))).select("set_id", "text")
            repeated = not rows.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty()
            return found.dropDuplicates(["set_id"]) if repeated else found

        roots = linked_classes(classes, texts_of, words=words, percent=percent)
        named = _labelled(classes.select("set_id", "one"), roots)
        least = named.groupBy("label").agg(F.min("one").alias("first"))
        slices = _slices(rows.count())
        ids = scope.keep(materialise(join_unique(named, least, "label", "set_id", slices).select(
            "set_id", F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("first_hash")
        )))
    narrow = rows.drop("bands")
    found = join_unique(narrow.filter("n_shingles > 0").withColumn("row", F.struct("doc_id", "text_hash")), ids, "set_id", "row", slices)
    empty = narrow.filter("n_shingles = 0").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("first_hash")
    )
    return found.select(*empty.columns).unionByName(empty)


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept per document.

    Documents are linked if 100 * |both| >= percent * |either|; the least id of a component is kept.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return _found(docs, words=words, percent=percent).drop("first_hash").withColumn("kept", kept)


def keep_first(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each component one row stays, the first by id and text hash."""
    found = _found(docs, words=words, percent=percent)
    stays = (F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    gone = found.filter(~stays).select(_key().alias("gone_key"), F.col("text_hash").alias("gone_hash"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _key().alias("key"), F.xxhash64(text_of()).alias("hash")
    )
    left = rows.hint("merge").join(gone, (F.col("key") == F.col("gone_key")) & (F.col("hash") == F.col("gone_hash")), "left_anti")
    firsts = found.filter(stays & (F.col("n_shingles") > 0)).select(_key().alias("twice_key"), F.col("text_hash").alias("twice_hash"))
    twice = materialise(firsts.groupBy("twice_key", "twice_hash").count().filter("count > 1").drop("count"))
    if twice.isEmpty():
        return left.select("row.*")
    same = (F.col("key") == F.col("twice_key")) & (F.col("hash") == F.col("twice_hash"))
    once = left.join(twice, same, "left_semi").groupBy("key", "hash").agg(F.first("row").alias("row"))
    return left.join(twice, same, "left_anti").select("row").unionByName(once.select("row")).select("row.*")
