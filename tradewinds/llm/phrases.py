"""Phrase collocations by set-oriented mining (SETM) of persisted, sorted occurrence relations.

Occurrences of words, sorted by place, are written once: places count the words of a block of texts, and
a piece ends with a gap, so two words are neighbours in a piece just if their places are. Length by
length, the occurrences of frequent phrases are merge-joined with those at the next place, the longer
phrases are grouped and counted, and the relation is semi-joined with the frequent groups and written
again, without the words that are in none of them.

Groups are first counted by a 64-bit hash and the semi-join tests a bit map of the frequent hashes, of
at most `_MOST_BITS` bits however many there are. Both can only let through too much: the phrases of the
relation are then counted by their words, which is exact, and only those that are frequent come out.

Defined cases: a null text is empty; a null language is `und`, together with a language of that name;
words are lower-cased in A-Z only; repeated rows count as often as they occur; an empty table, and one
without a frequent phrase, give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from tradewinds.llm.common import LOWER, UPPER, ship_package
from tradewinds.operators.materialise import discard, materialise

# A row holds a block's words, one a line, and, packed, per occurrence: the gap before its place, its word's
# number (both 32 bits) and whether a frequent phrase begins there (8 bits).
RELATION = "lang string, n long, words binary, gaps binary, ids binary, starts binary"
_ARROW = pa.schema([("lang", pa.string()), ("n", pa.int64()), *[(name, pa.binary()) for name in ("words", "gaps", "ids", "starts")]])
_BLOCK_BYTES = 1 << 20  # text in one row of the first relation, but for a longer text
_MOST_KEYS = 1 << 19  # keys that a task holds before it counts them
_BATCH_ROWS = 1 << 16  # counted keys or phrases that are handed to Spark at once
_LEAST_BITS, _MOST_BITS = 16, 27  # logarithm of the size of the bit map: 16 MB at most
_SLICES = 64  # of a language's phrases, ranked apart before they are ranked together
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"  # fixed: ends of pieces
_PLAIN = bytes.maketrans(UPPER.encode() + _BREAKS + b"\t", LOWER.encode() + b"\n" * len(_BREAKS) + b" ")

Batches = Iterator[pa.RecordBatch]


# ---- the relation -------------------------------------------------------------------------------

def _block(lang: str, texts: list[bytes]) -> pa.RecordBatch:
    """Words of the texts by place; each text ends its last piece."""
    marked = b"\n".join(texts).translate(_PLAIN).replace(b"\n", b" \n ")
    coded = pc.split_pattern(pa.array([marked], pa.large_binary()), b" ").flatten().dictionary_encode()
    numbers, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    special = np.array([word in (b"", b"\n") for word in words], dtype=bool)
    blank = words.index(b"") if b"" in words else -1
    numbers = numbers[numbers != blank]
    places = np.flatnonzero(~special[numbers]) if len(numbers) else np.zeros(0, dtype=np.int64)
    new = np.cumsum(~special) - 1
    ids = new[numbers[places]]
    return _row(lang, len(ids), [w for w, s in zip(words, special) if not s], places, ids, np.ones(len(ids)))


def _row(lang: str, n: int, words: list[bytes], places: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    gaps = np.diff(places, prepend=-1) - 1
    packed = [b"\n".join(words), *[values.astype(kind).tobytes() for values, kind in ((gaps, "<i4"), (ids, "<i4"), (starts, "u1"))]]
    return pa.RecordBatch.from_arrays([pa.array([value], field.type) for value, field in zip([lang, n, *packed], _ARROW)], schema=_ARROW)


def _occurrences(batches: Batches) -> Batches:
    """The relation of single words from (lang, text): one row per language and block of texts."""
    waiting: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                waiting.setdefault(lang, []).append(text)
                size += len(text)
            if size >= _BLOCK_BYTES:
                yield from (_block(lang, texts) for lang, texts in waiting.items())
                waiting, size = {}, 0
    yield from (_block(lang, texts) for lang, texts in waiting.items())


class _Block:
    """A row of the relation: places and word numbers, and which places begin a frequent phrase."""

    def __init__(self, row: dict, at: int):
        def values(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(row[name][at].as_buffer(), dtype=kind)

        self.lang, self.n = row["lang"][at].as_py(), row["n"][at].as_py()
        self.words = row["words"][at].as_py().split(b"\n")
        self.ids, self.starts = values("ids", "<i4"), values("starts", "u1")
        self.places = np.cumsum(values("gaps", "<i4"), dtype=np.int64) + np.arange(len(self.ids))

    def longer(self, size: int) -> np.ndarray:
        """Where phrases of `size` words may begin: merge join of the frequent ones at a place and at the next."""
        first = np.flatnonzero(self.starts)
        if size == 1 or len(first) == 0:
            return first
        places = self.places[first]
        after = np.searchsorted(places, places + 1)
        joined = places[np.minimum(after, len(places) - 1)] == places + 1
        return first[joined]

    def keys(self, at: np.ndarray, size: int) -> np.ndarray:
        """64-bit hashes of the language and the words of each phrase."""
        of_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words), dtype=np.uint64, count=len(self.words))
        key = np.full(len(at), xxhash.xxh64_intdigest(self.lang), dtype=np.uint64)
        for k in range(size):
            key = (key ^ of_word[self.ids[at + k]]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key * np.uint64(0xBF58476D1CE4E5B9)

    def phrases(self, at: np.ndarray, size: int) -> tuple[pa.Array, np.ndarray]:
        """Distinct phrases that begin there, by their words, and how often."""
        group = self.ids[at].astype(np.int64)
        for k in range(1, size):  # dense numbers, so pairs of them fit into 64 bits
            _, group = np.unique(group, return_inverse=True)
            group = group * len(self.words) + self.ids[at + k]
        _, first, counts = np.unique(group, return_index=True, return_counts=True)
        words = pa.array(self.words, pa.binary())
        return pc.binary_join_element_wise(*[words.take(pa.array(self.ids[at[first] + k])) for k in range(size)], b" "), counts

    def kept(self, at: np.ndarray, size: int) -> pa.RecordBatch:
        """The row with only the words of the phrases that begin there."""
        used = np.zeros(len(self.ids) + 1, dtype=np.int64)
        np.add.at(used, at, 1)
        np.add.at(used, at + size, -1)
        alive = np.flatnonzero(np.cumsum(used)[:-1])
        starts = np.zeros(len(self.ids))
        starts[at] = 1
        of_word, ids = np.unique(self.ids[alive], return_inverse=True)
        return _row(self.lang, self.n, [self.words[i] for i in of_word], self.places[alive], ids, starts[alive])


def _blocks(batches: Batches) -> Iterator[_Block]:
    for batch in batches:
        row = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        yield from (_Block(row, at) for at in range(batch.num_rows))


# ---- one length ---------------------------------------------------------------------------------

def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(sums, place, np.concatenate(counts))
    return distinct, sums


def _in_batches(rows: pa.RecordBatch) -> Batches:
    for begin in range(0, rows.num_rows, _BATCH_ROWS):
        yield rows.slice(begin, _BATCH_ROWS)


def _group_counts(size: int) -> Callable[[Batches], Batches]:
    """(key, n) of the phrases of `size` words, added up within a task as far as its memory goes."""
    def run(batches: Batches) -> Batches:
        keys, counts, held = [], [], 0

        def out() -> pa.RecordBatch:
            distinct, sums = _summed(keys, counts)
            return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(sums)], ["key", "n"])

        for block in _blocks(batches):
            distinct, n = np.unique(block.keys(block.longer(size), size), return_counts=True)
            keys.append(distinct)
            counts.append(n.astype(np.int64))
            held += len(distinct)
            if held > _MOST_KEYS:
                yield from _in_batches(out())
                keys, counts, held = [], [], 0
        if held:
            yield from _in_batches(out())

    return run


def _semi_join(size: int, bits: Broadcast) -> Callable[[Batches], Batches]:
    """The relation without what is in no frequent group of `size` words."""
    def run(batches: Batches) -> Batches:
        log_bits, words = bits.value
        for block in _blocks(batches):
            at = block.longer(size)
            slot = block.keys(at, size) >> np.uint64(64 - log_bits)
            frequent = (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
            at = at[frequent == 1]
            if len(at):
                yield block.kept(at, size)

    return run


def _phrase_counts(size: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for block in _blocks(batches):
            phrases, n = block.phrases(np.flatnonzero(block.starts), size)
            yield from _in_batches(pa.RecordBatch.from_arrays(
                [pa.array([block.lang] * len(phrases), pa.string()), phrases, pa.array(n.astype(np.int64))],
                ["lang", "phrase", "n"],
            ))

    return run


def _bit_map(groups: DataFrame) -> tuple[int, np.ndarray]:
    """Bit map over the leading bits of the keys: at least 16 bits a key while that is below the largest size."""
    log_bits = min(max(_LEAST_BITS, (16 * groups.count()).bit_length()), _MOST_BITS)
    slot = F.shiftrightunsigned("key", 64 - log_bits)
    rows = groups.groupBy(F.shiftright(slot, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(key, {64 - log_bits}) & 63 AS INT))")).alias("bits")
    ).toArrow()  # at most 2 ** (_MOST_BITS - 6) rows
    words = np.zeros(1 << (log_bits - 6), dtype=np.uint64)
    words[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return log_bits, words


def frequent_phrases(docs: DataFrame, *, longest: int = 4, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of up to `longest` words found at least `least` times in a
    language, and (lang, n) with the number of all words.

    The shuffles of one count at a time lie on the disks.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    relation = materialise(texts.mapInArrow(_occurrences, RELATION))
    totals = materialise(relation.groupBy("lang").agg(F.sum("n").alias("n")), lean=True)
    counts = None
    for size in range(1, longest + 1):
        groups = relation.mapInArrow(_group_counts(size), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        keys = materialise(groups.filter(F.col("n") >= least).select("key"), lean=True)
        bits = spark.sparkContext.broadcast(_bit_map(keys))
        shorter, relation = relation, materialise(relation.mapInArrow(_semi_join(size, bits), RELATION))
        for done in (shorter, keys):
            discard(done)
        found = relation.mapInArrow(_phrase_counts(size), "lang string, phrase binary, n long")
        exact = found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        of_size = materialise(exact.select("lang", F.col("phrase").cast("string").alias("phrase"), F.lit(size).alias("size"), "n"), lean=True)
        counts = of_size if counts is None else counts.unionByName(of_size)
    discard(relation)
    return counts, totals


# ---- scores -------------------------------------------------------------------------------------

def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, score of phrases of two words or more: the lowest-scoring cut, the first of equals.

    Both parts of a frequent phrase are frequent, so every cut finds its counts.
    """
    words = F.split("phrase", " ")
    cuts = counts.filter("size > 1").select(
        "lang", "phrase", "size", F.col("n").alias("a"), words.alias("words"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"),
    ).select(
        "lang", "phrase", "size", "a", "cut",
        F.array_join(F.slice("words", 1, F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("right"),
    )
    parts = counts.select("lang", "phrase", "n")
    sided = cuts.join(
        parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]
    ).join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    score = F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 div (CAST(l AS DECIMAL(20, 0)) + r)")
    lowest = sided.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("low")
    )
    return lowest.select("lang", "phrase", "size", "a", "low.l", "low.r", "low.score")


def not_inside_longer(phrases: DataFrame, counts: DataFrame, *, percent: int = 80) -> DataFrame:
    """Phrases without those that lie inside a longer frequent one with at least `percent` of their count."""
    inner = counts.filter("size > 2").select("lang", "n", "size", F.split("phrase", " ").alias("words")).select(
        "lang", "n", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("inner_size"),
    ).select(
        "lang", "n", "words", "inner_size", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner_size") + 1)).alias("at")
    )
    covered = inner.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("inner_size")), " ").alias("phrase")).agg(
        F.max("n").alias("longer")
    )
    wide = "DECIMAL(25, 0)"
    inside = F.expr(f"100 * CAST(longer AS {wide}) >= {percent} * CAST(a AS {wide})")
    return phrases.join(covered, ["lang", "phrase"], "left").filter(~F.coalesce(inside, F.lit(False))).drop("longer")


def collocations(docs: DataFrame, *, longest: int = 4, least: int = 30, percent: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases by score, count and phrase."""
    counts, totals = frequent_phrases(docs, longest=longest, least=least)
    kept = not_inside_longer(scored(counts), counts, percent=percent)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = kept
    for by in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(_SLICES))], ["lang"]):  # a large language is cut down in slices first
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
