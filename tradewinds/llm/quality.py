"""Quality rules: base counts, and divergence of a document's histograms from language references.

References are made from the whole table: for each value of `lang`, the shares of character classes
and of its most common words. A document is held against the nearest reference, by the Jensen-Shannon
distance (square root of the divergence in bits, 0 to 1). It fails if its character classes or its
common words are too far from every language. Short documents are not judged by histograms.

Everything of a document is computed in its own row, so no text is shuffled; texts are read twice.

Defined cases: a null text has no words and fails the base rules; null labels make no reference, and
without any reference only the base rules count; repeated rows are judged each; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewinds.llm.common import WordTable, literal_array, text_of, words_of
from tradewinds.operators.materialise import materialise

#: What is left of a text when all but one class of characters is removed.
CLASSES = {
    "lower": r"[^a-z]+", "upper": r"[^A-Z]+", "digit": r"[^0-9]+", "space": r"[^\x20\x09-\x0D]+",
    "stop": r"[^.,;:!?'\"()\-]+", "other": r"[\x00-\x7F]+",
}
SYMBOLS = r"[^#*$%&|<>]+"
_WINDOW = 8  # a power of two
_MAX_LANGUAGES = 200


@dataclass(frozen=True)
class Limits:
    """Greatest distances, and the least characters and words at which they count.

    The distance of words is a share of that of a text without any of the common words.
    """

    classes: float = 0.33
    words: float = 0.97
    least_chars: int = 200
    least_words: int = 100


@dataclass(frozen=True)
class References:
    """By language: shares of the character classes, the rest last, and of its common words."""

    classes: list[list[float]]
    words: list[dict[str, float]]


def common_words(docs: DataFrame, *, common: int = 40) -> dict[str, dict[str, float]]:
    """By language label, the shares of its most common words; at most `common` for each of 200 languages.

    Of more languages, those with most words make references, ties by code point.
    """
    labelled = docs.filter("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    counts = materialise(labelled.select("lang", F.explode(words_of(F.lower("text"))).alias("word")).groupBy("lang", "word").count())
    totals = counts.groupBy("lang").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "lang").limit(_MAX_LANGUAGES)
    whole = {r["lang"]: r["n"] for r in totals.collect()}
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    known = counts.filter(F.col("lang").isin(*whole))
    top = known.filter(~F.col("word").contains(",")).select("*", place.alias("place")).filter(F.col("place") <= common)
    words: dict[str, dict[str, float]] = {}
    for r in sorted(top.collect()):
        words.setdefault(r["lang"], {})[r["word"]] = r["count"] / whole[r["lang"]]
    return words


def references(rows: DataFrame, words: dict[str, dict[str, float]]) -> References:
    """Class shares by language of measured rows, together with its common words."""
    sums = rows.filter(F.col("lang").isin(*words)).groupBy("lang").agg(
        F.sum("chars").alias("all"), *[F.sum(F.col("classes")[i]).alias(f"n{i}") for i in range(len(CLASSES))]
    ).collect()  # one row a language
    kept = sorted((r for r in sums if r["all"] and r["lang"] in words), key=lambda r: r["lang"])
    shares = [[r[f"n{i}"] / r["all"] for i in range(len(CLASSES))] for r in kept]
    return References([[*s, max(0.0, 1 - sum(s))] for s in shares], [words[r["lang"]] for r in kept])


def _part(p: Column, q: Column) -> Column:
    """p log2(p / m) / 2 with m the mean of both; 0 for p = 0."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q)) / 2).otherwise(F.lit(0.0))


def _terms(p: Column, q: Column) -> Column:
    return _part(p, q) + _part(q, p)


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), divergence)))


def _rest_part(q: float) -> float:
    """q log2(2q / (1 + q)): what all other words of a reference add for a text of other words only."""
    return q * math.log2(2 * q / (1 + q)) if q > 0 else 0.0


def _with_next(hashes: Column, step: int) -> Column:
    """Hash of each item and the one `step` places after it; null if there is none. `hashes` must be a column of the frame."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.when(n >= 1, F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b)))


def _repeated(pair: Column, j: Column) -> Column:
    """Whether a neighbour in the sorted column `_pairs` has the same hash."""
    same = [F.coalesce(F.get(F.col("_pairs"), k)["x"] == pair["x"], F.lit(False)) for k in (j - 1, j + 1)]
    return same[0] | same[1]


def measure(docs: DataFrame, listed: list[str]) -> DataFrame:
    """Base counts, class counts and shares of the listed words (numbered from 1) of each document."""
    table = WordTable(listed)
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), text_of().alias("_text"))
    rows = rows.withColumn("_words", words_of(F.col("_text")))
    rows = rows.withColumn("_windows", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in [1 << k for k in range(_WINDOW.bit_length() - 1)]:  # windows of 2, 4 and 8 words
        rows = rows.withColumn("_windows", _with_next(F.col("_windows"), step))
    rows = rows.withColumn("_slots", F.transform("_words", lambda w: table.slot(F.lower(w))))
    rows = rows.withColumn("_unlike", F.regexp_replace("_text", "[a-z]+", ""))  # a short text for the other counts
    chars, left = F.length("_text"), lambda rest: F.length(F.regexp_replace("_unlike", rest, ""))
    numbers = F.zip_with("_words", "_slots", lambda w, slot: table.number_in(slot, F.lower(w)))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "lang", chars.alias("chars"), F.size("_words").alias("_n"), left(SYMBOLS).alias("_symbols"), lines.alias("_lines"), "_windows",
        F.array(*[chars - F.length("_unlike") if name == "lower" else left(rest) for name, rest in CLASSES.items()]).alias("classes"),
        F.sort_array(F.filter(numbers, lambda x: x > 0)).alias("_common"),
    )
    rows = rows.withColumn("_word_chars", F.col("chars") - F.col("classes")[list(CLASSES).index("space")])
    several = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("_pairs", F.when(several, pairs)).drop("_windows")
    places = F.sort_array(F.transform(F.filter("_pairs", _repeated), lambda pair: pair["i"]))
    rows = rows.withColumn("_places", places).drop("_pairs")
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size("_places") - 1), F.lit(0),
        lambda total, j: total + F.least(F.lit(_WINDOW), F.coalesce(F.get(F.col("_places"), j + 1) - F.get(F.col("_places"), j), F.lit(_WINDOW))),
    )
    # sorted numbers of common words, and the places at which a new number begins
    begins = F.filter(
        F.transform("_common", lambda x, i: F.struct(x.alias("x"), i.alias("i"), F.get(F.col("_common"), i - 1).alias("before"))),
        lambda s: s["before"].isNull() | (s["before"] != s["x"]),
    )
    rows = rows.withColumn("_begins", begins)
    runs = F.transform("_begins", lambda s, j: F.struct(
        s["x"].alias("x"),
        ((F.coalesce(F.get(F.col("_begins"), j + 1)["i"], F.size("_common")) - s["i"]) / F.col("_n")).alias("p"),
    ))
    return rows.select(
        "doc_id", "lang", F.col("_n").cast("bigint").alias("n_words"), F.col("_word_chars").cast("bigint").alias("word_chars"),
        F.col("_symbols").cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("_places") > 0, covered).otherwise(0).cast("bigint").alias("n_repeat_words"), "chars", "classes", runs.alias("runs"),
    )


def judge(rows: DataFrame, listed: list[str], known: References, limits: Limits = Limits()) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, class_distance, word_distance and kept, of measured rows."""
    shares = [[words.get(word, 0.0) for word in listed] for words in known.words]
    n, chars = F.col("n_words"), F.col("chars")
    rows = rows.withColumn("_rest", chars - F.aggregate("classes", F.lit(0), lambda a, b: a + b))
    class_distance = word_distance = F.lit(None).cast("double")
    if known.classes:
        parts = [F.col("classes")[i] / chars for i in range(len(CLASSES))] + [F.col("_rest") / chars]
        far = [_distance(sum((_terms(p, F.lit(q)) for p, q in zip(parts, shares_of)), F.lit(0.0))) for shares_of in known.classes]
        class_distance = F.when(chars > 0, F.least(*far) if len(far) > 1 else far[0])
        far = []
        for share in shares:
            q = literal_array(share, "double")
            # words of the document, common words it lacks (q / 2 each), and all other words as one
            pair = F.aggregate(
                "runs", F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q")),
                lambda a, r: F.struct(
                    (a["d"] + _terms(F.when(F.get(q, r["x"] - 1) > 0, r["p"]).otherwise(F.lit(0.0)), F.get(q, r["x"] - 1))).alias("d"),
                    (a["p"] + F.when(F.get(q, r["x"] - 1) > 0, r["p"]).otherwise(F.lit(0.0))).alias("p"),
                    (a["q"] + F.get(q, r["x"] - 1)).alias("q"),
                ),
                lambda a: a["d"] + (F.lit(sum(share)) - a["q"]) / 2 + _terms(F.greatest(F.lit(0.0), 1 - a["p"]), F.lit(max(0.0, 1 - sum(share)))),
            )
            lacking = sum(share) / 2 + (1 - math.log2(2 - sum(share)) + _rest_part(1 - sum(share))) / 2
            far.append(_distance(pair) / math.sqrt(lacking) if lacking > 0 else F.lit(0.0))
        word_distance = F.when(n > 0, F.least(*far) if len(far) > 1 else far[0])
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars",
        ((n < 20) | (100 * F.col("n_repeat_words") > 30 * n)).alias("base_failed"),
        class_distance.alias("class_distance"), word_distance.alias("word_distance"),
    )
    odd = (
        (F.col("chars") >= limits.least_chars) & (F.col("class_distance") > limits.classes)
        | (F.col("n_words") >= limits.least_words) & (F.col("word_distance") > limits.words)
    )
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False))).drop("chars")


def assess(docs: DataFrame, *, common: int = 40, limits: Limits = Limits()) -> DataFrame:
    """Common words are counted first, then every document is measured once, and judged on narrow rows."""
    words = common_words(docs, common=common)
    listed = sorted({word for shares in words.values() for word in shares})
    rows = materialise(measure(docs, listed))
    return judge(rows, listed, references(rows, words), limits)
