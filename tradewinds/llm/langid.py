"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every run of other characters is one space, and n-grams of one to three
characters are hashed to a fixed number of buckets. Training sums n-gram counts by language in Spark;
the matrix of log-probabilities (languages x buckets, bounded) is broadcast. A document is a sparse
count vector that is multiplied with it, whole, in blocks.

The posterior says which learned language is nearest, not whether a text is in any. Whether it is, is
told from its mean log-probability per n-gram in that language: texts the model was learned from show,
each scored without its own counts, what is usual. A text fits unless it is below their 1% quantile by
more than half a nat and an allowance for short texts.

Defined cases: a null text or one without a letter is `und` with score 0; so is every text if nothing
could be learned; equal scores go to the first language by code point; a null label is not learned
from; repeated rows are predicted each; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tradewinds.llm.common import ship_package

UNKNOWN = "und"
_BLOCK = 1 << 20  # characters counted at once
_MAX_CELLS = 1 << 23  # languages x buckets that are broadcast
_LEAST_BUCKETS = 1 << 12
_LOW, _FAR, _SHORT = 0.01, 0.5, 6.0  # quantile, nats below it, and standard errors of n-grams taken singly


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point the lower-case letter, or a space."""
    table = np.full(sys.maxunicode + 1, 32, dtype=np.uint32)
    for code in range(sys.maxunicode + 1):
        letter = chr(code)
        if letter.isalpha():
            low = letter.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def gram_counts(text: str | None, buckets: int) -> np.ndarray | None:
    """Counts of the hashed 1- to 3-grams, or null without a letter."""
    if not text:
        return None
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    counts = np.zeros(buckets, dtype=np.int64)
    seen = False
    tail = np.array([32, 32], dtype=np.uint32)
    for start in range(0, len(text) + 2, _BLOCK):
        block = text[start:start + _BLOCK]
        codes = _letters()[np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        if start + _BLOCK >= len(text) + 2 or not block:
            codes = np.append(codes, np.array([32, 32], dtype=np.uint32))
        # a run of spaces is one space
        joined = np.concatenate([tail, codes])
        keep = (joined[2:] != 32) | (joined[1:-1] != 32)
        codes = codes[keep]
        if not len(codes):
            continue
        joined = np.concatenate([tail, codes])
        seen = seen or bool((codes != 32).any())
        one, two, three = joined[2:], joined[1:-1], joined[:-2]
        first = one * np.uint32(2654435761)
        second = (first ^ (two * np.uint32(2246822519))) * np.uint32(3266489917)
        third = (second ^ (three * np.uint32(668265263))) * np.uint32(374761393)
        letter = one != 32
        counts += np.bincount(first[letter] >> shift, minlength=buckets)
        counts += np.bincount(second[letter | (two != 32)] >> shift, minlength=buckets)
        counts += np.bincount(third[letter | (two != 32)] >> shift, minlength=buckets)
        tail = joined[-2:]
    return counts if seen else None


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages
    least_mean: np.ndarray | None = None  # by language; without it every text fits
    spread: np.ndarray | None = None  # standard deviation of an n-gram's log-probability, by language

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """The nearest language, its posterior, and whether the text fits what texts in it show."""
        counts = gram_counts(text, len(self.log_probability))
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, False
        used = np.flatnonzero(counts)
        score = counts[used] @ self.log_probability[used]
        best = int(np.argmax(score))
        fits = True
        if self.least_mean is not None:
            n = counts.sum()
            fits = bool(score[best] / n >= self.least_mean[best] - _SHORT * self.spread[best] / np.sqrt(n))
        return self.languages[best], float(1.0 / np.exp(score - score[best]).sum()), fits

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]


def remainder(buckets: int = 5) -> Column:
    """CRC-32 of the id as text, modulo `buckets`; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % buckets


def train(
    labelled: DataFrame, *, buckets: int = 1 << 15, documents_a_language: int = 5_000, smoothing: float = 0.1, fit: bool = False
) -> Model:
    """Fit on rows (doc_id, text, lang); with `fit` the model also tells what texts of a language show.

    `documents_a_language` bounds the fit: of a language with more labelled documents, that many are
    expected to be drawn, by a hash of id and text. With more than 256 languages the buckets are halved until
    the matrix fits, down to 4,096; of more than 2,048 languages those with most labelled texts are learned,
    ties by code point.
    """
    rows = labelled.filter("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)).alias("draw")
    )
    most = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(_MAX_CELLS // _LEAST_BUCKETS).collect()
    sizes = {r["lang"]: r["count"] for r in most}
    languages = sorted(sizes)
    while len(languages) * buckets > _MAX_CELLS:
        buckets //= 2
    if not languages:
        return Model([], np.zeros((buckets, 0)))
    number = {language: i for i, language in enumerate(languages)}
    many = {n: -(-(documents_a_language << 20) // s) for n, s in sizes.items() if s > documents_a_language}
    drawn = rows.select("lang", "text", "draw")
    if many:
        limits = F.create_map(*[F.lit(x) for item in many.items() for x in item])
        drawn = drawn.filter(F.col("draw") < F.coalesce(limits[F.col("lang")], F.lit(1 << 20)))
    drawn = drawn.select("lang", "text")

    ship_package(labelled.sparkSession)

    def summed(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = gram_counts(text, buckets) if language in number else None
                if counts is not None:
                    n = number[language]
                    sums[n] = sums[n] + counts if n in sums else counts
        for n, counts in sums.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), n)), pa.array(used), pa.array(counts[used])], names=["language", "bucket", "n"]
            )

    table = drawn.mapInArrow(summed, "language long, bucket long, n long").groupBy("language", "bucket").agg(
        F.sum("n").alias("n")
    ).toArrow()  # at most languages x buckets rows
    counts = np.full((buckets, len(languages)), smoothing)
    bucket, language, n = (table.column(name).to_numpy() for name in ("bucket", "language", "n"))
    counts[bucket, language] += n
    learned = sorted(set(language.tolist()))  # languages with a letter in some text
    counts = counts[:, learned]
    if not learned:
        return Model([], np.zeros((buckets, 0)))
    share = counts / counts.sum(axis=0)
    model = Model([languages[i] for i in learned], np.log(share))
    if not fit:
        return model
    shared = labelled.sparkSession.sparkContext.broadcast(counts)
    column = {languages[i]: k for k, i in enumerate(learned)}

    def means(batches):
        totals = shared.value.sum(axis=0)
        for batch in batches:
            names, found = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = gram_counts(text, buckets) if name in column else None
                if own is not None:
                    used, k, n = np.flatnonzero(own), column[name], own.sum()
                    rest = np.maximum(shared.value[used, k] - own[used], smoothing) / (totals[k] - n)
                    names.append(k)
                    found.append(float(own[used] @ np.log(rest) / n))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(found, pa.float64())], names=["language", "mean"])

    usual = drawn.mapInArrow(means, "language long, mean double").groupBy("language").agg(
        F.percentile("mean", F.lit(_LOW)).alias("low")
    ).collect()  # one row a language
    least = np.zeros(len(learned))
    for r in usual:
        least[r["language"]] = r["low"] - _FAR
    average = (share * model.log_probability).sum(axis=0)
    spread = np.sqrt((share * (model.log_probability - average) ** 2).sum(axis=0))
    return Model(model.languages, model.log_probability, least, spread)


def predictor(docs: DataFrame, model: Model):
    """Column function: text -> struct(lang_pred, score, fits)."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, fits boolean")
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.judge(text) for text in texts.to_pylist()]
        columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
        return pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "fits"])

    return predict


def identify(docs: DataFrame, *, folds: int = 5, **settings) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learned from the labelled rows that are not held out.

    A document is held out if its id's CRC-32 leaves remainder 0; a null id is neither held out nor
    learned from.
    """
    model = train(docs.filter(remainder(folds) != 0), **settings)
    guess = predictor(docs, model)(F.col("text"))
    held = F.coalesce(remainder(folds) == 0, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), guess.alias("guess")).select("doc_id", "held_out", "guess.lang_pred", "guess.score")


def keep_identified(docs: DataFrame, *, least_score: float = 0.5, folds: int = 5, **settings) -> DataFrame:
    """Documents with a language: those that are `und`, score less than `least_score` or fit no language go."""
    model = train(docs.filter(remainder(folds) != 0), fit=True, **settings)
    guess = predictor(docs, model)(F.col("text"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), guess.alias("guess"))
    return rows.filter((F.col("guess.lang_pred") != UNKNOWN) & (F.col("guess.score") >= least_score) & F.col("guess.fits")).select("row.*")
