"""I-Match fingerprints over several randomised lexicon subsets.

The lexicon is all terms whose document frequency lies in a band: in at least `least` distinct texts
and in at most `most` of all distinct texts, so that copies do not take their own terms out of it.
Frequencies are counted over the whole table by hash bucket, a fixed number of buckets, so the lexicon
is a bit map of fixed size at any scale. A second hash deals the lexicon
into disjoint random subsets of falling size. The distinct terms of a document are sorted, and the
terms of each subset are hashed together: one cell per subset that is not empty. A fingerprint is the
list of cells. Dense subsets change with any edit and sparse ones survive large edits, so two
fingerprints are compared on the subsets that are sparse for texts of their size: the share of equal
cells among those that either has.

Defined cases: a null text is empty, and only empty texts have the empty fingerprint; a text without a
lexicon term has cells of all its terms, and one without any term that of its whole text; an edited
text is compared over all terms if it or its original has no lexicon term and the other has; equal
fingerprints have likeness 1, also empty ones; rows that repeat id and text are one document and get one result each; a null id
comes first; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tradewinds.llm.common import literal_array, text_of
from tradewinds.operators.materialise import materialise
from tradewinds.operators.ordered import positions

TERM = r"[\p{L}\p{N}]+"
_BUCKET_BITS = 20
_LEVELS, _EACH = 20, 8  # subsets above 127 are negative in the top byte of keys and cells
_CELL_BITS = 24


@dataclass(frozen=True)
class Lexicon:
    """Bit map of the hash buckets whose terms are kept, 32 to a number."""

    bits: list[int]

    def has(self, term: Column) -> Column:
        bucket = _bucket(term)
        word = F.get(literal_array(self.bits, "bigint"), F.shiftright(bucket, 5).cast("int"))
        return F.getbit(word, bucket.bitwiseAND(F.lit(31)).cast("int")) == 1


def _bucket(term: Column) -> Column:
    return term.bitwiseAND(F.lit((1 << _BUCKET_BITS) - 1))


def terms_of(text: Column) -> Column:
    """Hashes of the distinct terms."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), lambda t: F.xxhash64(t)))


def _bit_map(buckets: DataFrame) -> Lexicon:
    words = buckets.groupBy(F.shiftright("bucket", 5).alias("word")).agg(
        F.sum(F.expr("shiftleft(1L, cast(bucket & 31 as int))")).alias("bits")
    ).collect()  # at most 2 ** 15 rows
    found = {r["word"]: r["bits"] for r in words}
    return Lexicon([found.get(i, 0) for i in range(1 << (_BUCKET_BITS - 5))])


def lexicon(docs: DataFrame, *, least: int = 2, most: float = 0.05) -> Lexicon:
    """Terms in at least `least` distinct texts and at most the share `most` of them, counted over all rows.

    Rows are counted first. That decides for all buckets but those in more rows than the limit, which
    copies may have lifted above it; only these few are listed by text and counted once for each.
    """
    rows = docs.select(F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    texts = rows.select("text_hash").distinct().count()
    limit = max(least, int(most * texts))
    buckets = rows.select("text_hash", F.array_distinct(F.transform(terms_of(F.col("text")), _bucket)).alias("buckets"))
    seen = materialise(buckets.select("text_hash", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), (F.min("text_hash") != F.max("text_hash")).alias("several")
    ).filter(F.col("several") | F.lit(least < 2)))
    # in one text, in several, or in more than two: the last is not known from `several`
    unsure = (F.col("rows") > limit) | F.lit(least > 2)
    sure = _bit_map(seen.filter(~unsure))
    asked = _bit_map(seen.filter(unsure))
    if not any(asked.bits):
        return sure
    once = buckets.select("text_hash", F.filter("buckets", asked.has).alias("buckets")).groupBy("text_hash").agg(F.first("buckets").alias("buckets"))
    counted = once.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count().filter(F.col("count").between(least, limit))
    return Lexicon([a | b for a, b in zip(sure.bits, _bit_map(counted).bits)])


def _subsets(terms: Column) -> Column:
    """Terms, each below the number of its subset, sorted."""

    def key(term: Column) -> Column:
        spread = F.xxhash64(term)
        low = F.shiftrightunsigned(spread, 8)
        level = F.least(F.lit(_LEVELS - 1), F.bit_count(low.bitwiseAND(-low) - 1))
        subset = level * _EACH + F.pmod(spread.bitwiseAND(F.lit(255)), F.lit(_EACH))
        return F.shiftleft(subset.cast("bigint"), 56).bitwiseOR(term.bitwiseAND(F.lit((1 << 56) - 1)))

    return F.sort_array(F.transform(terms, key))


def _used(kept: Column, terms: Column, text: Column) -> Column:
    """The lexicon terms of a text, else all its terms, else the text as one."""
    whole = F.when(F.length(text) > 0, F.array(F.xxhash64(text))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(kept) > 0, kept).when(F.size(terms) > 0, terms).otherwise(whole)


def subset_keys(text: Column, known: Lexicon) -> Column:
    """The terms that make a text's fingerprint, each below the number of its subset, sorted."""
    terms = terms_of(text)
    return _subsets(_used(F.filter(terms, known.has), terms, text))


def cells(keys: Column) -> Column:
    """One number per subset that is not empty: the subset above 24 bits of hash. `keys` is a column."""

    def add(a: Column, k: Column) -> Column:
        subset = F.shiftright(k, 56).cast("int")
        return F.when(a["subset"] == subset, F.struct(subset.alias("subset"), F.xxhash64(a["hash"], k).alias("hash"), a["done"].alias("done"))).otherwise(
            F.struct(subset.alias("subset"), F.xxhash64(k).alias("hash"), F.concat(a["done"], _cell(a)).alias("done"))
        )

    start = F.struct(F.lit(-1).alias("subset"), F.lit(0).cast("bigint").alias("hash"), F.array().cast("array<int>").alias("done"))
    return F.aggregate(keys, start, add, lambda a: F.concat(a["done"], _cell(a)))


def _cell(a: Column) -> Column:
    low = a["hash"].bitwiseAND(F.lit((1 << _CELL_BITS) - 1)).cast("int")
    return F.when(a["subset"] != -1, F.array(F.shiftleft(a["subset"], _CELL_BITS).bitwiseOR(low))).otherwise(F.array().cast("array<int>"))


def as_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda c: F.lpad(F.lower(F.hex(c.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column, terms: Column) -> Column:
    """Equal cells among those of subsets that are sparse at `terms` terms; 1 for equal fingerprints."""
    level = F.greatest(F.lit(0), F.least(F.lit(_LEVELS - 1), F.ceil(F.log2(F.greatest(terms, F.lit(1)) / _EACH)).cast("int") - 1))
    subset = lambda c: F.shiftrightunsigned(c, _CELL_BITS)
    sparse_a, sparse_b = (F.filter(x, lambda c: subset(c) >= level * _EACH) for x in (a, b))
    either = F.size(F.array_union(F.transform(sparse_a, subset), F.transform(sparse_b, subset)))
    share = F.size(F.array_intersect(sparse_a, sparse_b)) / either
    return F.when(a == b, F.lit(1.0)).when(either > 0, share).otherwise(F.lit(0.0))


def fingerprints(docs: DataFrame, *, least: int = 2, most: float = 0.05) -> DataFrame:
    """doc_id, fingerprint, n_terms and cells per document."""
    known = lexicon(docs, least=least, most=most)
    rows = docs.select("doc_id", text_of().alias("_text"), terms_of(text_of()).alias("_terms"))
    rows = rows.select("*", F.filter("_terms", known.has).alias("_kept"))
    rows = rows.select("doc_id", _subsets(_used(F.col("_kept"), F.col("_terms"), F.col("_text"))).alias("_keys"))
    return rows.select("doc_id", F.size("_keys").alias("n_terms"), cells(F.col("_keys")).alias("cells")).withColumn(
        "fingerprint", as_text(F.col("cells"))
    )


def edit_report(docs: DataFrame, *, least: int = 2, most: float = 0.05) -> DataFrame:
    """Fingerprint each text and its edited text, whose second half is the start of the next document.

    The next document in order of id, then text hash, is found on narrow rows. Texts meet by key: each
    next document sends its start to the one before it, and both joins share one shuffle of the texts.
    """
    known = lexicon(docs, least=least, most=most)
    key = F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("null"))
    keyed = docs.select(key.alias("key"), F.xxhash64(text_of()).alias("hash"), text_of().alias("text"))
    named = docs.select("doc_id", key.alias("key"), F.xxhash64(text_of()).alias("hash"), text_of().alias("text"))
    narrow = materialise(named.groupBy("doc_id", "key", "hash").agg(F.first(F.length("text")).alias("n"), F.count(F.lit(1)).alias("rows")))
    repeated = not narrow.filter("rows > 1").isEmpty()
    placed = materialise(positions(narrow, [F.col("doc_id").asc_nulls_first(), F.col("hash")], name="place"))
    after = placed.select(F.col("key").alias("next_key"), F.col("hash").alias("next_hash"), F.col("place").alias("next_place"))
    ask = placed.join(after, F.pmod(F.col("place") + 1, F.col("place_count")) == F.col("next_place")).select(
        "doc_id", "next_key", "next_hash", F.col("key").alias("to_key"), F.col("hash").alias("to_hash"), "place", "place_count",
        F.floor(F.col("n") / 2).cast("int").alias("half"),
    )
    single = keyed.dropDuplicates(["key", "hash"]) if repeated else keyed
    starts = single.hint("merge").join(ask, (F.col("key") == F.col("next_key")) & (F.col("hash") == F.col("next_hash"))).select(
        "doc_id", "to_key", "to_hash", "place", "place_count", "half", F.expr("substring(text, 1, half)").alias("start")
    )
    joined = keyed.hint("merge").join(starts, (F.col("key") == F.col("to_key")) & (F.col("hash") == F.col("to_hash")))
    n = F.length("text")
    rows = joined.select(
        "doc_id", "place", "place_count", n.cast("bigint").alias("n_chars"), "text",
        F.concat(F.substring("text", F.lit(1), n - F.col("half")), F.col("start")).alias("edited"),
    ).select(
        "doc_id", "place", "place_count", "n_chars", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha256"),
        "text", "edited", terms_of(F.col("text")).alias("all"), terms_of(F.col("edited")).alias("edited_all"),
    ).select("*", F.filter("all", known.has).alias("kept"), F.filter("edited_all", known.has).alias("edited_kept"))
    one_sided = (F.size("kept") > 0) != (F.size("edited_kept") > 0)
    rows = rows.select(
        "doc_id", "place", "place_count", "n_chars", "edited_sha256",
        _subsets(_used(F.col("kept"), F.col("all"), F.col("text"))).alias("keys"),
        _subsets(_used(F.col("edited_kept"), F.col("edited_all"), F.col("edited"))).alias("edited_keys"),
        F.when(one_sided, _subsets(F.col("all"))).alias("all_keys"), F.when(one_sided, _subsets(F.col("edited_all"))).alias("edited_all_keys"),
    ).select(
        "doc_id", "place", "place_count", "n_chars", "edited_sha256", F.size("keys").alias("terms"), cells(F.col("keys")).alias("cells"),
        F.size("edited_keys").alias("edited_terms"), cells(F.col("edited_keys")).alias("edited_cells"),
        F.greatest(F.size("all_keys"), F.size("edited_all_keys")).alias("all_terms"),
        F.when(F.col("all_keys").isNotNull(), cells(F.col("all_keys"))).alias("all_cells"),
        F.when(F.col("all_keys").isNotNull(), cells(F.col("edited_all_keys"))).alias("edited_all_cells"),
    )
    done = materialise(rows.select(
        "doc_id", "place", "place_count", "n_chars", "edited_sha256", "terms", "cells", "edited_cells",
        F.when(F.col("all_cells").isNotNull(), likeness(F.col("all_cells"), F.col("edited_all_cells"), F.col("all_terms")))
        .otherwise(likeness(F.col("cells"), F.col("edited_cells"), F.greatest("terms", "edited_terms"))).alias("near_edited"),
    ))
    following = done.select(F.col("place").alias("next_place"), F.col("cells").alias("next_cells"), F.col("terms").alias("next_terms"))
    following = following.dropDuplicates(["next_place"]) if repeated else following
    both = done.join(following, F.pmod(F.col("place") + 1, F.col("place_count")) == F.col("next_place"))
    return both.select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), as_text(F.col("cells")).alias("fingerprint"),
        as_text(F.col("edited_cells")).alias("edited_fingerprint"),
        "near_edited",
        likeness(F.col("cells"), F.col("next_cells"), F.greatest("terms", "next_terms")).alias("near_next"),
    )
