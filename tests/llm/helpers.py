"""Small tables with every awkward row, and the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """(doc_id, text[, lang[, source]]) rows over several partitions."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = "word " * 40_000
    return frame(spark, [
        (1, "The quick brown fox.\nJumps over it.", "en", "a"), (2, None, "en", "b"), (3, "", None, "b"), (None, "no id here at all", "de", None),
        (4, long, "en", None), (5, "x" * 60_000, "fr", "c"), (6, " \t\n ", "en", "a"), (7, "ein kleiner Satz mit ÄÖÜ", None, "c"),
        (8, "same text as nine", "en", "a"), (9, "same text as nine", "en", "b"), (10, "repeated row", "en", "a"), (10, "repeated row", "en", "a"),
        (11, "🙂 ¡ñandú! 東京 … 123", "es", "d"), (12, "12345 +-*/ 67", "es", "d"),
    ])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


#: Names that operators use themselves.
CLASHES = ["size", "place", "hash", "key", "row", "_text", "_words", "text_hash", "shard", "slot", "label", "a", "b", "word", "count", "set_id", "length", "piece"]


def clashing(df):
    return df.select("*", *[F.lit(f"extra {name}").alias(name) for name in CLASHES])


def given(spark, folder=SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


def same_rows(left, right):
    order = sorted(left.columns)
    assert order == sorted(right.columns)
    key = lambda r: repr(tuple(r))
    assert sorted(left.select(*order).collect(), key=key) == sorted(right.select(*order).collect(), key=key)
