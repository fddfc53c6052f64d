"""Columns and small helpers that the text operators share.

Every operator first selects what it needs under names of its own, so extra columns of the input
can have any name. A null text counts as empty. `row_key` names a row by its id and its text: rows
that repeat both are one document to an operator and get the same result.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


WORD = r"[^\x20\x09-\x0D]+"
_shipped: set[str] = set()  # applications whose executors have the package
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, for the functions they run.

    Whole texts are exchanged with Python in batches that are small also if the texts are long, unless
    the session has sizes of its own.
    """
    for name, default, value in [("maxRecordsPerBatch", "10000", "500"), ("maxBytesPerBatch", None, "8m")]:
        if spark.conf.get(f"spark.sql.execution.arrow.{name}", default) in (default, str(2**31 - 1), "2147483647b"):
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def text_of() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def crc32_text(column: Column) -> Column:
    """CRC-32 of the UTF-8 text of a column; null for null."""
    return F.crc32(column.cast("string").cast("binary"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")



def literal_array(values: Sequence, kind: str) -> Column:
    """Array literal of numbers or of words without commas, folded to a constant by the optimizer."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


class WordTable:
    """Numbers of listed words by a hash table without collisions, as columns. Word i has number i + 1."""

    def __init__(self, words: Sequence[str]):
        self.words = list(words)
        hashes = [xxhash.xxh64_intdigest(word.encode(), seed=42) for word in self.words]  # as F.xxhash64
        self.bits = max(8, (len(self.words) ** 2).bit_length())
        while True:
            mask = (1 << self.bits) - 1
            for self.shift in range(0, 64 - self.bits):
                slots = {(h >> self.shift) & mask: i + 1 for i, h in enumerate(hashes)}
                if len(slots) == len(self.words):
                    self.slots = [slots.get(i, 0) for i in range(mask + 1)]
                    return
            self.bits += 1

    def slot(self, word: Column) -> Column:
        """What stands in the word's slot: the number of one word that it may be, or 0."""
        if not self.words:
            return F.lit(0)
        place = F.shiftrightunsigned(F.xxhash64(word), self.shift).bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int")
        return F.get(literal_array(self.slots, "int"), place)

    def number_in(self, slot: Column, word: Column) -> Column:
        """The number in the slot if it is the word's; 0 for a word that is not listed."""
        if not self.words:
            return F.lit(0)
        return F.when((slot > 0) & (F.get(literal_array(self.words, "string"), slot - 1) == word), slot).otherwise(0)

    def number(self, word: Column) -> Column:
        """1 for the first word and so on; 0 for a word that is not listed."""
        return self.number_in(self.slot(word), word)
