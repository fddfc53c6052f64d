"""CSV files with line breaks inside quotes, read by many tasks.

Spark's multi-line reader gives each file to one task, because a line break only ends a record where it
stands outside quotes. Whether it does follows from the number of quotes before it in the file. So the
file is read as lines, in blocks; each block counts its quotes; the parities of earlier blocks, one bit a
block, tell for every block whether it begins inside quotes; and inside a block a running count tells it
for every line. A line that begins outside quotes begins a record. Lines are put together inside their
block, and what a block has before its first record is added to the record that was open there.

Defined cases: doubled quotes count twice and change nothing; blank lines between records are no
records; a last line without a line break is a line; line breaks may be `\\n` or `\\r\\n`; a record that is
too short has nulls; a quote that is never closed makes the rest of its file one record. A quote inside
an unquoted field opens quotes here, while the multi-line reader takes it as a character.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tradewinds.operators.materialise import Scope, materialise


class WrongHeader(ValueError):
    """A file's first record does not name the declared columns."""


def quoted_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with file, start of their block, a number that ascends inside it, and the parity of their quotes."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), (quotes % 2).alias("odd"), "value",
    )


def _earlier_blocks():
    """A window over one row a block."""
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def _joined(order: str, text: str):
    ordered = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(ordered, lambda line: line[text]), "\n")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Written: records as far as their block has them. `start` is null for lines before a block's first record."""
    with Scope(spark) as scope:
        # written, so that both reads see the same blocks
        lines = materialise(quoted_lines(spark, path))
        blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"))
        opened = blocks.select("file", "block", F.coalesce(F.sum("odd").over(_earlier_blocks()), F.lit(0)).alias("before"))
        block = Window.partitionBy("file", "block").orderBy("row")  # as many rows as a block of a file has lines
        inside = F.coalesce(F.sum("odd").over(block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = lines.join(opened, ["file", "block"]).select(
            "file", "block", "row", "value", ((F.col("before") + inside) % 2 == 0).alias("begins"),
            ((F.col("block") == 0) & (F.row_number().over(block) == 1)).alias("header"),
        )
        begun = F.max(F.when(F.col("begins"), F.col("row"))).over(block.rowsBetween(Window.unboundedPreceding, 0))
        parts = placed.withColumn("start", begun).groupBy("file", "block", "start").agg(
            _joined("row", "value").alias("text"), F.max("header").alias("header")
        )
        return scope.keep(materialise(parts))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, text): every record of the files as it stands there, line breaks included."""
    parts = _parts(spark, path)
    last = parts.groupBy("file", "block").agg(F.max("start").alias("start"))
    begun = F.when(F.col("start").isNotNull(), F.struct("block", "start"))
    owners = last.select("file", "block", F.last(begun, ignorenulls=True).over(_earlier_blocks()).alias("owner"))
    # at most one head a block; a record may run through several
    heads = parts.filter("start is null").select("file", "block", "text").join(owners, ["file", "block"])
    tails = heads.groupBy("file", "owner").agg(_joined("block", "text").alias("tail")).select(
        "file", "owner.block", "owner.start", "tail"
    )
    whole = parts.filter("start is not null").join(tails, ["file", "block", "start"], "left")
    text = F.concat_ws("\n", "text", "tail")  # skips a null tail
    return whole.select("file", "header", F.regexp_replace(text, r"\r\z", "").alias("text"))


def read_quoted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed rows of CSV files with a header; a value that does not parse becomes null."""
    records = quoted_records(spark, path)
    named = F.regexp_replace("text", r'[\x{FEFF}" \r]', "")
    wrong = records.filter("header").filter(named != ",".join(name.strip() for name in schema.names)).select("file", "text").first()
    if wrong:
        raise WrongHeader(f"{wrong['file']}: {wrong['text']}")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true"}
    rows = records.filter("not header and text <> ''").select(F.from_csv("text", fields, options).alias("record"))
    return rows.select("record.*")
