"""Raw CSV tables and dated snapshots of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradewinds.schemas import RAW
from tradewinds.sources.quoted_csv import read_quoted

_MULTI_LINE = {"order_reviews"}  # comments may hold line breaks


class MissingTables(FileNotFoundError):
    """A source folder lacks expected tables."""


class NoSnapshot(FileNotFoundError):
    """No dated snapshot has been landed."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark can read."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _reader(spark: SparkSession, table: str):
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if table in _MULTI_LINE:
        # a file with line breaks inside quotes is read by one task here, and by many with `split`
        reader = reader.option("multiLine", True)
    return reader.option("escape", '"')


def read_table(spark: SparkSession, path: str, table: str, *, split: bool = False) -> DataFrame:
    """A raw CSV table with its declared types; a value that does not parse becomes null.

    With `split`, large files with line breaks inside quotes are read by many tasks.
    """
    if split and table in _MULTI_LINE:
        return read_quoted(spark, path, RAW[table])
    return _reader(spark, table).schema(RAW[table]).option("enforceSchema", False).csv(path)


def read_as_text(spark: SparkSession, path: str, table: str, *, split: bool = False) -> DataFrame:
    """The table as it was delivered: its own header, every column text. `split` as in `read_table`."""
    rows = _reader(spark, table).option("inferSchema", False).csv(path)
    return read_quoted(spark, path, rows.schema) if split and table in _MULTI_LINE else rows


def malformed_rows(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One row: whether the table is there and how many of its lines have too few or too many fields."""
    exists = path_exists(spark, path)
    result = spark.range(1).select(F.lit(table).alias("file_name"), F.lit(exists).alias("file_exists"))
    if not exists:
        return result.withColumn("malformed_rows", F.lit(None).cast("bigint"))
    header = read_as_text(spark, path, table).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, "_corrupt"]])
    lines = _reader(spark, table).schema(text).option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    # a line is only checked for its number of fields when all of them are read
    fields = F.concat_ws("", *[F.col(f"`{c}`") for c in header])
    broken = F.col("_corrupt").isNotNull() | (F.length(fields) < 0)
    return result.withColumn("malformed_rows", lines.agg(F.count_if(broken)).scalar())


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that reads back as it was, spaces and quotes included."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **keep).csv(path)


def _snapshot_path(folder: str, table: str) -> str:
    return f"{folder}/{table}"


def land_snapshot(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    run_date: dt.date | None = None,
    tables: Sequence[str] = tuple(RAW),
    split: bool = False,
) -> dict[str, DataFrame]:
    """Write one dated snapshot of every table as it was delivered, text only. `split` as in `read_table`.

    Nothing is written unless all tables are there. A table that already holds the date is kept,
    so a run that stopped half-way can be repeated.
    """
    date = (run_date or dt.date.today()).isoformat()
    def landed(table: str) -> bool:
        return path_exists(spark, f"{_snapshot_path(target, table)}/run_date={date}/_SUCCESS")

    wanted = [t for t in tables if not landed(t)]
    missing = [t for t in wanted if not path_exists(spark, f"{source}/{t}.csv")]
    if missing:
        raise MissingTables(f"missing {len(missing)} expected tables in {source}: {', '.join(missing)}")
    for table in wanted:
        rows = read_as_text(spark, f"{source}/{table}.csv", table, split=split)
        rows.write.mode("overwrite").parquet(f"{_snapshot_path(target, table)}/run_date={date}")
    return {t: read_snapshot(spark, target, t) for t in tables}


def read_snapshot(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All landed dates of a table, with `run_date`."""
    path = _snapshot_path(folder, table)
    if not path_exists(spark, path):
        raise NoSnapshot(f"no snapshot of {table} in {folder}")
    return spark.read.option("mergeSchema", True).parquet(path)


def latest_snapshot(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Rows of the newest date, with `run_date`. Dates are found by listing folders, not by reading files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_snapshot_path(folder, table))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        raise NoSnapshot(f"no snapshot of {table} in {folder}")
    names = [status.getPath().getName() for status in files.listStatus(path)]
    dates = sorted(name for name in names if name.startswith("run_date="))
    if not dates:
        raise NoSnapshot(f"no snapshot of {table} in {folder}")
    newest = f"{_snapshot_path(folder, table)}/{dates[-1]}"
    return spark.read.parquet(newest).withColumn("run_date", F.lit(dates[-1].removeprefix("run_date=")).cast("date"))


def typed(df: DataFrame, table: str) -> DataFrame:
    """Declared names and types of a landed text table; what does not parse becomes null."""
    present = {c.strip(): c for c in df.columns}
    columns = []
    for field in RAW[table]:
        if field.name in present:
            columns.append(F.col(f"`{present[field.name]}`").try_cast(field.dataType).alias(field.name))
    return df.select(*columns)
