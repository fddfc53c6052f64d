"""Run queries on Spark and in DuckDB and compare schemas and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

DIGITS = int(os.environ.get("DIGITS", "12"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return float(f"{value:.{DIGITS}g}") + 0.0
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return "d" + value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    columns, got = spark_rows(df)
    expected_columns, expected = duck_rows(con, sql)
    if columns != expected_columns:
        return f"columns {columns} <> {expected_columns}"
    if len(got) != len(expected):
        return f"{len(got)} rows <> {len(expected)}"
    if got != expected:
        wrong = [(a, b) for a, b in zip(got, expected) if a != b]
        return f"{len(wrong)} of {len(got)} rows differ, columns {columns}, first {wrong[0]}"
    return None


def main(folder: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.coalescePartitions.enabled", os.environ.get("COALESCE", "true")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, expected, bad = connect(folder), oracle_sql(), []
    for name, run in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            df = run(spark, folder)
            problem = difference(df, con, expected[name]) if name in expected else f"ok, {len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:6000]}"
        if problem and not problem.startswith("ok"):
            bad.append(name)
        print(f"{time.time() - started:6.2f}s {name}: {problem or 'equal'}", flush=True)
    print(len(bad), "problems:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
