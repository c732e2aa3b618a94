"""Compares a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb

import __spark_entry__ as contract


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    columns = sorted(frame.columns)
    return columns, sorted((tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()), key=repr)


def duck_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    return columns, sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def difference(spark, sf_dir: str, name: str) -> str | None:
    got_columns, got = spark_rows(contract.queries()[name](spark, sf_dir))
    want_columns, want = duck_rows(connect(sf_dir), contract.oracle_sql()[name])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    if not want:
        return "no rows to compare"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
