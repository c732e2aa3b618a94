"""Helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.session import scratch
from sensorlake.sources import files

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def body(text: str | Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and lets the shuffle
    files behind it go as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    usual = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, usual)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, column: str, size: int) -> DataFrame:
    """At most ``size`` rows, those least by a hash of a column: the same ones each time.

    Of a large table only about four times as many rows are ordered.
    """
    rank = F.xxhash64(column, F.lit("sample"))
    share = 4 * size / max(1, df.count())
    if share < 1:
        df = df.where(F.pmod(rank, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    return df.orderBy(rank, column).limit(size)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` made and that nothing will read again."""
    for table in tables:
        for folder in {path.rpartition("/")[0] for path in table.inputFiles()}:
            files.delete(table.sparkSession, folder)


def one_of_each(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with one row of those that agree in all ``keys``; nulls agree.

    Only numbers of rows are shuffled unless some repeat, and then those that do,
    reduced before the shuffle.
    """
    times = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    twice = materialize(times.where("times > 1").select(*keys), "rows-repeated")
    if twice.isEmpty():
        discard(twice)
        return rows
    left, right = rows.alias("l"), twice.alias("r")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    several = left.join(right, same, "left_semi").dropDuplicates(list(keys))
    return left.join(right, same, "left_anti").union(materialize(several, "rows-once"))
