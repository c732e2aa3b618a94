"""Named source tables, full-refresh tables and views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from sensorlake.sources import files


class Sources:
    """Named tables behind a name-to-path map; other names go to the catalog."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, str]):
        self._spark = spark
        self._paths = dict(paths)

    def table(self, name: str) -> DataFrame:
        if name in self._paths:
            return self._spark.read.parquet(self._paths[name])
        return self._spark.table(name)


def write_full(
    frame: DataFrame,
    path: str,
    *partitions: str,
    notes: Mapping[str, str | Callable[[], str]] | None = None,
) -> None:
    """Replaces the whole table at ``path``, with ``notes`` as side files by name.

    A note given as a function is asked for when the rows are written.

    The new table is written beside the old one and takes its place when it is
    complete, so a failed job leaves the old table readable.
    """
    spark = frame.sparkSession
    files.restore_directory(spark, path)
    folder, _, name = path.rstrip("/").rpartition("/")
    fresh = f"{folder}/_next_{name}"
    files.delete(spark, fresh)
    try:
        # The session may replace partitions only; this replaces the table.
        writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(fresh)
        for note, text in (notes or {}).items():
            files.write_note(spark, f"{fresh}/{note}", text() if callable(text) else text)
        files.replace_directory(spark, fresh, path)
    finally:
        files.delete(spark, fresh)


def replace_dates(
    frame: DataFrame, path: str, partition: str, dates: Sequence[dt.date | None]
) -> None:
    """Replaces some dates of a stored table by the rows of ``frame``, all of these dates.

    Dates without rows go; folders of other dates keep their files. The rows are written
    once and their folders moved. Repeating it changes nothing.
    """
    spark = frame.sparkSession
    staged = f"{path}/_staged"
    try:
        # The session may replace partitions only; nothing older is to be moved.
        whole = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
        whole.partitionBy(partition).parquet(staged)
        staged_dates = set(files.partition_dates(spark, staged, partition))
        files.move_partitions(spark, staged, path, partition)
        for date in set(dates) - staged_dates:
            files.delete(spark, f"{path}/{files.partition_folder(partition, date)}")
    finally:
        files.delete(spark, staged)


def publish_view(frame: DataFrame, name: str) -> None:
    """Makes the frame available to SQL under ``name`` without storing it."""
    frame.createOrReplaceTempView(name)
