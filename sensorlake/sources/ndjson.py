"""Day-partitioned JSON lines: write each day once, with a manifest."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from sensorlake import schemas
from sensorlake.session import scratch
from sensorlake.sources import files

MANIFEST_VERSION = "1.0.0"
MANIFEST = schemas.struct("record_count bigint, generated_at string, version string, date date")
_WRITING_NOTE = "_writing.json"

JSON_OPTIONS = {
    # Absent values are written as explicit nulls.
    "ignoreNullFields": "false",
    # Without this the writer cuts microseconds.
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
}


def day_columns(day: Column) -> dict[str, Column]:
    """year, month and day directories as fixed-width text."""
    return {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }


def day_path(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"


def write_days(
    records: DataFrame,
    root: str,
    day: Column | None = None,
    skip_existing: bool = True,
) -> DataFrame:
    """Writes records under ``year=/month=/day=`` and returns the manifest rows.

    Days already present are left alone. Days that a run was still writing when
    it died do not count as present and are written again. The manifest has one
    row per written day: date, record count, time and version.

    The records are evaluated once. Only their days are looked up, not all days below
    the root.
    Rows are rebalanced by day, so a day makes few files, and a day holding much
    of the data is split over several tasks and files.
    """
    spark = records.sparkSession
    day = F.col("timestamp").cast("date") if day is None else day
    dated = records.withColumn(
        "_day", F.coalesce(day, F.raise_error("a record has no day").cast("date"))
    )
    work = scratch(spark, "days")
    try:
        # Stored once: counts and files come from the same evaluation of the records.
        dated.write.parquet(work)
        return _write_days(spark, spark.read.schema(dated.schema).parquet(work), root, skip_existing)
    finally:
        files.delete(spark, work)


def _write_days(spark: SparkSession, dated: DataFrame, root: str, skip_existing: bool) -> DataFrame:
    counts = dated.groupBy(F.col("_day").alias("date")).agg(F.count(F.lit(1)).alias("n")).collect()

    note = f"{root}/{_WRITING_NOTE}"
    torn = _days_in(files.read_note(spark, note))
    present = [
        r["date"]
        for r in counts
        if skip_existing
        and r["date"] not in torn
        and files.has_files(spark, day_path(root, r["date"]))
    ]
    writing = {r["date"]: r["n"] for r in counts if r["date"] not in present}
    # Days listed in the note are incomplete.
    _note_days(spark, note, torn | writing.keys())
    fresh = dated.where(~F.col("_day").isin(present)) if present else dated
    _replace_days(
        fresh.withColumns(day_columns(F.col("_day")))
        .drop("_day")
        .hint("rebalance", "year", "month", "day"),
        "year", "month", "day",
    ).options(**JSON_OPTIONS).json(root)

    manifest = f"{root.rstrip('/')}_manifest"
    written_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
    rows = [(n, written_at, MANIFEST_VERSION, d) for d, n in sorted(writing.items())]
    _replace_days(spark.createDataFrame(rows, MANIFEST), "date").parquet(manifest)
    _note_days(spark, note, torn - writing.keys())
    stored = spark.read.schema(MANIFEST).parquet(manifest)
    return stored.select("date", "record_count", "generated_at", "version")


def _days_in(note: str | None) -> set[dt.date]:
    return {dt.date.fromisoformat(d) for d in json.loads(note)} if note else set()


def _note_days(spark: SparkSession, note: str, days: set[dt.date]) -> None:
    if days:
        files.write_note(spark, note, json.dumps(sorted(str(d) for d in days)))
    elif files.exists(spark, note):
        files.delete(spark, note)


def _replace_days(rows: DataFrame, *partitions: str) -> DataFrameWriter:
    return (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
    )
