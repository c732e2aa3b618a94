"""JSON-lines scans: whole prefixes, day windows, provenance, tolerant parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.sources import files

JSON_GLOB = "*.json"


def path_day() -> Column:
    """Day of the year=/month=/day= directory a file lies in."""
    return F.make_date(F.col("year"), F.col("month"), F.col("day"))


def in_window(frame: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Keep directories in ``[start, end)``; prunes before any file is opened."""
    if start is not None:
        frame = frame.where(path_day() >= F.lit(start))
    if end is not None:
        frame = frame.where(path_day() < F.lit(end))
    return frame


def last_days(days_back: int, today: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """The window of ``days_back`` full days before today."""
    end = today or dt.datetime.now(dt.timezone.utc).date()
    return end - dt.timedelta(days=days_back), end


def window_paths(
    spark: SparkSession, root: str, start: dt.date | None, end: dt.date | None
) -> list[str]:
    """Directories to list for a window: its days, found by year and month.

    Only years and months that meet the window are listed, so a daily load does
    not list years of history. Numbers may be written with or without leading
    zeros. Without bounds it is the root.
    """
    if start is None and end is None:
        return [root]
    first = start or dt.date.min
    last = (end or dt.date.max) - dt.timedelta(days=1)
    if last < first:
        return []
    paths = []
    for year, in_year in files.partition_numbers(spark, root, "year"):
        if not first.year <= year <= last.year:
            continue
        for month, in_month in files.partition_numbers(spark, in_year, "month"):
            if not (first.year, first.month) <= (year, month) <= (last.year, last.month):
                continue
            paths += [
                path
                for day, path in files.partition_numbers(spark, in_month, "day")
                if (first.year, first.month, first.day)
                <= (year, month, day)
                <= (last.year, last.month, last.day)
            ]
    return paths


def with_provenance(lines: DataFrame) -> DataFrame:
    """Line text with the file and the split it was read from."""
    return lines.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("source_file_name"),
        F.col("_metadata.file_block_start").alias("split_start"),
    )


def scan(
    spark: SparkSession,
    root: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    paths: list[str] | None = None,
    glob: str = JSON_GLOB,
) -> DataFrame:
    """Lines of the JSON files below ``root`` in ``[start, end)``, or of given files."""
    if paths is None:
        paths = window_paths(spark, root, start, end)
    paths = [files.escaped(path) for path in paths]
    if not paths:
        nothing = "cast(null as string) line, cast(null as string) source_file_name, 0L split_start"
        return spark.range(0).selectExpr(*nothing.split(", "))
    reader = spark.read.option("pathGlobFilter", glob).option("basePath", root)
    return with_provenance(in_window(reader.text(paths), start, end))


def _records() -> Column:
    """The line's record as a list of no or one variant.

    The parser stops after the first value of a text and ignores the rest. The
    line is therefore parsed as the first of two items of a list, the second being
    a hash of the line: text after the record breaks the list, ends it early or
    adds an item, and then the hash is not where it belongs.
    """
    mark = F.xxhash64("line")
    text = F.concat(F.lit("["), "line", F.lit("\n,"), mark.cast("string"), F.lit("]"))
    listed = F.array(F.try_parse_json(text))
    whole = F.filter(listed, lambda v: F.try_variant_get(v, "$[1]", "bigint") == mark)
    return F.transform(whole, lambda v: F.variant_get(v, "$[0]", "variant"))


def parse(lines: DataFrame) -> DataFrame:
    """Adds the record as a variant; null marks a line that is not one JSON value."""
    return lines.withColumn("raw_data", F.get(_records(), F.lit(0)))


def accepted(lines: DataFrame) -> DataFrame:
    """Only the lines that parse, as ``raw_data`` in place of ``line``.

    Explodes a list of no or one record. A filter on the parsed column would do
    the same, but the optimizer copies the parse into such a filter, and every
    line is then parsed twice.
    """
    rest = [c for c in lines.columns if c != "line"]
    return lines.select(F.explode(_records()).alias("raw_data"), *rest)
