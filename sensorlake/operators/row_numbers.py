"""Line numbers within source files, without bringing a file into one task.

A line is landed with its file, the split of the file it was read from, and its
position in the scan. A split is read by one task from start to end, so counts and
first positions per split, taken from what was landed, give the line numbers: the
files are read once, and nothing is numbered before somebody asks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# One row per file split, about 300 bytes each.
BROADCAST_SPLITS = 200_000

SPLIT = ["source_file_name", "split_start"]


def with_scan_order(lines: DataFrame) -> DataFrame:
    """Marks the order within each scan task. Apply directly on the scan."""
    return lines.withColumn("scan_seq", F.monotonically_increasing_id())


def split_offsets(landed: DataFrame, scan: Sequence[str] = (), counts: Sequence[Column] = ()) -> DataFrame:
    """Per split: its first position, its lines, and what to add to ``scan_seq``.

    ``scan`` are columns that tell scans apart, ``counts`` further aggregates. The
    lines before a split are the running total over the file's earlier splits: the
    window sees one row per split, never the lines themselves. A split whose
    positions are not dense was not read from start to end, and fails the query.
    """
    first, last = F.min("scan_seq"), F.max("scan_seq")
    splits = landed.groupBy(*scan, *SPLIT).agg(
        first.alias("first_seq"),
        last.alias("last_seq"),
        F.count(F.lit(1)).alias("lines"),
        *counts,
    )
    earlier = (
        Window.partitionBy(*scan, "source_file_name")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("lines").over(earlier), F.lit(0))
    broken = F.col("last_seq") - F.col("first_seq") + 1 != F.col("lines")
    torn = F.raise_error(F.lit("a split was not read by one task")).cast("bigint")
    return splits.withColumn(
        "shift", F.when(broken, torn).otherwise(before + 1 - F.col("first_seq"))
    ).drop("last_seq")


def number_rows(lines: DataFrame, splits: DataFrame, scan: Sequence[str]) -> DataFrame:
    """Adds ``source_file_row_num`` (from 1) to landed lines, null where none were counted.

    Lines are never shuffled for it: the offsets are broadcast, and where there are
    more than may be, the lines are taken in slices with a broadcast each. A slice is
    some whole scans, or a range of positions in one; both are skipped by directory or
    by statistics when another slice is read.
    """
    limit = max(1, BROADCAST_SPLITS)
    counted = splits.groupBy(_scan_name(scan).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sorted((row["name"], row["n"]) for row in counted.collect())  # one row per scan
    if sum(n for _, n in sizes) <= limit:
        return _with_offsets(lines, splits, scan)
    slices: list[tuple] = []
    held: list[str] = []
    room = 0
    for name, n in sizes:
        if n > limit:
            bounds = _bounds(splits.where(_scan_name(scan) == name), -(-2 * n // limit))
            slices += [([name], low, high) for low, high in zip([None, *bounds], [*bounds, None])]
            continue
        if n > room:
            held, room = [], limit
            slices.append((held, None, None))
        held.append(name)
        room -= n
    numbered = [
        _with_offsets(
            lines.where(_in_slice(scan, "scan_seq", *part)),
            splits.where(_in_slice(scan, "first_seq", *part)),
            scan,
        )
        for part in slices
    ]
    return reduce(DataFrame.unionByName, numbered)


def _scan_name(scan: Sequence[str]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in scan])


def _bounds(splits: DataFrame, slices: int) -> list[int]:
    """First positions that cut the splits into about so many equal slices."""
    shares = [i / slices for i in range(1, slices)]
    return sorted(set(splits.agg(F.percentile_approx("first_seq", shares)).first()[0] or []))


def _in_slice(
    scan: Sequence[str], position: str, names: list[str], low: int | None, high: int | None
) -> Column:
    inside = _scan_name(scan).isin(names)
    if low is not None:
        inside &= F.col(position) >= low
    if high is not None:
        inside &= F.col(position) < high
    return inside


def _with_offsets(lines: DataFrame, splits: DataFrame, scan: Sequence[str]) -> DataFrame:
    offsets = F.broadcast(splits.select(*scan, *SPLIT, "shift"))
    return (
        lines.join(offsets, [*scan, *SPLIT], "left")
        .withColumn("source_file_row_num", F.col("scan_seq") + F.col("shift"))
        .drop("shift")
    )
