"""Landing raw lines in bronze, with provenance, rejects and a per-file report.

The files are read once. Lines are landed with the place they were read from, and the
counts per split of a file, taken from what was landed, give the report and, when
somebody asks, the line numbers.

What is done is known without reading what was done long ago: claimed files lie by the
day of their path, loads by the month of their load time, and a load that is not
finished has a note of its own.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import schemas
from sensorlake.functions import columns as fn
from sensorlake.operators.row_numbers import number_rows, split_offsets, with_scan_order
from sensorlake.operators.upsert import ntz_literal, sync_columns
from sensorlake.sources import files, json_lines

LOADS = schemas.struct(
    "load_timestamp timestamp_ntz, rows_loaded bigint, load_month string, load_batch string"
)
CLAIMED = schemas.struct(
    "path string, length bigint, modified_micros bigint, part bigint, claim_day date, "
    "load_batch string"
)
# Files that one write reads: their paths are a list on the driver.
MOST_FILES = 100_000


@dataclass(frozen=True)
class BronzeStore:
    """Where the bronze tables live. Each is partitioned by the load batch.

    Records and rejected lines are two branches of one directory, so that one
    write can fill both. Below each branch the load comes first and the date
    second: a load is one directory, listed, read and replaced by itself.

    One loader at a time writes to a store: either the file loader or a stream.
    """

    root: str

    @property
    def lines(self) -> str:
        return f"{self.root}/raw_sensor_readings"

    @property
    def readings(self) -> str:
        return f"{self.lines}/accepted=true"

    @property
    def quarantine(self) -> str:
        return f"{self.lines}/accepted=false"

    @property
    def file_log(self) -> str:
        return f"{self.root}/file_log"

    @property
    def splits(self) -> str:
        return f"{self.root}/splits"

    @property
    def loads(self) -> str:
        return f"{self.root}/loads"

    @property
    def open_loads(self) -> str:
        return f"{self.root}/open_loads"

    @property
    def counter(self) -> str:
        return f"{self.root}/loads_made.json"

    @property
    def claimed(self) -> str:
        return f"{self.root}/claimed_files"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not files.has_files(spark, path):
        return sync_columns(spark.range(0), schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _read_loads(
    spark: SparkSession, path: str, schema: T.StructType, labels: list[str]
) -> DataFrame:
    """Rows of some loads; directories of other loads are not listed."""
    paths = [f"{path}/load_batch={label}" for label in labels]
    return _read_folders(spark, path, schema, paths)


def _read_folders(
    spark: SparkSession, path: str, schema: T.StructType, folders: list[str]
) -> DataFrame:
    found = [folder for folder in folders if files.exists(spark, folder)]
    if not found:
        return sync_columns(spark.range(0), schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*found)
    return rows.select(*schema.names)


def _shown(
    landed: DataFrame, schema: T.StructType, splits: DataFrame | None = None
) -> DataFrame:
    """Landed lines with the public columns, the line number only where splits are given."""
    if splits is None:
        return landed.select(*[c for c in schema.names if c != "source_file_row_num"])
    return number_rows(landed, splits, ["load_batch", "part"]).select(*schema.names)


def read_bronze(spark: SparkSession, store: BronzeStore, row_numbers: bool = True) -> DataFrame:
    """All loaded lines; without ``row_numbers`` nothing is joined."""
    landed = _read(spark, store.readings, schemas.LANDED)
    splits = _read(spark, store.splits, schemas.SPLITS) if row_numbers else None
    return _shown(landed, schemas.BRONZE, splits)


def read_load(
    spark: SparkSession, store: BronzeStore, label: str, row_numbers: bool = True
) -> DataFrame:
    """The rows of one load."""
    landed = _read_loads(spark, store.readings, schemas.LANDED, [label])
    splits = _read_loads(spark, store.splits, schemas.SPLITS, [label]) if row_numbers else None
    return _shown(landed, schemas.BRONZE, splits)


def read_since(spark: SparkSession, store: BronzeStore, mark: dt.datetime | None) -> DataFrame:
    """Bronze rows of finished loads after the mark, or of all finished loads; not numbered.

    The loads are looked up in their own small table, from the month of the mark on, so
    bronze is pruned by directory and files of earlier loads are not opened. A load
    still being written is left for the next time: its rows are not all there yet.
    """
    loads = _loads_from(spark, store, mark)
    if mark is None:
        unfinished = _labels(loads.where("rows_loaded is null"))
        landed = _read(spark, store.readings, schemas.LANDED)
        landed = landed.where(~F.col("load_batch").isin(unfinished))
    else:
        fresh = loads.where("rows_loaded is not null").where(F.col("load_timestamp") > ntz_literal(mark))
        landed = _read_loads(spark, store.readings, schemas.LANDED, _labels(fresh))
    return _shown(landed, schemas.BRONZE)


def _month(moment: dt.datetime) -> str:
    return f"{moment:%Y-%m}"


def _loads_from(spark: SparkSession, store: BronzeStore, since: dt.datetime | None) -> DataFrame:
    """The loads of a month and later ones, or all."""
    folders = [
        path
        for month, path in files.partition_folders(spark, store.loads, "load_month")
        if since is None or month >= _month(since)
    ]
    return _read_folders(spark, store.loads, LOADS, folders)


def _labels(loads: DataFrame) -> list[str]:
    return sorted(row["load_batch"] for row in loads.select("load_batch").distinct().collect())


def read_quarantine(spark: SparkSession, store: BronzeStore, row_numbers: bool = True) -> DataFrame:
    landed = _read(spark, store.quarantine, schemas.LANDED_REJECTS)
    splits = _read(spark, store.splits, schemas.SPLITS) if row_numbers else None
    return _shown(landed, schemas.QUARANTINE, splits)


def read_file_log(spark: SparkSession, store: BronzeStore) -> DataFrame:
    """Per file and load: lines loaded and lines rejected."""
    return _read(spark, store.file_log, schemas.FILE_LOG)


def _replace_batch(rows: DataFrame, path: str, *partitions: str) -> None:
    """Writes the partitions of one load; doing it again replaces them."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _open_load(
    spark: SparkSession, store: BronzeStore, label: str, now: dt.datetime | None
) -> dt.datetime:
    """The load time of a batch, fixed at its first attempt.

    Load times grow strictly: silver picks up what is newer than its latest one,
    so two loads must never share a time.
    """
    months = sorted(files.partition_folders(spark, store.loads, "load_month"), reverse=True)
    for _, folder in months:
        if files.exists(spark, f"{folder}/load_batch={label}"):
            own = _read_folders(spark, store.loads, LOADS, [f"{folder}/load_batch={label}"])
            return own.agg(F.max("load_timestamp")).first()[0]
    moment = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    latest = _read_folders(spark, store.loads, LOADS, [folder for _, folder in months[:1]])
    last = latest.agg(F.max("load_timestamp")).first()[0]
    if last is not None:
        moment = max(moment, last + dt.timedelta(microseconds=1))
    _note_load(spark, store, label, moment, rows_loaded=None)
    return moment


def _note_load(
    spark: SparkSession, store: BronzeStore, label: str, moment: dt.datetime, rows_loaded: int | None
) -> None:
    row = spark.range(1).select(
        ntz_literal(moment).alias("load_timestamp"),
        F.lit(rows_loaded).cast("bigint").alias("rows_loaded"),
        F.lit(_month(moment)).alias("load_month"),
        F.lit(label).alias("load_batch"),
    )
    _replace_batch(row, store.loads, "load_month", "load_batch")


def land(
    spark: SparkSession,
    lines: DataFrame,
    store: BronzeStore,
    label: str,
    row_numbers: bool = True,
    now: dt.datetime | None = None,
) -> int:
    """Loads scanned lines as the batch ``label`` and returns the rows loaded.

    One pass parses the lines and writes records and rejected lines side by side,
    each with its place. Nothing is shuffled: a scan task holds lines of one or a few
    days, so writing by date from there already gives few files. Landing a label
    again replaces it, all its dates included.
    """
    return _land_parts(spark, [lines], store, label, row_numbers, now)


def _land_parts(
    spark: SparkSession,
    parts: Iterable[DataFrame],
    store: BronzeStore,
    label: str,
    row_numbers: bool,
    now: dt.datetime | None,
    expected: Sequence[int] = (),
    vanished: Sequence[str] = (),
) -> int:
    """Loads several scans as one batch, which silver sees when all are there.

    ``expected`` may gather, as the parts are made, how many files must have given
    lines; ``vanished`` files that were to be loaded, noted as gone.
    """
    moment = _open_load(spark, store, label, now)
    for folder in (store.readings, store.quarantine, store.splits):
        files.delete(spark, f"{folder}/load_batch={label}")
    for number, lines in enumerate(parts):
        _write_lines(lines, store, label, number, row_numbers, moment)
    _count_splits(spark, store, label)
    loaded = _report(spark, store, label, moment, sum(expected) if expected else None, vanished)
    _note_load(spark, store, label, moment, rows_loaded=loaded)
    return loaded


def _write_lines(
    lines: DataFrame,
    store: BronzeStore,
    label: str,
    part: int,
    row_numbers: bool,
    moment: dt.datetime,
) -> None:
    if row_numbers:
        placed = with_scan_order(lines)
    else:
        placed = lines.withColumn("scan_seq", F.lit(None).cast("bigint"))
    parsed = json_lines.parse(placed)
    accepted = F.col("raw_data").isNotNull()
    _replace_batch(
        parsed.select(
            F.expr("uuid()").alias("load_id"),
            ntz_literal(moment).alias("load_timestamp"),
            "source_file_name",
            "split_start",
            "scan_seq",
            "raw_data",
            F.when(~accepted, F.col("line")).alias("line"),
            accepted.alias("accepted"),
            fn.reading_date("raw_data").alias("reading_date"),
            F.lit(label).alias("load_batch"),
            F.lit(part).cast("bigint").alias("part"),
        ),
        store.lines,
        "accepted",
        "load_batch",
        "part",
        "reading_date",
    )


def _count_splits(spark: SparkSession, store: BronzeStore, label: str) -> None:
    """Stores first position and lines of each split of a load, as they were landed.

    Only the columns of the place are read, and reduced before the one small shuffle.
    """

    def places(frame: DataFrame, accepted: bool) -> DataFrame:
        columns = ["part", "source_file_name", "split_start", "scan_seq"]
        return frame.select(*columns, F.lit(accepted).alias("accepted"))

    records = _read_loads(spark, store.readings, schemas.LANDED, [label])
    rejects = _read_loads(spark, store.quarantine, schemas.LANDED_REJECTS, [label])
    splits = split_offsets(
        places(records, True).unionByName(places(rejects, False)),
        scan=["part"],
        counts=[fn.count_where(F.col("accepted")).alias("accepted")],
    )
    stamped = splits.withColumn("load_batch", F.lit(label))
    _replace_batch(stamped.select(*schemas.SPLITS.names), store.splits, "load_batch", "part")


def _report(
    spark: SparkSession,
    store: BronzeStore,
    label: str,
    moment: dt.datetime,
    expected: int | None,
    vanished: Sequence[str],
) -> int:
    """Writes the lines loaded and rejected per file of a load; returns the former.

    Both are sums over the splits; the lines are not read again.
    """
    splits = _read_loads(spark, store.splits, schemas.SPLITS, [label])
    report = splits.groupBy("source_file_name").agg(
        F.sum("accepted").alias("rows_loaded"),
        F.sum(F.col("lines") - F.col("accepted")).alias("rows_rejected"),
    )
    if vanished:
        gone = spark.createDataFrame([(path,) for path in vanished], "source_file_name string")
        report = report.unionByName(gone, allowMissingColumns=True)
    stamped = report.withColumns(
        {"load_timestamp": ntz_literal(moment), "load_batch": F.lit(label)}
    )
    _replace_batch(stamped.select(*schemas.FILE_LOG.names), store.file_log, "load_batch")
    mine = _read_loads(spark, store.file_log, schemas.FILE_LOG, [label])
    sums = mine.agg(
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("n"), F.count("rows_loaded").alias("read")
    ).first()
    if expected is not None and sums["read"] != expected:
        raise FilesNotRead(f"load {label} read {sums['read']} files with lines, not {expected}")
    return sums["n"]


def new_files(
    spark: SparkSession,
    root: str,
    store: BronzeStore,
    start: dt.date | None = None,
    end: dt.date | None = None,
    glob: str = json_lines.JSON_GLOB,
) -> DataFrame:
    """Files in the window that no load has claimed yet.

    A file is known by path, modification time and length, so a file rewritten in
    place counts as new.
    """
    identity = ["path", "length", "modified_micros"]
    paths = [files.escaped(p) for p in json_lines.window_paths(spark, root, start, end)]
    if not paths:
        return _read_claims(spark, store, []).select(*identity, "claim_day").limit(0)
    listing = files.list_files(spark, root, glob, paths)
    dated = {"year", "month", "day"} <= {*listing.columns}
    if start is not None or end is not None:
        listing = json_lines.in_window(listing, start, end)
    named = "try_cast(concat(year, '-', month, '-', day) as date)"
    day = F.expr(named) if dated else F.lit(None).cast("date")
    # Only claims on days of the window can name one of its files.
    days = [
        day
        for day in files.partition_dates(spark, store.claimed, "claim_day")
        if day is None or ((start is None or day >= start) and (end is None or day < end))
    ]
    claimed = _read_claims(spark, store, days).select(*identity)
    return listing.select(*identity, day.alias("claim_day")).join(claimed, identity, "left_anti")


def _read_claims(
    spark: SparkSession, store: BronzeStore, days: list[dt.date | None], label: str | None = None
) -> DataFrame:
    folders = [f"{store.claimed}/{files.partition_folder('claim_day', day)}" for day in days]
    if label is not None:
        folders = [f"{folder}/load_batch={label}" for folder in folders]
    return _read_folders(spark, store.claimed, CLAIMED, folders)


def load_new_files(
    spark: SparkSession,
    root: str,
    store: BronzeStore,
    start: dt.date | None = None,
    end: dt.date | None = None,
    row_numbers: bool = True,
    now: dt.datetime | None = None,
    glob: str = json_lines.JSON_GLOB,
) -> int:
    """Loads every not yet loaded file in ``[start, end)`` once; returns the rows.

    All new files are one load with one load time. They are claimed before they
    are read. A load that died is repeated under its own label first, with the
    same files and the same load time. A claimed file that has vanished is noted
    in the file log, with no counts, and the others are loaded.
    """
    total = 0
    for label in _unfinished(spark, store):
        total += _load_claimed(spark, root, store, label, row_numbers, now, glob)
    label = _claim(spark, store, new_files(spark, root, store, start, end, glob))
    if label is None:
        return total
    return total + _load_claimed(spark, root, store, label, row_numbers, now, glob)


class FilesNotRead(RuntimeError):
    """A load read other files than it had claimed."""


def _claim(spark: SparkSession, store: BronzeStore, fresh: DataFrame) -> str | None:
    """Claims files as the next load and returns its label; None if there are none.

    Files are dealt to parts of at most about ``MOST_FILES``, each of some whole days
    or of a share of one day, so a part writes few dates. A note says that the load is
    open before anything is claimed for it.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    counted = fresh.groupBy("claim_day", folder.alias("folder")).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.groupBy("claim_day").agg(F.sum("n").alias("n"))
    sizes = sorted((r["claim_day"] or dt.date.min, r["n"]) for r in counted.collect())  # days
    if not sizes:
        return None
    dealt: list[tuple[dt.date | None, int, int]] = []
    part, room = -1, 0
    for day, n in sizes:
        if n > MOST_FILES:
            shares, first, part, room = -(-2 * n // MOST_FILES), part + 1, part, 0
            part = first + shares - 1
        else:
            if n > room:
                part, room = part + 1, MOST_FILES
            shares, first, room = 1, part, room - n
        dealt.append((None if day == dt.date.min else day, first, shares))
    note = files.read_note(spark, store.counter)
    number = json.loads(note) if note else 0
    label = f"files-{number:010d}"
    opened = f"{store.open_loads}/{label}.json"
    files.write_note(spark, opened, json.dumps({"claimed": False}))
    files.write_note(spark, store.counter, json.dumps(number + 1))
    shares = F.broadcast(
        spark.createDataFrame(dealt, "dealt_day date, first bigint, shares bigint")
    )
    own = F.col("first") + F.pmod(F.xxhash64("path"), F.col("shares"))
    claims = (
        fresh.join(shares, F.col("claim_day").eqNullSafe(F.col("dealt_day")))
        .withColumns({"part": own, "load_batch": F.lit(label)})
        .select(*CLAIMED.names)
    )
    _replace_batch(claims, store.claimed, "claim_day", "load_batch")
    days = [None if day is None else str(day) for day, _, _ in dealt]
    state = {"claimed": True, "days": days, "parts": part + 1}
    files.write_note(spark, opened, json.dumps(state))
    return label


def _load_claimed(
    spark: SparkSession,
    root: str,
    store: BronzeStore,
    label: str,
    row_numbers: bool,
    now: dt.datetime | None,
    glob: str,
) -> int:
    opened = f"{store.open_loads}/{label}.json"
    state = json.loads(files.read_note(spark, opened))
    if not state["claimed"]:
        # It died while claiming, so nothing of it was read; its files are new again.
        for day in files.partition_dates(spark, store.claimed, "claim_day"):
            folder = files.partition_folder("claim_day", day)
            files.delete(spark, f"{store.claimed}/{folder}/load_batch={label}")
        files.delete(spark, opened)
        return 0
    days = [None if d is None else dt.date.fromisoformat(d) for d in state["days"]]
    claims = _read_claims(spark, store, days, label)
    expected: list[int] = []
    vanished: list[str] = []

    def scans() -> Iterable[DataFrame]:
        for part in range(state["parts"]):
            claimed = {
                row["path"]: row["length"]
                for row in claims.where(F.col("part") == part).select("path", "length").collect()
            }
            with ThreadPoolExecutor(16) as pool:
                there = list(pool.map(lambda path: files.exists(spark, path), claimed))
            present = [path for path, found in zip(claimed, there) if found]
            vanished.extend(path for path, found in zip(claimed, there) if not found)
            expected.append(sum(claimed[path] > 0 for path in present))
            yield json_lines.scan(spark, root, paths=present, glob=glob)

    loaded = _land_parts(
        spark, scans(), store, label, row_numbers, now, expected=expected, vanished=vanished
    )
    files.delete(spark, opened)
    return loaded


def load_day(spark: SparkSession, root: str, store: BronzeStore, day: dt.date) -> int:
    """Loads the new files of one day."""
    return load_new_files(spark, root, store, day, day + dt.timedelta(days=1))


def load_last_days(
    spark: SparkSession,
    root: str,
    store: BronzeStore,
    days_back: int = 30,
    today: dt.date | None = None,
) -> int:
    """Loads the new files of the days before today, in one load."""
    return load_new_files(spark, root, store, *json_lines.last_days(days_back, today))


def _unfinished(spark: SparkSession, store: BronzeStore) -> list[str]:
    """Labels of loads that have been opened and not finished, oldest first."""
    names = files.names(spark, store.open_loads)
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and n[0] not in "._")
