"""Upsert by key, incremental slice and schema sync on plain parquet tables.

Beside its date folders a stored table has a note of its state (schema, identity and
version, latest load time, what else is kept), one small note per merge with the dates
that changed, an index from keys to dates, and the keys that occur more than once.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.operators import key_index
from sensorlake.operators.enrich import DuplicateKeyError
from sensorlake.session import scratch
from sensorlake.sources import files
from sensorlake.sources.tables import write_full

# A key list is broadcast only up to this many bytes.
BROADCAST_KEY_BYTES = 32 * 1024 * 1024
ON_DUPLICATE = ("fail", "latest", "fail_matched")

# Notes of that many merges are kept; who is further behind starts anew.
KEPT_CHANGES = 1000

_SCHEMA_NOTE = "_schema.json"
_PENDING_NOTE = "_pending_swap.json"
_CHANGES = "_changes"
_KEYS = "_keys"
_STAGED = "_staged"
_MARK = "load_timestamp"


# --- pure operators ---------------------------------------------------------


def high_water_mark(target: DataFrame, column: str = "load_timestamp") -> dt.datetime | None:
    """Latest load time in the target; None when the target has no rows."""
    return target.agg(F.max(column).alias("mark")).first()["mark"]


def ntz_literal(moment: dt.datetime) -> Column:
    """A wall-clock literal; a plain datetime literal would carry a time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def newer_than(source: DataFrame, mark: dt.datetime | None, column: str = "load_timestamp") -> DataFrame:
    """Rows loaded strictly after the mark; all rows when there is no mark.

    The mark is a literal, so parquet statistics skip row groups of old loads.
    """
    return source if mark is None else source.where(F.col(column) > ntz_literal(mark))


def duplicate_keys(batch: DataFrame, key: str) -> DataFrame:
    """Non-null keys that occur more than once, with their count."""
    return (
        batch.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def latest_per_key(batch: DataFrame, key: str, order: str = "load_timestamp") -> DataFrame:
    """One row per non-null key, the newest; rows without a key are all kept.

    An aggregate rather than a ranking window: partial aggregation reduces a key
    with very many copies before the shuffle.
    """
    others = [c for c in batch.columns if c not in (key, order)]
    newest = (
        batch.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(order, *others)).alias("newest"))
        .select(key, "newest.*")
        .select(*batch.columns)
    )
    return newest.unionByName(batch.where(F.col(key).isNull()))


def sync_columns(target: DataFrame, schema: T.StructType) -> DataFrame:
    """The target with the columns of ``schema``: new ones null, others dropped."""
    present = {f.name: f.dataType for f in target.schema}
    return target.select(
        *[
            (
                F.lit(None).cast(f.dataType)
                if f.name not in present
                else F.col(f.name) if present[f.name] == f.dataType
                else F.col(f.name).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )


def without_keys(target: DataFrame, keys: DataFrame, key: str, broadcast: bool = False) -> DataFrame:
    """Target rows whose key is not in ``keys``; rows without a key are kept.

    Null keys match nothing, so they bypass the join instead of all meeting in
    the one partition that null hashes to.
    """
    if broadcast:
        return target.join(F.broadcast(keys), key, "left_anti")
    keyed = target.where(F.col(key).isNotNull()).join(keys, key, "left_anti")
    return keyed.unionByName(target.where(F.col(key).isNull()))


def upsert(target: DataFrame, batch: DataFrame, key: str = "reading_id") -> DataFrame:
    """Batch rows replace target rows with the same key; the rest is added.

    The result has the columns of the batch.
    """
    keys = batch.select(key).where(F.col(key).isNotNull())
    kept = without_keys(sync_columns(target, batch.schema), keys, key)
    return kept.unionByName(batch)


# --- stored tables ----------------------------------------------------------


def _state(spark: SparkSession, path: str) -> dict | None:
    note = files.read_note(spark, f"{path}/{_SCHEMA_NOTE}")
    return json.loads(note) if note else None


def _save_state(spark: SparkSession, path: str, state: dict) -> None:
    files.write_note(spark, f"{path}/{_SCHEMA_NOTE}", json.dumps(state))


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    state = _state(spark, path)
    return T.StructType.fromJson(state["schema"]) if state else None


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a completed table lies at ``path``: its schema is noted last."""
    return stored_schema(spark, path) is not None


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The table under its current schema.

    Files written before a column was added read as null there, and a dropped
    column is no longer asked for, so a schema change rewrites no data.
    """
    schema = stored_schema(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.schema(schema).parquet(path).select(*schema.names)


@dataclass(frozen=True)
class Version:
    """A state of a stored table: which build it comes from, and the merges since."""

    build: str
    merges: int


def version(spark: SparkSession, path: str) -> Version | None:
    state = _state(spark, path)
    return Version(state.get("build", ""), state.get("merges", 0)) if state else None


def changed_dates(
    spark: SparkSession, path: str, since: Version | None
) -> list[dt.date | None] | None:
    """Dates that merges have changed since a version; None if that cannot be told.

    It cannot after a new build, after a merge that rewrote all dates, and from
    more than ``KEPT_CHANGES`` merges ago.
    """
    now = version(spark, path)
    if now is None or since is None or since.build != now.build or since.merges > now.merges:
        return None
    dates: set[dt.date | None] = set()
    for number in range(since.merges + 1, now.merges + 1):
        note = files.read_note(spark, _change_note(path, number))
        listed = json.loads(note)["dates"] if note else None
        if listed is None:
            return None
        dates |= {None if d is None else dt.date.fromisoformat(d) for d in listed}
    return sorted(dates, key=lambda d: d or dt.date.min)


def _change_note(path: str, number: int) -> str:
    return f"{path}/{_CHANGES}/{number:010d}.json"


def stored_mark(spark: SparkSession, path: str) -> dt.datetime | None:
    """The latest load time of a stored table, from its note; scanned where none is noted.

    A merge that replaces the rows of the latest load leaves it as it was.
    """
    state = _state(spark, path)
    if state and state.get("mark"):
        return dt.datetime.fromisoformat(state["mark"])
    return high_water_mark(read_stored(spark, path))


def create_table(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    partition: str = "reading_date",
    order: Sequence[str] = (),
) -> None:
    """Builds the table anew from all rows, written once and without a shuffle.

    An older table stays readable until the new one is complete. Within each file of
    a date the rows are sorted by ``order``, here and in later merges, so readers can
    skip row groups and pages by their statistics.
    """
    state = {
        "schema": rows.schema.jsonValue(),
        "dropped": [],
        "build": uuid.uuid4().hex,
        "merges": 0,
        "order": list(order),
    }
    rows = _clustered(rows, partition, order)
    if _MARK not in rows.columns:
        write_full(rows, path, partition, notes={_SCHEMA_NOTE: json.dumps(state)})
        return
    seen = Observation()
    rows = rows.observe(seen, _mark_text().alias("mark"))

    def note() -> str:
        return json.dumps({**state, "mark": seen.get["mark"]})

    write_full(rows, path, partition, notes={_SCHEMA_NOTE: note})


def _clustered(rows: DataFrame, partition: str, order: Sequence[str]) -> DataFrame:
    """Rows sorted within each task as they are to be written.

    Writing by date sorts by date anyway; this sorts once by date and the rest. A
    column that a merge has dropped no longer counts.
    """
    present = [c for c in order if c in rows.columns]
    return rows.sortWithinPartitions(partition, *present) if present else rows


def schema_notes(schema: T.StructType) -> dict[str, str]:
    """The side files by which ``read_stored`` reads a table that is written otherwise."""
    return {_SCHEMA_NOTE: json.dumps({"schema": schema.jsonValue(), "dropped": []})}


def _mark_text() -> Column:
    return F.max(_MARK).cast("string")


def build_table(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    key: str = "reading_id",
    partition: str = "reading_date",
    on_duplicate: str = "fail_matched",
    order: Sequence[str] = (),
) -> None:
    """Builds the table anew under a policy for keys that occur more than once.

    "latest" keeps the newest row of each key, "fail" raises and leaves an older
    table as it was, "fail_matched" keeps all rows, as nothing stored matches.
    """
    check_policy(on_duplicate)
    if on_duplicate == "latest":
        rows = latest_per_key(rows, key)
    elif on_duplicate == "fail" and not duplicate_keys(rows.select(key), key).isEmpty():
        raise DuplicateKeyError(f"{key} occurs more than once")
    create_table(spark, path, rows, partition, order)


def check_policy(on_duplicate: str) -> None:
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate is {on_duplicate!r}, not fail, latest or fail_matched")


def merge_into(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str = "reading_id",
    partition: str = "reading_date",
    on_duplicate: str = "fail",
    search_days: int | None = None,
    order: Sequence[str] = (),
) -> None:
    """Upserts a batch into a parquet table partitioned by date.

    Only dates that the batch, or a row it replaces, belongs to are rewritten.
    A missing or empty table is created from the whole batch as it is, repeated
    keys included (the uniqueness assertion reports those), and sorted by ``order``. What a later batch
    with a repeated key does is chosen by ``on_duplicate``: "fail" raises,
    "latest" keeps its newest row, and "fail_matched" raises only if the key is
    stored already and otherwise adds all its rows, as a merge statement does.

    Older rows of the keys are looked up in an index that the first merge builds and
    each one extends: only the dates that it names are searched. ``search_days``
    narrows them further, to so many days before the first and after the last date of
    the batch.

    One writer at a time. A run that died is finished by the next call, and
    merging a batch again changes nothing.
    """
    check_policy(on_duplicate)
    recover(spark, path)
    if not table_exists(spark, path) or read_stored(spark, path).isEmpty():
        # Nothing is stored that a repeated key could match.
        first = "latest" if on_duplicate == "latest" else "fail_matched"
        build_table(spark, path, batch, key, partition, first, order)
        return

    work = scratch(spark, "merge")
    # What a run left that died before it announced its swap.
    files.delete(spark, f"{path}/{_STAGED}")
    try:
        _merge(spark, path, batch, key, partition, on_duplicate, search_days, work)
    finally:
        files.delete(spark, work)
        # An announced swap still needs its folder; the call that completes it removes it.
        if files.read_note(spark, f"{path}/{_PENDING_NOTE}") is None:
            files.delete(spark, f"{path}/{_STAGED}")


def _merge(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str,
    partition: str,
    on_duplicate: str,
    search_days: int | None,
    work: str,
) -> None:
    state = _indexed(spark, path, key, partition)
    order = state.get("order", ())
    staged = f"{path}/{_STAGED}/rows"
    # The batch is used several times below, so it is stored once, and where all its
    # rows stay, as the files that the table will have.
    if on_duplicate == "latest":
        batch = _store(spark, batch, f"{work}/batch")
    else:
        batch = _stage(spark, batch, staged, partition, order)
    target = read_stored(spark, path)
    bucket = key_index.bucket_of(key, state["buckets"])
    size = F.sum(F.octet_length(F.col(key).cast("string")) + 16).alias("bytes")
    measures = [
        size,
        F.min(key).alias("first"),
        F.max(key).alias("last"),
        F.collect_set(F.when(F.col(key).isNotNull(), bucket)).alias("buckets"),
    ]
    if _MARK in batch.columns:
        measures.append(_mark_text().alias("mark"))
    found = batch.agg(*measures).first().asDict()
    keys = batch.select(key).where(F.col(key).isNotNull())

    index = key_index.read(spark, f"{path}/{_KEYS}", target.schema[key], target.schema[partition])
    located = key_index.lookup(
        index,
        keys.withColumn("bucket", bucket),
        key,
        sorted(found["buckets"]),
        (found["first"], found["last"]),
        -(-(found["bytes"] or 0) // max(1, BROADCAST_KEY_BYTES)),
    )
    located = _store(spark, located.select(key, partition), f"{work}/located")
    # The index names every stored key, so rows of other keys of the batch need not be looked for.
    sizes = located.groupBy(partition).agg(size).collect()  # dates
    small = sum(row["bytes"] for row in sizes) <= BROADCAST_KEY_BYTES
    # Sizes of well compressed files look small to Spark; what is too large is not broadcast.
    located = located.hint("broadcast" if small else "merge")
    known = located.select(key)
    searched = target.where(in_dates(partition, [row[partition] for row in sizes]))
    if search_days is not None:
        searched = near_dates(searched, batch, partition, search_days)

    repeated = duplicate_keys(batch, key)
    if on_duplicate == "latest":
        batch = _stage(spark, latest_per_key(batch, key), staged, partition, order)
        repeated = repeated.limit(0)
    else:
        refused = not repeated.isEmpty()
        if refused and on_duplicate == "fail_matched":
            matched = searched.select(key).join(repeated.select(key), key, "left_semi")
            refused = not matched.isEmpty()
        if refused:
            raise DuplicateKeyError(f"{key} occurs more than once in the batch")

    dropped = state["dropped"]
    dates = None
    if not _needs_rewrite(target.schema, batch.schema, dropped):
        dates = _touched_dates(searched, batch, known, key, partition)
    touched = target if dates is None else target.where(in_dates(partition, dates))
    kept = without_keys(sync_columns(touched, batch.schema), known, key, broadcast=small)
    _stage(spark, kept, staged, partition, order)

    named = key_index.entries(batch, key, partition, state["buckets"])
    same = (F.col(f"n.{key}") == F.col(f"o.{key}")) & F.col(f"n.{partition}").eqNullSafe(
        F.col(f"o.{partition}")
    )
    merges = state.get("merges", 0) + 1
    # Entries ahead of their rows do no harm, so they need no announcement.
    new = named.alias("n").join(located.alias("o"), same, "left_anti")
    key_index.write(new, key_index.added(f"{path}/{_KEYS}", 2 * merges), key)

    repeats = state.get("repeats")
    if repeats:
        listed = read_repeats(spark, path, state, target.schema[key])
        repeats = f"_repeats-{merges}"
        listed = listed.join(known, key, "left_anti")
        listed.unionByName(repeated).write.mode("overwrite").parquet(f"{path}/{repeats}")

    remaining = set(files.partition_dates(spark, staged, partition))
    before = dates if dates is not None else files.partition_dates(spark, path, partition)
    gone = {*dropped, *target.columns} - {*batch.columns}
    older = state.get("mark")
    if older is None and _MARK in target.columns:
        older = target.agg(_mark_text()).first()[0]
    marks = [m for m in (older, found.get("mark")) if m]
    pending = {
        "staged": staged,
        "partition": partition,
        "emptied": [_date_text(d) for d in before if d not in remaining],
        "changed": None if dates is None else [_date_text(d) for d in dates],
        "state": {
            **state,
            "schema": batch.schema.jsonValue(),
            # A full rewrite leaves no file that still holds a dropped column.
            "dropped": [] if dates is None else sorted(gone),
            "merges": merges,
            "mark": max(marks, key=dt.datetime.fromisoformat, default=None),
            "repeats": repeats,
        },
    }
    files.write_note(spark, f"{path}/{_PENDING_NOTE}", json.dumps(pending))
    recover(spark, path)


def _date_text(date: dt.date | None) -> str | None:
    return None if date is None else str(date)


def _indexed(spark: SparkSession, path: str, key: str, partition: str) -> dict:
    """The state of a table that has an index on this key; builds one if need be."""
    state = _state(spark, path)
    folder = f"{path}/{_KEYS}"
    target = read_stored(spark, path)
    if state.get("indexed") == [key, partition]:
        key_index.pack(spark, folder, target.schema[key], target.schema[partition])
        return state
    size = files.stored_bytes(spark, path)
    buckets = key_index.build(spark, folder, target, key, partition, size)
    state |= {"indexed": [key, partition], "buckets": buckets}
    if state.get("repeats_of") != key:
        state.pop("repeats", None)
    _save_state(spark, path, state)
    return state


def repeated_keys(spark: SparkSession, path: str, key: str = "reading_id") -> DataFrame:
    """Keys that occur more than once in a stored table, with their count.

    Counted once for all rows; merges keep the list up to date after that. They
    replace all rows of their keys, so only those keys can leave it or join it.
    """
    state = _state(spark, path)
    target = read_stored(spark, path)
    if state.get("repeats_of") != key or not state.get("repeats"):
        name = f"_repeats-{state.get('merges', 0)}"
        duplicate_keys(target, key).write.mode("overwrite").parquet(f"{path}/{name}")
        state |= {"repeats_of": key, "repeats": name}
        _save_state(spark, path, state)
    return read_repeats(spark, path, state, target.schema[key])


def read_repeats(spark: SparkSession, path: str, state: dict, key: T.StructField) -> DataFrame:
    schema = T.StructType([key]).add("n_records", T.LongType())
    return spark.read.schema(schema).parquet(f"{path}/{state['repeats']}")


def near_dates(target: DataFrame, batch: DataFrame, partition: str, days: int) -> DataFrame:
    """Rows of the target within ``days`` of the dates of a batch, or without a date."""
    first, last = batch.agg(F.min(partition), F.max(partition)).first()
    column = F.col(partition)
    if first is None:
        return target.where(column.isNull())
    margin = dt.timedelta(days=days)
    return target.where(column.between(first - margin, last + margin) | column.isNull())


def recover(spark: SparkSession, path: str) -> None:
    """Finishes a swap that was announced but not completed; safe to repeat."""
    files.restore_directory(spark, path)
    note = files.read_note(spark, f"{path}/{_PENDING_NOTE}")
    if note is None:
        return
    try:
        pending = json.loads(note)
    except json.JSONDecodeError:
        # Notes appear whole; a broken one is of an older writer and announced nothing.
        files.delete(spark, f"{path}/{_PENDING_NOTE}")
        return
    state, partition = pending["state"], pending["partition"]
    # A swap that an older version announced has its rows in its working folder.
    staged = pending.get("staged") or f"{pending['work']}/merged"
    files.move_partitions(spark, staged, path, partition)
    for date in pending["emptied"]:
        files.delete(spark, f"{path}/{files.partition_folder(partition, date)}")
    merges = state["merges"]
    files.write_note(
        spark, _change_note(path, merges), json.dumps({"dates": pending["changed"]})
    )
    files.delete(spark, _change_note(path, merges - KEPT_CHANGES))
    former = (_state(spark, path) or {}).get("repeats")
    _save_state(spark, path, state)
    if former and former != state["repeats"]:
        files.delete(spark, f"{path}/{former}")
    files.delete(spark, f"{path}/{_PENDING_NOTE}")
    files.delete(spark, f"{path}/{_STAGED}")


def _stage(
    spark: SparkSession, rows: DataFrame, folder: str, partition: str, order: Sequence[str]
) -> DataFrame:
    """Adds rows to a folder as the files of a table, and returns what lies there.

    Rebalancing groups rows by date for few files per date, and the adaptive plan splits
    a date that is much larger than the others. What is returned is listed at once, so
    files that are added later are not part of it.
    """
    dated = rows.hint("rebalance", partition)
    _clustered(dated, partition, order).write.mode("append").partitionBy(partition).parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder).select(*rows.columns)


def _store(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _touched_dates(
    target: DataFrame, batch: DataFrame, keys: DataFrame, key: str, partition: str
) -> list[dt.date | None]:
    """Dates of the batch and of the rows it replaces."""
    replaced = target.select(key, partition).join(keys, key, "left_semi").select(partition)
    return _distinct_dates(replaced.unionByName(batch.select(partition)), partition)


def _distinct_dates(frame: DataFrame, partition: str) -> list[dt.date | None]:
    return [row[0] for row in frame.select(partition).distinct().collect()]


def in_dates(partition: str, dates: list[dt.date | None]) -> Column:
    """Whether a row is of one of these dates; None stands for rows without one."""
    known = [d for d in dates if d is not None]
    condition = F.col(partition).isin(known)
    return condition | F.col(partition).isNull() if None in dates else condition


def _needs_rewrite(old: T.StructType, new: T.StructType, dropped: list[str]) -> bool:
    """Whether reading old files under the new schema would give wrong values.

    That is so for a changed type, and for a column that was dropped earlier and
    comes back: old files still hold its former values.
    """
    types = {f.name: f.dataType for f in old}
    changed = any(f.name in types and types[f.name] != f.dataType for f in new)
    revived = any(f.name in dropped and f.name not in types for f in new)
    return changed or revived
