"""Tables derived from a stored table date by date, brought up to date by the dates that changed."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from sensorlake.operators import upsert
from sensorlake.sources import files
from sensorlake.sources.tables import replace_dates, write_full

_SOURCE_NOTE = "_source.json"


def source_version(spark: SparkSession, path: str) -> upsert.Version | None:
    """The version of its source that a derived table was made from."""
    note = files.read_note(spark, f"{path}/{_SOURCE_NOTE}")
    return upsert.Version(**json.loads(note)) if note else None


def refresh_by_date(
    spark: SparkSession,
    source: str,
    path: str,
    make: Callable[[DataFrame], DataFrame],
    partition: str = "reading_date",
) -> None:
    """Makes a table again whose rows of a date depend on the source's rows of that date only.

    Only the dates that merges into the source have changed since are read and
    replaced; other date folders keep their files. After a new build of the source,
    or where the changes cannot be told or the columns differ, all dates are made.

    The version is noted last, so a run that died is repeated by the next call.
    """
    files.restore_directory(spark, path)
    now, before = upsert.version(spark, source), source_version(spark, path)
    if now == before:
        return
    rows = upsert.read_stored(spark, source)
    dates = upsert.changed_dates(spark, source, before)
    whole = make(rows)
    noted = upsert.schema_notes(whole.schema) | {_SOURCE_NOTE: json.dumps(asdict(now))}
    if dates is None or upsert.stored_schema(spark, path) != whole.schema:
        write_full(whole, path, partition, notes=noted)
        return
    changed = make(rows.where(upsert.in_dates(partition, dates)))
    replace_dates(changed, path, partition, dates)
    files.write_note(spark, f"{path}/{_SOURCE_NOTE}", noted[_SOURCE_NOTE])


def refresh_whole(
    spark: SparkSession, source: str, path: str, make: Callable[[DataFrame], DataFrame]
) -> None:
    """Makes a table again from all of a derived one, if that has changed."""
    files.restore_directory(spark, path)
    now = source_version(spark, source)
    if now == source_version(spark, path):
        return
    rows = make(upsert.read_stored(spark, source))
    noted = upsert.schema_notes(rows.schema) | {_SOURCE_NOTE: json.dumps(asdict(now))}
    write_full(rows, path, notes=noted)
