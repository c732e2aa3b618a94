"""Silver: typed, enriched and classified readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import schemas
from sensorlake.functions import columns as fn
from sensorlake.operators import upsert
from sensorlake.operators.enrich import sized_dimension, with_building
from sensorlake.plans.bronze import BronzeStore, read_since


def extract(bronze: DataFrame, on_cast_error: str = "fail") -> DataFrame:
    """Typed reading fields of the raw records, with date and load time carried on.

    A value that does not convert fails the query; ``on_cast_error="null"`` gives
    null instead.
    """
    if on_cast_error not in ("fail", "null"):
        raise ValueError(f"on_cast_error must be 'fail' or 'null', not {on_cast_error!r}")
    strict = on_cast_error == "fail"
    fields = [
        fn.variant_field("raw_data", key, kind, strict).alias(column)
        for key, column, kind in schemas.READING_FIELDS
    ]
    return bronze.select(*fields, "reading_date", "load_timestamp")


def classify(readings: DataFrame) -> DataFrame:
    """Adds quality flag, time bucket and deviation from the setpoint."""
    return readings.withColumns(
        {
            "quality_flag": fn.quality_flag(),
            "time_bucket": fn.time_bucket(),
            "temp_deviation_celsius": fn.temp_deviation(),
        }
    )


def enrich(readings: DataFrame, buildings: DataFrame) -> DataFrame:
    """The silver columns of typed readings; the dimension's key is checked here."""
    joined = with_building(readings, sized_dimension(buildings))
    rest = [c for c in readings.columns if c not in schemas.SILVER_COLUMNS]
    return classify(joined).select(*schemas.SILVER_COLUMNS, *rest)


def build(
    bronze: DataFrame,
    buildings: DataFrame,
    mark: dt.datetime | None = None,
    on_cast_error: str = "fail",
) -> DataFrame:
    """Silver rows of all bronze rows loaded after the mark."""
    return enrich(extract(upsert.newer_than(bronze, mark), on_cast_error), buildings)


def refresh(
    spark: SparkSession,
    store: BronzeStore,
    buildings: DataFrame,
    path: str,
    full: bool = False,
    on_cast_error: str = "fail",
    on_duplicate: str = "fail_matched",
    search_days: int | None = None,
) -> None:
    """Brings the stored silver table up to date with bronze.

    With rows already present only loads newer than the noted mark are read and merged
    by ``reading_id``; silver itself is not scanned for it. A missing or empty table, or ``full``, builds it from all of
    bronze; a full build also brings later dimension changes to old readings.

    ``on_duplicate`` holds for both: "latest" keeps the newest row of a repeated
    id, "fail" raises, and "fail_matched" raises only for ids stored already, so
    a build keeps all rows and the uniqueness assertion reports them.
    ``search_days`` bounds how far from a batch's dates its older versions can lie.
    """
    upsert.check_policy(on_duplicate)
    upsert.recover(spark, path)
    mark = None
    if not full and upsert.table_exists(spark, path):
        mark = upsert.stored_mark(spark, path)
    rows = build(read_since(spark, store, mark), buildings, mark, on_cast_error)
    if mark is None:
        upsert.build_table(
            spark, path, rows, on_duplicate=on_duplicate, order=schemas.SILVER_ORDER
        )
    else:
        upsert.merge_into(
            spark, path, rows, on_duplicate=on_duplicate, search_days=search_days,
            order=schemas.SILVER_ORDER,
        )


def read(spark: SparkSession, path: str) -> DataFrame:
    return upsert.read_stored(spark, path)
