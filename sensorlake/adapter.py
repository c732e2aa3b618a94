"""The ``events`` table seen as sensor readings, typed or as raw JSON.

Gives the models input with cases worth testing: missing temperatures and
energies, null labels, an unknown building.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import schemas
from sensorlake.functions import columns as fn
from sensorlake.operators.upsert import ntz_literal
from sensorlake.sources.json_lines import accepted
from sensorlake.sources.ndjson import JSON_OPTIONS

# The incremental fixture.
SPLIT = dt.datetime(2024, 1, 16)
CORRECTED_AT = dt.datetime(2024, 2, 1)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed readings with ``reading_date`` and ``load_timestamp``."""
    event_id, user_id, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    building = F.concat(F.lit("BLDG_00"), (user_id % 6 + 1).cast("string"))
    zone = F.concat(
        F.lit("ZONE_"),
        F.substr(F.lit("ABCD"), (F.floor(user_id / 6) % 4 + 1).cast("int"), F.lit(1)),
    )
    serial = (F.floor(user_id / 24) % 5 + 1).cast("string")
    failing = (kind == "error") & (event_id % 4 == 0)
    day = F.col("ts").cast("date")
    return events(spark, sf_dir).select(
        F.concat(F.lit("R"), event_id.cast("string")).alias("reading_id"),
        building.alias("building_id"),
        zone.alias("zone_id"),
        F.concat(F.lit("AC_"), building, F.lit("_"), zone, F.lit("_00"), serial).alias("unit_id"),
        F.col("ts").alias("reading_timestamp"),
        F.when(event_id % 50 != 0, F.lit(9.5) + F.col("value") / F.lit(10.0)).alias("temperature_celsius"),
        (40 + event_id % 30).cast("double").alias("humidity_pct"),
        F.when(event_id % 40 != 0, F.get_json_object("props", "$.k").cast("int") / F.lit(10.0)).alias(
            "energy_consumption_kwh"
        ),
        (event_id % 6).cast("int").alias("runtime_minutes"),
        (F.lit(20.0) + (user_id % 31) / F.lit(10.0)).alias("setpoint_celsius"),
        F.when(kind == "error", "ERROR")
        .when(kind == "view", "IDLE")
        .when(kind == "signup", "STANDBY")
        .otherwise("RUNNING")
        .alias("compressor_status"),
        F.when(failing, F.concat(F.lit("E00"), (event_id % 5 + 1).cast("string"))).alias("error_code"),
        F.when(event_id % 33 == 0, None)
        .when(failing, "UNIT_MALFUNCTION")
        .when((kind == "purchase") & (event_id % 25 == 1), "EXCESSIVE_ENERGY")
        .otherwise("NORMAL")
        .alias("anomaly_type"),
        F.lit("RAW").alias("data_quality_flag"),
        day.alias("reading_date"),
        (day.cast("timestamp_ntz") + F.expr("interval 1 day")).alias("load_timestamp"),
    )


def is_early() -> Column:
    """Readings of the first incremental batch."""
    return F.col("reading_timestamp") < ntz_literal(SPLIT)


def corrections(typed: DataFrame) -> DataFrame:
    """Later versions of the early readings of failing units, with another humidity."""
    return typed.where(is_early() & (F.col("compressor_status") == "ERROR")).withColumns(
        {
            "humidity_pct": F.col("humidity_pct") + 1,
            "load_timestamp": ntz_literal(CORRECTED_AT),
        }
    )


def _record_columns() -> list[Column]:
    keys = [F.col(column).alias(key) for key, column, _ in schemas.READING_FIELDS]
    return [*keys[:5], F.col("load_timestamp").alias("ingestion_timestamp"), *keys[5:]]


def records(typed: DataFrame) -> DataFrame:
    """The fifteen keys of a raw record as columns."""
    return typed.select(*_record_columns())


def json_lines(typed: DataFrame) -> DataFrame:
    """Each reading as one JSON line, with its load time and date."""
    line = F.to_json(F.struct(*_record_columns()), JSON_OPTIONS)
    return typed.select(line.alias("line"), "load_timestamp", "reading_date")


def as_bronze(lines: DataFrame) -> DataFrame:
    """Parsed lines with the bronze columns that silver reads; rejects left out."""
    records = accepted(lines.select("line", "load_timestamp"))
    return records.withColumn("reading_date", fn.reading_date("raw_data"))
