"""Scalar rules on rows at the edges of every branch."""

import json

import pytest
from pyspark.sql import functions as F

from sensorlake import schemas
from sensorlake.functions import columns as fn
from sensorlake.operators import assertions
from sensorlake.plans import gold, silver

# id, building, timestamp, temperature, energy, anomaly -> flag, bucket, deviation
EDGES = [
    ("e01", "BLDG_001", "2026-01-01T08:00:00Z", 21.5, 2.0, "NORMAL", "VALID", "BUSINESS_HOURS", 0.5),
    ("e02", "BLDG_001", "2026-01-01T18:59:59Z", 35.0, 2.0, "NORMAL", "VALID", "BUSINESS_HOURS", 14.0),
    ("e03", "BLDG_001", "2026-01-01T19:00:00Z", 35.01, 2.0, "NORMAL", "OUT_OF_RANGE_TEMP", "EVENING", 14.01),
    ("e04", "BLDG_002", "2026-01-01T22:59:59Z", 10.0, 2.0, "NORMAL", "VALID", "EVENING", -11.0),
    ("e05", "BLDG_002", "2026-01-01T23:00:00Z", 9.99, 2.0, "NORMAL", "OUT_OF_RANGE_TEMP", "OFF_HOURS", -11.01),
    ("e06", "BLDG_002", "2026-01-01T07:59:59Z", None, None, "SENSOR_ERROR", "SENSOR_NULL_TEMP", "OFF_HOURS", None),
    ("e07", "BLDG_003", "2026-01-01T12:00:00Z", 22.0, None, "EXCESSIVE_ENERGY", "SENSOR_NULL_ENERGY", "BUSINESS_HOURS", 1.0),
    ("e08", "BLDG_003", "2026-01-01T12:00:00Z", 22.0, 9.5, "EXCESSIVE_ENERGY", "ANOMALY_DETECTED", "BUSINESS_HOURS", 1.0),
    ("e09", "BLDG_003", "2026-01-01T12:00:00Z", 40.0, None, "TEMPERATURE_SPIKE", "OUT_OF_RANGE_TEMP", "BUSINESS_HOURS", 19.0),
    ("e10", "BLDG_004", "2026-01-01T12:00:00Z", 22.0, 2.0, None, "VALID", "BUSINESS_HOURS", 1.0),
    ("e11", "BLDG_999", "2026-01-01T12:00:00+04:00", 22.0, 2.0, "normal", "ANOMALY_DETECTED", "BUSINESS_HOURS", 1.0),
    ("e12", None, None, 22.0, 0.0, "NORMAL", "VALID", "OFF_HOURS", None),
]


def bronze_of(spark, lines):
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    return frame.select(
        F.try_parse_json("line").alias("raw_data"),
        F.lit("2026-01-02 00:00:00").cast("timestamp_ntz").alias("load_timestamp"),
    ).withColumn("reading_date", fn.reading_date("raw_data"))


@pytest.fixture(scope="module", params=["UTC", "Asia/Dubai"])
def edge_silver(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    lines = []
    for rid, building, moment, temperature, energy, anomaly, *_ in EDGES:
        lines.append(
            json.dumps(
                {
                    "reading_id": rid,
                    "building_id": building,
                    "timestamp": moment,
                    "temperature_celsius": temperature,
                    "energy_consumption_kwh": energy,
                    "anomaly_type": anomaly,
                    "setpoint_celsius": None if rid == "e12" else 21.0,
                }
            )
        )
    yield silver.build(bronze_of(spark, lines), schemas.buildings(spark))
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_edges(edge_silver):
    rows = {r["reading_id"]: r for r in edge_silver.collect()}
    assert len(rows) == len(EDGES)
    for rid, _, _, _, _, _, flag, bucket, deviation in EDGES:
        assert (rows[rid]["quality_flag"], rows[rid]["time_bucket"]) == (flag, bucket), rid
        if deviation is None:
            assert rows[rid]["temp_deviation_celsius"] is None
        else:
            assert rows[rid]["temp_deviation_celsius"] == pytest.approx(deviation)
    assert str(rows["e11"]["reading_timestamp"]) == "2026-01-01 12:00:00"
    assert rows["e11"]["building_name"] is None
    assert rows["e12"]["reading_date"] is None
    assert rows["e01"]["building_name"] == "Emirates Tower Complex"
    assert edge_silver.columns == schemas.SILVER_COLUMNS


def test_edge_assertions(edge_silver):
    found = {(r["test"], r["column"]): r["failures"] for r in assertions.run_suite(edge_silver).collect()}
    assert found == {
        ("unique", "reading_id"): 0,
        ("not_null", "reading_id"): 0,
        ("not_null", "building_id"): 1,
        ("not_null", "quality_flag"): 0,
        ("not_null", "reading_timestamp"): 1,
        ("accepted_values", "building_id"): 1,
        ("accepted_values", "quality_flag"): 0,
        ("accepted_values", "compressor_status"): 0,
    }


def test_alert_order(edge_silver):
    times = [r["reading_timestamp"] for r in gold.anomaly_alerts(edge_silver).collect()]
    assert times == sorted(times, reverse=True) and len(times) == 7


def test_null_time_comes_first(spark):
    rows = spark.sql(
        """select * from values ('a', timestamp_ntz'2026-01-01 00:00:00'), ('b', null),
           ('c', timestamp_ntz'2026-01-02 00:00:00') as t(reading_id, reading_timestamp)"""
    )
    rest = [c for c in schemas.ALERT_COLUMNS if c not in rows.columns + ["quality_flag"]]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in rest}).withColumn(
        "quality_flag", F.lit("OUT_OF_RANGE_TEMP")
    )
    assert [r["reading_id"] for r in gold.anomaly_alerts(rows).collect()] == ["b", "c", "a"]


def test_int_field_rounds(spark):
    got = bronze_of(spark, ['{"runtime_minutes": 4.6}', '{"runtime_minutes": 2.5}', '{"runtime_minutes": "3"}'])
    values = [r[0] for r in got.select(fn.variant_field("raw_data", "runtime_minutes", "int")).collect()]
    assert values == [5, 3, 3]


def test_missing_null_and_odd_roots(spark):
    frame = bronze_of(spark, ['{"reading_id": null}', "{}", "[1,2]", "5", "null"])
    rows = silver.extract(frame).drop("load_timestamp").collect()
    assert len(rows) == 5 and all(v is None for r in rows for v in r)


def test_bad_value_fails_or_becomes_null(spark):
    frame = bronze_of(spark, ['{"reading_id": "x", "timestamp": "nope", "temperature_celsius": "warm"}'])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID_INPUT"):
        silver.extract(frame).collect()
    row = silver.enrich(silver.extract(frame, "null"), schemas.buildings(spark)).first()
    assert row["reading_date"] is None and row["reading_timestamp"] is None
    assert (row["time_bucket"], row["quality_flag"]) == ("OFF_HOURS", "SENSOR_NULL_TEMP")


def test_bad_value_fails_from_stored_bronze_too(spark, tmp_path):
    """Fields read straight from parquet must be as strict as from memory."""
    lines = ['{"reading_id": "x", "temperature_celsius": "warm"}', '{"temperature_celsius": "21.5"}']
    bronze_of(spark, lines).write.parquet(f"{tmp_path}/b")
    stored = spark.read.parquet(f"{tmp_path}/b")
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID_INPUT"):
        silver.extract(stored).collect()
    values = {r["temperature_celsius"] for r in silver.extract(stored, "null").collect()}
    assert values == {None, 21.5}


def test_rounding_halves_away_from_zero(spark):
    values = [0.285, -0.285, 2.675, 0.125, 1e30, float("nan"), None]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in frame.select(fn.round_half_away(F.col("x"), 2)).collect()]
    assert got[:5] == [0.29, -0.29, 2.68, 0.13, 1e30]
    assert got[5] != got[5] and got[6] is None


@pytest.mark.parametrize("errors,label", [(0, "HEALTHY"), (3, "HEALTHY"), (4, "WARNING"), (10, "WARNING"), (11, "CRITICAL")])
def test_health_label(spark, errors, label):
    rows = spark.range(12).select(
        F.lit("u").alias("unit_id"),
        F.lit("b").alias("building_id"),
        F.lit("n").alias("building_name"),
        F.lit("z").alias("zone_id"),
        F.lit(20.0).alias("temperature_celsius"),
        F.lit(None).cast("double").alias("energy_consumption_kwh"),
        F.lit(1).alias("runtime_minutes"),
        F.when(F.col("id") < errors, "E001").alias("error_code"),
        F.lit("RUNNING").alias("compressor_status"),
        F.lit(None).cast("string").alias("anomaly_type"),
        F.lit("2026-01-01").cast("date").alias("reading_date"),
    )
    row = gold.equipment_health(rows).first()
    assert (row["error_count"], row["health_status"]) == (errors, label)
    assert (row["avg_energy_kwh"], row["anomaly_count"], row["total_runtime_minutes"]) == (None, 0, 12)


def test_suite_counts_repeats_and_values(spark):
    rows = spark.sql(
        """select * from values
        ('a', 'BLDG_001', 'VALID', 'RUNNING'), ('a', 'BLDG_007', 'VALID', 'MAINTENANCE'),
        ('b', 'BLDG_007', 'VALID', null), ('b', 'BLDG_008', 'VALID', 'OFF'), (null, null, 'VALID', 'OFF'),
        (null, null, 'VALID', 'IDLE') as t(reading_id, building_id, quality_flag, compressor_status)"""
    ).withColumn("reading_timestamp", F.lit("2026-01-01").cast("timestamp_ntz"))
    got = {(r["test"], r["column"]): (r["failures"], r["status"]) for r in assertions.run_suite(rows).collect()}
    assert got[("unique", "reading_id")] == (2, "fail")
    assert got[("not_null", "reading_id")] == (2, "fail")
    assert got[("accepted_values", "building_id")] == (2, "fail")
    assert got[("accepted_values", "compressor_status")] == (2, "fail")
    assert got[("accepted_values", "quality_flag")] == (0, "pass")
    with pytest.raises(assertions.AssertionsFailed, match=r"unique\(reading_id\): 2"):
        assertions.require_pass(rows)
