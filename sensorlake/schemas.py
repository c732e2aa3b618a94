"""Table schemas and the fixed values the models and assertions refer to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "variant": T.VariantType(),
}


def struct(columns: str) -> T.StructType:
    """A schema from "name type, ..."; works before any session exists."""
    fields = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


BRONZE = struct(
    """
    load_id string, load_timestamp timestamp_ntz, source_file_name string,
    source_file_row_num bigint, raw_data variant, reading_date date,
    load_batch string
    """
)

QUARANTINE = struct(
    """
    load_timestamp timestamp_ntz, source_file_name string,
    source_file_row_num bigint, line string, load_batch string
    """
)

# How loaded lines are stored: where a line stood instead of its number, which
# follows from the splits of its load.
_PLACE = "split_start bigint, scan_seq bigint, part bigint, load_batch string"
LANDED = struct(
    f"""
    load_id string, load_timestamp timestamp_ntz, source_file_name string,
    raw_data variant, reading_date date, {_PLACE}
    """
)
LANDED_REJECTS = struct(
    f"load_timestamp timestamp_ntz, source_file_name string, line string, {_PLACE}"
)
SPLITS = struct(
    """
    source_file_name string, split_start bigint, first_seq bigint, lines bigint,
    accepted bigint, shift bigint, part bigint, load_batch string
    """
)

FILE_LOG = struct(
    """
    source_file_name string, rows_loaded bigint, rows_rejected bigint,
    load_timestamp timestamp_ntz, load_batch string
    """
)

DIM_BUILDINGS = struct(
    """
    building_id string, building_name string, city string, country string,
    total_floors bigint, total_sqft bigint, hvac_units_count bigint,
    commissioned_date date, created_at timestamp_ntz
    """
)

# Declared, but no model reads or fills it.
DIM_EQUIPMENT = struct(
    """
    unit_id string, building_id string, zone_id string, equipment_type string,
    manufacturer string, model_number string, install_date date,
    expected_lifespan_years bigint, rated_capacity_kw double, is_active boolean,
    created_at timestamp_ntz
    """
)

# JSON key, silver column, type.
READING_FIELDS = [
    ("reading_id", "reading_id", "string"),
    ("building_id", "building_id", "string"),
    ("zone_id", "zone_id", "string"),
    ("unit_id", "unit_id", "string"),
    ("timestamp", "reading_timestamp", "timestamp_ntz"),
    ("temperature_celsius", "temperature_celsius", "double"),
    ("humidity_pct", "humidity_pct", "double"),
    ("energy_consumption_kwh", "energy_consumption_kwh", "double"),
    ("runtime_minutes", "runtime_minutes", "int"),
    ("setpoint_celsius", "setpoint_celsius", "double"),
    ("compressor_status", "compressor_status", "string"),
    ("error_code", "error_code", "string"),
    ("anomaly_type", "anomaly_type", "string"),
    ("data_quality_flag", "data_quality_flag", "string"),
]

READING_COLUMNS = [column for _, column, _ in READING_FIELDS]

SILVER_COLUMNS = READING_COLUMNS + [
    "reading_date",
    "load_timestamp",
    "building_name",
    "city",
    "country",
    "quality_flag",
    "time_bucket",
    "temp_deviation_celsius",
]

#: How silver is sorted within the files of a date.
SILVER_ORDER = ["unit_id", "reading_timestamp"]

ALERT_COLUMNS = [
    "reading_id",
    "unit_id",
    "building_id",
    "building_name",
    "city",
    "zone_id",
    "reading_timestamp",
    "reading_date",
    "anomaly_type",
    "quality_flag",
    "temperature_celsius",
    "energy_consumption_kwh",
    "compressor_status",
    "error_code",
    "temp_deviation_celsius",
]

# Accepted values asserted on silver.
BUILDING_IDS = ["BLDG_001", "BLDG_002", "BLDG_003", "BLDG_004", "BLDG_005"]
QUALITY_FLAGS = [
    "VALID",
    "ANOMALY_DETECTED",
    "SENSOR_NULL_TEMP",
    "OUT_OF_RANGE_TEMP",
    "SENSOR_NULL_ENERGY",
]
COMPRESSOR_STATES = ["RUNNING", "IDLE", "STANDBY", "ERROR"]

# The building dimension.
BUILDING_ROWS = [
    ("BLDG_001", "Emirates Tower Complex", "Dubai", "UAE", 54, 320000, 120, "2008-06-15"),
    ("BLDG_002", "Al Maryah Plaza", "Abu Dhabi", "UAE", 38, 210000, 95, "2012-03-22"),
    ("BLDG_003", "Doha Business Gate", "Doha", "Qatar", 32, 180000, 80, "2014-11-08"),
    ("BLDG_004", "Riyadh Financial Centre", "Riyadh", "Saudi Arabia", 28, 150000, 65, "2016-04-01"),
    ("BLDG_005", "Sharjah Innovation Hub", "Sharjah", "UAE", 18, 95000, 45, "2018-09-30"),
]


def buildings(spark: SparkSession) -> DataFrame:
    """The seeded building dimension, as an inline table the optimizer can size."""
    rows = ", ".join(
        f"('{bid}', '{name}', '{city}', '{country}', {floors}L, {sqft}L, {units}L, "
        f"date '{commissioned}', localtimestamp())"
        for bid, name, city, country, floors, sqft, units, commissioned in BUILDING_ROWS
    )
    return spark.sql(f"select * from values {rows} as t({', '.join(DIM_BUILDINGS.names)})")
