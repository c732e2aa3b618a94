"""Scalar rules of the silver and gold models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The limits the classification rules compare with.
TEMP_HIGH = 35
TEMP_LOW = 10
CRITICAL_ERRORS = 10
WARNING_ERRORS = 3

# Doubles beyond this do not fit decimal(38,10).
_DECIMAL_LIMIT = 1e27


def variant_field(raw: str, key: str, kind: str, strict: bool = True) -> Column:
    """One typed field of a variant object; absent key and JSON null give null.

    ``strict`` raises on a value that does not convert, otherwise it gives null.
    Integers come through double and are rounded, so 4.6 is 5 and not 4.
    """
    get = F.variant_get if strict else F.try_variant_get
    path = f"$.{key}"
    if kind != "int":
        return get(raw, path, kind)
    whole = F.round(get(raw, path, "double"))
    return whole.cast("int") if strict else whole.try_cast("int")


def reading_date(raw: str) -> Column:
    """Calendar date of the reading as written, or null when it does not parse."""
    return F.try_variant_get(raw, "$.timestamp", "string").try_cast("date")


def quality_flag() -> Column:
    """First matching rule wins; a null anomaly label counts as valid."""
    temperature = F.col("temperature_celsius")
    return (
        F.when(temperature.isNull(), "SENSOR_NULL_TEMP")
        .when((temperature > TEMP_HIGH) | (temperature < TEMP_LOW), "OUT_OF_RANGE_TEMP")
        .when(F.col("energy_consumption_kwh").isNull(), "SENSOR_NULL_ENERGY")
        .when(F.col("anomaly_type") != "NORMAL", "ANOMALY_DETECTED")
        .otherwise("VALID")
    )


def time_bucket() -> Column:
    """Bucket of the hour as written; a null timestamp is off hours."""
    hour = F.hour("reading_timestamp")
    return (
        F.when(hour.between(8, 18), "BUSINESS_HOURS")
        .when(hour.between(19, 22), "EVENING")
        .otherwise("OFF_HOURS")
    )


def temp_deviation() -> Column:
    return F.col("temperature_celsius") - F.col("setpoint_celsius")


def health_status(error_count: Column) -> Column:
    return (
        F.when(error_count > CRITICAL_ERRORS, "CRITICAL")
        .when(error_count > WARNING_ERRORS, "WARNING")
        .otherwise("HEALTHY")
    )


def round_half_away(value: Column, digits: int) -> Column:
    """Round halves away from zero.

    The value is first brought to ten decimals, so the last-bit noise of a sum of
    doubles (which depends on the order partitions arrive in) cannot flip a tie.
    """
    quantised = F.round(value.cast("decimal(38,10)"), digits).cast("double")
    return F.when(F.abs(value) < _DECIMAL_LIMIT, quantised).otherwise(F.round(value, digits))


def count_where(predicate: Column) -> Column:
    """Rows for which the predicate holds; null does not count."""
    return F.count(F.when(predicate, 1))


def percent(part: Column, whole: Column) -> Column:
    return part * F.lit(100e0) / whole
