"""Gold: building-day energy, unit health, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import schemas
from sensorlake.functions import columns as fn


def energy_summary(silver: DataFrame) -> DataFrame:
    """One row per building and date; readings flagged for null energy are left out.

    All measures are partially aggregated before the one small shuffle, so a
    building or date with much of the data costs no more than others.
    """
    anomalies = fn.count_where(F.col("quality_flag") == "ANOMALY_DETECTED")
    total = F.count(F.lit(1))
    return (
        silver.where(F.col("quality_flag") != "SENSOR_NULL_ENERGY")
        .groupBy("building_id", "building_name", "city", "country", "reading_date")
        .agg(
            total.alias("total_readings"),
            fn.round_half_away(F.sum("energy_consumption_kwh"), 2).alias("total_energy_kwh"),
            fn.round_half_away(F.avg("energy_consumption_kwh"), 3).alias("avg_energy_kwh"),
            fn.round_half_away(F.avg("temperature_celsius"), 2).alias("avg_temperature"),
            fn.round_half_away(F.avg("humidity_pct"), 2).alias("avg_humidity"),
            anomalies.alias("anomaly_count"),
            fn.count_where(F.col("compressor_status") == "ERROR").alias("error_count"),
            fn.round_half_away(fn.percent(anomalies, total), 2).alias("anomaly_rate_pct"),
        )
    )


_UNIT = ["unit_id", "building_id", "building_name", "zone_id"]


def equipment_health(silver: DataFrame) -> DataFrame:
    """One row per unit over all history, with a label from its error-code count."""
    errors = fn.count_where(F.col("error_code").isNotNull())
    return silver.groupBy(*_UNIT).agg(
        F.count(F.lit(1)).alias("total_readings"),
        fn.round_half_away(F.avg("temperature_celsius"), 2).alias("avg_temperature"),
        fn.round_half_away(F.avg("energy_consumption_kwh"), 3).alias("avg_energy_kwh"),
        F.sum("runtime_minutes").alias("total_runtime_minutes"),
        errors.alias("error_count"),
        fn.count_where(F.col("compressor_status") == "ERROR").alias("compressor_error_count"),
        fn.count_where(F.col("anomaly_type") != "NORMAL").alias("anomaly_count"),
        F.max("reading_date").alias("last_reading_date"),
        fn.health_status(errors).alias("health_status"),
    )


def health_parts(silver: DataFrame) -> DataFrame:
    """What the health of a unit is made of, by date: sums and counts that can be added up."""
    return silver.groupBy(*_UNIT, "reading_date").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum("temperature_celsius").alias("temperature"),
        F.count("temperature_celsius").alias("temperatures"),
        F.sum("energy_consumption_kwh").alias("energy"),
        F.count("energy_consumption_kwh").alias("energies"),
        F.sum("runtime_minutes").alias("runtime"),
        F.count("error_code").alias("errors"),
        fn.count_where(F.col("compressor_status") == "ERROR").alias("compressor_errors"),
        fn.count_where(F.col("anomaly_type") != "NORMAL").alias("anomalies"),
    )


def health_of_parts(parts: DataFrame) -> DataFrame:
    """The health of all units from their parts; the same rows as ``equipment_health``."""

    def mean(total: str, count: str) -> Column:
        return F.sum(total) / F.nullif(F.sum(count), F.lit(0))

    errors = F.sum("errors")
    return parts.groupBy(*_UNIT).agg(
        F.sum("readings").alias("total_readings"),
        fn.round_half_away(mean("temperature", "temperatures"), 2).alias("avg_temperature"),
        fn.round_half_away(mean("energy", "energies"), 3).alias("avg_energy_kwh"),
        F.sum("runtime").alias("total_runtime_minutes"),
        errors.alias("error_count"),
        F.sum("compressor_errors").alias("compressor_error_count"),
        F.sum("anomalies").alias("anomaly_count"),
        F.max("reading_date").alias("last_reading_date"),
        fn.health_status(errors).alias("health_status"),
    )


def anomaly_alerts(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Readings that are not valid, newest first, null times before all others.

    The scan position breaks ties, so the range shuffle can also split a time
    that very many alerts share.
    """
    alerts = silver.where(F.col("quality_flag") != "VALID").select(*schemas.ALERT_COLUMNS)
    if not ordered:
        return alerts
    return (
        alerts.withColumn("_tie", F.monotonically_increasing_id())
        .orderBy(F.desc_nulls_first("reading_timestamp"), "_tie")
        .drop("_tie")
    )


def stored_alerts(silver: DataFrame) -> DataFrame:
    """The alerts as they are stored: by date, newest first within each file.

    Stored silver lies by date already, so this needs no shuffle; a reader that
    wants a global order sorts the dates it reads.
    """
    alerts = anomaly_alerts(silver, ordered=False)
    return alerts.sortWithinPartitions("reading_date", F.desc_nulls_first("reading_timestamp"))


def stored_energy(silver: DataFrame) -> DataFrame:
    """The energy summary with the few rows of a date together, for one file per date."""
    return energy_summary(silver).hint("rebalance", "reading_date")


def stored_health_parts(silver: DataFrame) -> DataFrame:
    return health_parts(silver).hint("rebalance", "reading_date")


MODELS = {
    "gold_building_energy_summary": energy_summary,
    "gold_equipment_health": equipment_health,
    "gold_anomaly_alerts": anomaly_alerts,
}
