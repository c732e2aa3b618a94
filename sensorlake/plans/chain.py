"""The whole chain: load, silver, gold, assertions; the first failure stops it."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sensorlake.operators import assertions, upsert
from sensorlake.plans import bronze, derived, gold, silver
from sensorlake.plans.bronze import BronzeStore
from sensorlake.session import sized_shuffles
from sensorlake.sources import files


@dataclass(frozen=True)
class Lake:
    """Paths of a lake below one root."""

    root: str

    @property
    def bronze(self) -> BronzeStore:
        return BronzeStore(f"{self.root}/bronze")

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/silver_sensor_readings"

    def gold(self, model: str) -> str:
        return f"{self.root}/gold/{model}"


    @property
    def health_parts(self) -> str:
        return self.gold("equipment_health_by_date")

    @property
    def violations(self) -> str:
        return f"{self.root}/checks/silver_sensor_readings"


def build_gold(spark: SparkSession, lake: Lake) -> None:
    """Brings the gold tables up to date with the stored silver table.

    Silver is read back from storage, and only the dates that its merges have
    changed: energy and alerts are replaced by date, and health is added up from
    parts by unit and date. Tables made from the present silver stay as they are.
    """
    refresh = derived.refresh_by_date
    refresh(spark, lake.silver, lake.gold("gold_building_energy_summary"), gold.stored_energy)
    refresh(spark, lake.silver, lake.gold("gold_anomaly_alerts"), gold.stored_alerts)
    refresh(spark, lake.silver, lake.health_parts, gold.stored_health_parts)
    health = lake.gold("gold_equipment_health")
    derived.refresh_whole(spark, lake.health_parts, health, gold.health_of_parts)


def check_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """Requires all assertions on silver; only dates that have changed are read for it.

    Violations are stored by date, and repeated ids are kept up to date by the merges.
    """

    def by_date(readings: DataFrame) -> DataFrame:
        found = assertions.violations(readings, by=["reading_date"])
        return found.hint("rebalance", "reading_date")

    derived.refresh_by_date(spark, lake.silver, lake.violations, by_date)
    repeated = {c: upsert.repeated_keys(spark, lake.silver, c) for c in assertions.UNIQUE}
    found = upsert.read_stored(spark, lake.violations)
    return assertions.require_pass(silver.read(spark, lake.silver), found, repeated)


def run(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    buildings: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    check: bool = True,
    full: bool = False,
    on_cast_error: str = "fail",
    on_duplicate: str = "fail_matched",
    search_days: int | None = None,
) -> int:
    """Loads new files of the window and brings all tables up to date.

    Returns the rows loaded; raises at the end if an assertion has failing rows.
    Every step can be repeated after a failure: files are loaded once, merging
    again changes nothing, gold follows the dates that changed. ``full`` rebuilds
    silver from all of bronze, and gold from all of it; the policies and ``search_days`` are those of ``silver.refresh``.
    """
    loaded = bronze.load_new_files(spark, landing, lake.bronze, start, end)
    with sized_shuffles(spark, files.stored_bytes(spark, lake.bronze.readings)):
        silver.refresh(
            spark, lake.bronze, buildings, lake.silver, full, on_cast_error, on_duplicate,
            search_days,
        )
        build_gold(spark, lake)
        if check:
            check_silver(spark, lake)
    return loaded
