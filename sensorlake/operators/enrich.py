"""Left join of readings to the building dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


class DuplicateKeyError(ValueError):
    """A key that must be unique is not."""


def sized_dimension(buildings: DataFrame) -> DataFrame:
    """Checks the key of the dimension and allows a broadcast only if it is small.

    A repeated key would multiply readings in the join, so it is an error. A
    larger dimension goes without a hint: the sort-merge join then relies on the
    adaptive skew split for buildings that hold much of the data.
    """
    columns = buildings.select("building_id", "building_name", "city", "country")
    found = columns.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("building_id").alias("keyed"),
        F.count_distinct("building_id").alias("keys"),
    ).first()
    if found["keyed"] != found["keys"]:
        raise DuplicateKeyError("building_id is not unique in the building dimension")
    return F.broadcast(columns) if found["rows"] <= BROADCAST_ROWS else columns


def with_building(readings: DataFrame, dimension: DataFrame) -> DataFrame:
    """Adds name, city and country; a reading of an unknown building keeps nulls."""
    return readings.join(dimension, "building_id", "left")
