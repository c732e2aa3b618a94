"""Data-quality assertions: an assertion yields failing rows, none is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import schemas
from sensorlake.operators.upsert import duplicate_keys

# The eight assertions on silver.
UNIQUE = ["reading_id"]
NOT_NULL = ["reading_id", "building_id", "quality_flag", "reading_timestamp"]
ACCEPTED = {
    "building_id": schemas.BUILDING_IDS,
    "quality_flag": schemas.QUALITY_FLAGS,
    "compressor_status": schemas.COMPRESSOR_STATES,
}


class AssertionsFailed(RuntimeError):
    """Some assertion on the silver table has failing rows."""


def unique(frame: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return duplicate_keys(frame, column)


def not_null(frame: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return frame.where(F.col(column).isNull())


def accepted_values(frame: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their row counts; null passes."""
    return (
        frame.where(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def violations(
    silver: DataFrame,
    not_null_columns: Sequence[str] = NOT_NULL,
    accepted: Mapping[str, Sequence[str]] = ACCEPTED,
    by: Sequence[str] = (),
) -> DataFrame:
    """``test, column, value, n_records`` of missing and unexpected values, in one scan.

    Few readings violate anything, so a filter comes first and only the rest is
    turned into rows, one for each violation.
    """
    nothing = F.lit(None).cast("string")
    checks = [("not_null", c, F.col(c).isNull(), nothing) for c in not_null_columns]
    checks += [
        ("accepted_values", c, ~F.col(c).isin(list(values)), F.col(c).cast("string"))
        for c, values in accepted.items()
    ]
    found = [
        F.when(bad, F.struct(F.lit(t).alias("test"), F.lit(c).alias("column"), v.alias("value")))
        for t, c, bad, v in checks
    ]
    suspects = silver.where(reduce(Column.__or__, [F.coalesce(bad, F.lit(False)) for _, _, bad, _ in checks]))
    listed = F.filter(F.array(*found), lambda violation: violation.isNotNull())
    return (
        suspects.select(*by, F.inline(listed))
        .groupBy(*by, "test", "column", "value")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def run_suite(
    silver: DataFrame,
    not_null_columns: Sequence[str] = NOT_NULL,
    accepted: Mapping[str, Sequence[str]] = ACCEPTED,
    unique_columns: Sequence[str] = UNIQUE,
    found: DataFrame | None = None,
    repeated: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per assertion: test, column, failures, status.

    ``failures`` is the number of rows the assertion yields, so for accepted
    values it counts the values, not the readings. Missing and unexpected values
    take one column-pruned scan; the repeated values of each unique column are the
    only ones with a large shuffle (that column alone). Both can be handed in where
    they are stored: ``found`` as rows of ``violations``, for any parts of silver,
    and ``repeated`` as rows of ``unique`` by column.
    """
    parts = []
    names = [("not_null", c) for c in not_null_columns]
    names += [("accepted_values", c) for c in accepted]
    if names:
        if found is None:
            found = violations(silver, not_null_columns, accepted)
        parts.append(_failures(found, names))
    for column in unique_columns:
        values = (repeated or {}).get(column)
        values = unique(silver, column) if values is None else values
        counted = values.agg(F.count(F.lit(1)).alias("failures"))
        parts.append(counted.select(F.lit("unique").alias("test"), F.lit(column).alias("column"), "failures"))
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail")
    )


def _failures(found: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per assertion, also for those without any violation."""
    value = F.col("test") == "accepted_values"
    yielded = F.when(value, F.lit(1)).otherwise(F.col("n_records"))
    counts = (
        found.groupBy("test", "column", "value")
        .agg(F.sum("n_records").alias("n_records"))
        .agg(
            *[
                F.coalesce(
                    F.sum(F.when((F.col("test") == t) & (F.col("column") == c), yielded)),
                    F.lit(0),
                ).alias(f"{t} {c}")
                for t, c in names
            ]
        )
    )
    results = [
        F.struct(F.lit(t).alias("test"), F.lit(c).alias("column"), F.col(f"{t} {c}").alias("failures"))
        for t, c in names
    ]
    return counts.select(F.inline(F.array(*results)))


def require_pass(
    silver: DataFrame,
    found: DataFrame | None = None,
    repeated: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Runs the suite once and raises if any assertion failed."""
    results = run_suite(silver, found=found, repeated=repeated).collect()  # one row per assertion
    failed = [f"{r['test']}({r['column']}): {r['failures']}" for r in results if r["failures"]]
    if failed:
        raise AssertionsFailed("; ".join(sorted(failed)))
    return silver
