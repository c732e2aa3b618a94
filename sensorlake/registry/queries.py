"""Every operator as a named query: ``(spark, sf_dir) -> DataFrame``.

All of them read the whole ``events`` table, as readings or as raw JSON. Those
that need files write them below the shared folder first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import adapter, schemas
from sensorlake.functions import columns as fn
from sensorlake.operators import assertions, upsert
from sensorlake.plans import bronze, chain, gold, silver
from sensorlake.plans.bronze import BronzeStore
from sensorlake.session import scratch
from sensorlake.sources import files, json_lines, ndjson, tables
from sensorlake.streaming import follow

Query = Callable[[SparkSession, str], DataFrame]

# The week of ``load_window``.
WINDOW = (dt.date(2024, 1, 10), dt.date(2024, 1, 17))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich(adapter.readings(spark, sf_dir), schemas.buildings(spark))


def _truncated(lines: DataFrame, broken: Column) -> DataFrame:
    """Cuts the closing brace off some lines, as a torn transmission would."""
    cut = F.expr("left(line, length(line) - 1)")
    return lines.withColumn("line", F.when(broken, cut).otherwise(F.col("line")))


def _landing(spark: SparkSession, typed: DataFrame, root: str | None = None) -> str:
    root = root or f"{scratch(spark, 'landing')}/raw/sensors"
    ndjson.write_days(adapter.records(typed), root)
    return root


def _append(typed: DataFrame, root: str) -> None:
    """Adds files to days that already have some."""
    (
        adapter.records(typed)
        .withColumns(ndjson.day_columns(F.col("timestamp").cast("date")))
        .hint("rebalance", "year", "month", "day")
        .write.mode("append")
        .options(**ndjson.JSON_OPTIONS)
        .partitionBy("year", "month", "day")
        .json(root)
    )


# --- bronze -----------------------------------------------------------------


def bronze_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.json_lines(adapter.readings(spark, sf_dir))
    return silver.extract(adapter.as_bronze(lines))


def tolerant_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps of failing units are unreadable: null time, null date, off hours."""
    lines = adapter.json_lines(adapter.readings(spark, sf_dir))
    failing = F.get_json_object("line", "$.error_code").isNotNull()
    garbled = F.regexp_replace("line", '"timestamp":"[^"]*"', '"timestamp":"unknown"')
    lines = lines.withColumn("line", F.when(failing, garbled).otherwise(F.col("line")))
    typed = silver.extract(adapter.as_bronze(lines), on_cast_error="null")
    return typed.select(
        "reading_id", "reading_timestamp", "reading_date", fn.time_bucket().alias("time_bucket")
    )


def bad_record_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.json_lines(adapter.readings(spark, sf_dir))
    broken = F.get_json_object("line", "$.error_code").isNotNull()
    return silver.extract(adapter.as_bronze(_truncated(lines, broken)))


def load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines loaded and rejected per day, from the per-file report of a load."""
    lines = adapter.json_lines(adapter.readings(spark, sf_dir))
    broken = F.get_json_object("line", "$.error_code").isNotNull()
    days = ndjson.day_columns(F.col("reading_date"))
    root = f"{scratch(spark, 'landing')}/raw/sensors"
    (
        _truncated(lines, broken)
        .select("line", *[c.alias(name) for name, c in days.items()])
        .hint("rebalance", *days)
        .write.partitionBy(*days)
        .text(root)
    )
    store = BronzeStore(scratch(spark, "bronze"))
    bronze.load_new_files(spark, root, store, glob="*.txt")
    return (
        bronze.read_file_log(spark, store)
        .withColumn("reading_date", _date_of_path(F.col("source_file_name")))
        .groupBy("reading_date")
        .agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))
    )


def _date_of_path(path: Column) -> Column:
    part = [F.regexp_extract(path, f"{name}=(\\d+)", 1).cast("int") for name in ("year", "month", "day")]
    return F.make_date(*part)


def write_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = adapter.records(adapter.readings(spark, sf_dir))
    manifest = ndjson.write_days(records, f"{scratch(spark, 'landing')}/raw/sensors")
    return manifest.select("date", "record_count", "version")


def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that have files, and whether every file is a non-empty JSON file."""
    root = _landing(spark, adapter.readings(spark, sf_dir))
    return (
        files.list_files(spark, root)
        .groupBy(json_lines.path_day().alias("reading_date"))
        .agg(F.bool_and(F.col("path").endswith(".json") & (F.col("length") > 0)).alias("all_json"))
    )


def load_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landing(spark, adapter.readings(spark, sf_dir))
    raw = json_lines.parse(json_lines.scan(spark, root, *WINDOW))
    typed = raw.withColumns(
        {"reading_date": fn.reading_date("raw_data"), "load_timestamp": F.lit(None).cast("timestamp_ntz")}
    )
    return silver.extract(typed).drop("load_timestamp")


def skip_existing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The early days are there in an older version; the second write adds the rest."""
    typed = adapter.readings(spark, sf_dir)
    older = typed.where(adapter.is_early()).withColumn("data_quality_flag", F.lit("OLDER"))
    root = _landing(spark, older)
    _landing(spark, typed, root)
    raw = json_lines.parse(json_lines.scan(spark, root))
    return raw.select(
        fn.variant_field("raw_data", "reading_id", "string").alias("reading_id"),
        fn.variant_field("raw_data", "data_quality_flag", "string").alias("data_quality_flag"),
    )


def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day: lines, and files whose numbers are not exactly 1..n."""
    root = _landing(spark, adapter.readings(spark, sf_dir))
    store = BronzeStore(scratch(spark, "bronze"))
    bronze.load_new_files(spark, root, store)
    number = F.col("source_file_row_num")
    n = F.col("n")
    # n numbers with the sum and the sum of squares of 1..n, from 1 to n.
    wrong = (
        (F.col("low") != 1)
        | (F.col("high") != n)
        | (F.col("total") * 2 != n * (n + 1))
        | (F.col("squares") * 6 != (n * (n + 1) * (2 * n + 1)).cast("decimal(38,0)"))
    )
    return (
        bronze.read_bronze(spark, store)
        .groupBy("source_file_name", "reading_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(number).alias("low"),
            F.max(number).alias("high"),
            F.sum(number).alias("total"),
            F.sum((number * number).cast("decimal(38,0)")).alias("squares"),
        )
        .groupBy("reading_date")
        .agg(F.sum(n).alias("lines"), fn.count_where(wrong).alias("misnumbered_files"))
    )


def file_load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of a growing folder: early days, later days, nothing new."""
    typed = adapter.readings(spark, sf_dir)
    store = BronzeStore(scratch(spark, "bronze"))
    root = _landing(spark, typed.where(adapter.is_early()))
    bronze.load_new_files(spark, root, store)
    _append(typed.where(~adapter.is_early()), root)
    bronze.load_new_files(spark, root, store)
    bronze.load_new_files(spark, root, store)
    return _by_load(spark, store)


def _by_load(spark: SparkSession, store: BronzeStore) -> DataFrame:
    """Rows per load and day; the first load is 1."""
    counts = (
        bronze.read_bronze(spark, store)
        .groupBy("load_batch", "reading_date")
        .agg(F.count(F.lit(1)).alias("rows_loaded"))
    )
    number = F.regexp_extract("load_batch", r"(\d+)$", 1).cast("bigint")
    return counts.select((number + 1).alias("load_number"), "reading_date", "rows_loaded")


def stream_load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same growing folder followed by a stream with a checkpoint."""
    typed = adapter.readings(spark, sf_dir)
    store = BronzeStore(scratch(spark, "bronze"))
    checkpoint = scratch(spark, "follow")
    root = _landing(spark, typed.where(adapter.is_early()))
    follow.to_bronze(spark, root, store, checkpoint).awaitTermination()
    _append(typed.where(~adapter.is_early()), root)
    follow.to_bronze(spark, root, store, checkpoint).awaitTermination()
    follow.to_bronze(spark, root, store, checkpoint).awaitTermination()
    return _by_load(spark, store)


# --- silver -----------------------------------------------------------------


def quality_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        adapter.readings(spark, sf_dir)
        .groupBy(fn.quality_flag().alias("quality_flag"))
        .agg(F.count(F.lit(1)).alias("readings"))
    )


def time_bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        adapter.readings(spark, sf_dir)
        .groupBy(fn.time_bucket().alias("time_bucket"))
        .agg(F.count(F.lit(1)).alias("readings"))
    )


def temp_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.readings(spark, sf_dir).select(
        "reading_id", fn.temp_deviation().alias("temp_deviation_celsius")
    )


def building_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select(
        "reading_id", "building_id", "building_name", "city", "country"
    )


def silver_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.json_lines(adapter.readings(spark, sf_dir))
    return silver.build(adapter.as_bronze(lines), schemas.buildings(spark))


def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.publish_view(_silver(spark, sf_dir), "staged_readings")
    return spark.sql(
        "select country, time_bucket, count(*) as readings from staged_readings group by 1, 2"
    )


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = upsert.high_water_mark(adapter.readings(spark, sf_dir))
    return spark.range(1).select(upsert.ntz_literal(mark).alias("load_timestamp"))


def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = adapter.readings(spark, sf_dir)
    mark = upsert.high_water_mark(typed.where(adapter.is_early()))
    return upsert.newer_than(typed, mark)


def _second_batch(typed: DataFrame) -> DataFrame:
    return typed.where(~adapter.is_early()).unionByName(adapter.corrections(typed))


def upsert_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = adapter.readings(spark, sf_dir)
    return upsert.upsert(typed.where(adapter.is_early()), _second_batch(typed))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions of the corrected readings in one batch: the newer one stays."""
    typed = adapter.readings(spark, sf_dir)
    return upsert.latest_per_key(typed.unionByName(adapter.corrections(typed)), "reading_id")


def merge_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two batches merged into a stored table, the second one twice."""
    typed = adapter.readings(spark, sf_dir)
    path = scratch(spark, "silver")
    dimension = schemas.buildings(spark)
    for batch in (typed.where(adapter.is_early()), _second_batch(typed), _second_batch(typed)):
        upsert.merge_into(spark, path, silver.enrich(batch, dimension))
    return silver.read(spark, path)


def schema_sync_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = adapter.readings(spark, sf_dir)
    batch = _second_batch(typed).withColumn("site", F.concat(F.lit("SITE_"), F.right("building_id", F.lit(1))))
    return upsert.upsert(typed.where(adapter.is_early()), batch)


def schema_sync_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = adapter.readings(spark, sf_dir)
    return upsert.upsert(
        typed.where(adapter.is_early()), _second_batch(typed).drop("data_quality_flag")
    )


def schema_sync_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column joins and another leaves a stored table; old files stay as they are."""
    typed = adapter.readings(spark, sf_dir)
    path = scratch(spark, "silver")
    upsert.merge_into(spark, path, typed.where(adapter.is_early()))
    batch = _second_batch(typed).drop("data_quality_flag")
    batch = batch.withColumn("site", F.concat(F.lit("SITE_"), F.right("building_id", F.lit(1))))
    upsert.merge_into(spark, path, batch)
    return upsert.read_stored(spark, path)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early readings, then the rest and corrections, as files followed by a stream."""
    typed = adapter.readings(spark, sf_dir)
    store = BronzeStore(scratch(spark, "bronze"))
    path, checkpoint = scratch(spark, "silver"), scratch(spark, "follow")
    dimension = schemas.buildings(spark)
    root = _landing(spark, typed.where(adapter.is_early()))
    follow.to_silver(spark, root, store, dimension, path, checkpoint).awaitTermination()
    _append(_second_batch(typed), root)
    follow.to_silver(spark, root, store, dimension, path, checkpoint).awaitTermination()
    # The load time is that of the wall clock here.
    return silver.read(spark, path).drop("load_timestamp")


# --- gold -------------------------------------------------------------------


def gold_building_energy_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.energy_summary(_silver(spark, sf_dir))


def gold_equipment_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.equipment_health(_silver(spark, sf_dir))


def gold_anomaly_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.anomaly_alerts(_silver(spark, sf_dir))


def _chained(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    typed = adapter.readings(spark, sf_dir)
    lake = chain.Lake(scratch(spark, "lake"))
    root = _landing(spark, typed)
    # The unknown building makes an assertion fail on purpose, so none is required.
    chain.run(spark, root, lake, schemas.buildings(spark), check=False)
    return tables.Sources(spark, {name: lake.gold(name) for name in gold.MODELS}).table(model)


def chain_energy_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chained(spark, sf_dir, "gold_building_energy_summary")


def chain_equipment_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chained(spark, sf_dir, "gold_equipment_health")


def chain_anomaly_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chained(spark, sf_dir, "gold_anomaly_alerts")


def chain_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the chain, the second with later readings and corrections of old ones.

    The gold tables after it: energy per building and day, health per unit, and the
    alerts counted by flag and day.
    """
    typed = adapter.readings(spark, sf_dir)
    lake = chain.Lake(scratch(spark, "lake"))
    dimension = schemas.buildings(spark)
    root = _landing(spark, typed.where(adapter.is_early()))
    chain.run(spark, root, lake, dimension, check=False)
    _append(_second_batch(typed), root)
    chain.run(spark, root, lake, dimension, check=False)
    stored = tables.Sources(spark, {name: lake.gold(name) for name in gold.MODELS}).table
    measures = ["total_readings", "avg_temperature", "avg_energy_kwh", "error_count", "anomaly_count"]
    energy = stored("gold_building_energy_summary").select(
        F.lit("energy").alias("model"), F.col("building_id").alias("name"),
        F.col("reading_date").alias("date"), "avg_humidity", *measures,
    )
    health = stored("gold_equipment_health").select(
        F.lit("health").alias("model"), F.col("unit_id").alias("name"),
        F.col("last_reading_date").alias("date"), *measures,
    )
    alerts = (
        stored("gold_anomaly_alerts")
        .groupBy(F.col("quality_flag").alias("name"), F.col("reading_date").alias("date"))
        .agg(F.count(F.lit(1)).alias("total_readings"))
        .withColumn("model", F.lit("alerts"))
    )
    few = {"allowMissingColumns": True}
    return energy.unionByName(health, **few).unionByName(alerts, **few)


# --- assertions -------------------------------------------------------------


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections appended instead of merged: their ids occur twice."""
    typed = adapter.readings(spark, sf_dir)
    return assertions.unique(typed.unionByName(adapter.corrections(typed)), "reading_id")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = assertions.run_suite(_silver(spark, sf_dir), accepted={}, unique_columns=[])
    return suite.select("column", "failures")


def dq_not_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rows of an assertion that does fail."""
    return assertions.not_null(_silver(spark, sf_dir), "anomaly_type").select("reading_id")


def dq_accepted_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.accepted_values(
        _silver(spark, sf_dir), "building_id", schemas.BUILDING_IDS
    )


def _accepted_only(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    only = {column: assertions.ACCEPTED[column]}
    return assertions.run_suite(_silver(spark, sf_dir), [], only, [])


def dq_accepted_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted_only(spark, sf_dir, "quality_flag")


def dq_accepted_compressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted_only(spark, sf_dir, "compressor_status")


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.run_suite(_silver(spark, sf_dir))


def dq_suite_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assertion fails: repeated ids, lost buildings, unknown flags and states."""
    sound = _silver(spark, sf_dir)
    humidity = F.col("humidity_pct")
    broken = sound.withColumns(
        {
            "building_id": F.when(F.col("compressor_status") != "ERROR", F.col("building_id")),
            "quality_flag": F.when(humidity > 60, F.concat(F.lit("FLAG_"), "zone_id")).otherwise(
                F.col("quality_flag")
            ),
            "compressor_status": F.when(humidity < 50, "OFF").otherwise(F.col("compressor_status")),
        }
    )
    return assertions.run_suite(broken.unionByName(sound.where(humidity == 55)))


QUERIES: dict[str, Query] = {
    "bronze_extract": bronze_extract,
    "tolerant_casts": tolerant_casts,
    "bad_record_skip": bad_record_skip,
    "load_manifest": load_manifest,
    "write_manifest": write_manifest,
    "list_files": list_files,
    "load_window": load_window,
    "skip_existing_days": skip_existing_days,
    "row_numbers": row_numbers,
    "file_load_once": file_load_once,
    "stream_load_once": stream_load_once,
    "quality_flag_counts": quality_flag_counts,
    "time_bucket_counts": time_bucket_counts,
    "temp_deviation": temp_deviation,
    "building_enrich": building_enrich,
    "silver": silver_readings,
    "staging_view": staging_view,
    "high_water_mark": high_water_mark,
    "incremental_slice": incremental_slice,
    "upsert_corrections": upsert_corrections,
    "upsert_latest": upsert_latest,
    "merge_stored": merge_stored,
    "schema_sync_add": schema_sync_add,
    "schema_sync_drop": schema_sync_drop,
    "schema_sync_stored": schema_sync_stored,
    "stream_upsert": stream_upsert,
    "gold_building_energy_summary": gold_building_energy_summary,
    "gold_equipment_health": gold_equipment_health,
    "gold_anomaly_alerts": gold_anomaly_alerts,
    "chain_energy_summary": chain_energy_summary,
    "chain_equipment_health": chain_equipment_health,
    "chain_anomaly_alerts": chain_anomaly_alerts,
    "chain_incremental": chain_incremental,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_not_null_rows": dq_not_null_rows,
    "dq_accepted_building": dq_accepted_building,
    "dq_accepted_flag": dq_accepted_flag,
    "dq_accepted_compressor": dq_accepted_compressor,
    "dq_suite": dq_suite,
    "dq_suite_failing": dq_suite_failing,
}
