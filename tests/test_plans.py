"""What the plans must look like to hold at a thousand times the data."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from sensorlake import adapter, schemas, session
from sensorlake.operators import assertions, row_numbers, upsert
from sensorlake.plans import bronze, chain, gold, silver
from sensorlake.registry.queries import QUERIES
from sensorlake.sources import json_lines, ndjson


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+partitioning)", text)


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    landing = f"{root}/raw/sensors"
    ndjson.write_days(adapter.records(adapter.readings(spark, sf_dir)), landing)
    lake = chain.Lake(root)
    chain.run(spark, landing, lake, schemas.buildings(spark), check=False)
    return lake


def test_window_prunes_directories(spark, lake):
    lines = json_lines.scan(spark, f"{lake.root}/raw/sensors", start=dt.date(2024, 1, 10))
    assert re.search(r"PartitionFilters: \[.*make_date\(year", plan(lines))
    bounded = json_lines.scan(spark, f"{lake.root}/raw/sensors", dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    assert len(bounded.inputFiles()) == 2


def test_fields_are_read_from_bronze_without_the_record(spark, lake):
    text = plan(silver.extract(bronze.read_bronze(spark, lake.bronze, row_numbers=False)))
    assert "variant_get" not in text and not exchanges(text)


def test_silver_reads_only_new_loads(spark, lake):
    (label,) = [r[0] for r in bronze.read_bronze(spark, lake.bronze).select("load_batch").distinct().collect()]
    assert bronze.land(spark, json_lines.scan(spark, f"{lake.root}/raw/sensors"), lake.bronze, "later") > 0
    since = bronze.read_since(spark, lake.bronze, dt.datetime(2020, 1, 1))
    assert {f.split("load_batch=")[1].split("/")[0] for f in since.inputFiles()} == {label, "later"}
    only = bronze.read_load(spark, lake.bronze, label)
    assert all(f"load_batch={label}/" in f for f in only.inputFiles())
    newer = upsert.newer_than(bronze.read_bronze(spark, lake.bronze), dt.datetime(2020, 1, 1))
    assert "GreaterThan(load_timestamp" in plan(newer)


def test_silver_build_has_no_shuffle(spark, lake):
    text = plan(silver.build(bronze.read_since(spark, lake.bronze, None), schemas.buildings(spark)))
    assert "BroadcastHashJoin" in text and not exchanges(text)


@pytest.mark.parametrize("model,columns", [(gold.energy_summary, 10), (gold.equipment_health, 11)])
def test_gold_aggregates_before_its_only_shuffle(spark, lake, model, columns):
    text = plan(model(silver.read(spark, lake.silver)))
    assert exchanges(text) == ["hashpartitioning"] and "partial_count" in text
    read = re.search(r"FileScan parquet \[(.*?)\]", text).group(1)
    assert read.count("#") == columns


def test_alerts_filter_reaches_the_scan_and_stored_form_has_no_shuffle(spark, lake):
    readings = silver.read(spark, lake.silver)
    text = plan(gold.anomaly_alerts(readings))
    assert exchanges(text) == ["rangepartitioning"]
    assert "Not(EqualTo(quality_flag,VALID))" in text
    assert not exchanges(plan(gold.anomaly_alerts(readings, ordered=False)))
    stored = spark.read.parquet(lake.gold("gold_anomaly_alerts"))
    assert stored.count() == gold.anomaly_alerts(readings).count()


def test_assertions_scan_once_and_shuffle_ids_only(spark, lake):
    text = plan(assertions.run_suite(silver.read(spark, lake.silver)))
    scans = re.findall(r"FileScan parquet \[(.*?)\]", text)
    dates = [scan.count("reading_date#") for scan in scans]
    assert sorted(scan.count("#") - n for scan, n in zip(scans, dates)) == [1, 5]


def test_target_rows_without_key_bypass_the_join(spark, lake):
    readings = silver.read(spark, lake.silver)
    keys = readings.select("reading_id").where("reading_id is not null")
    text = plan(upsert.without_keys(readings, keys, "reading_id"))
    assert "IsNotNull(reading_id)" in text and "IsNull(reading_id)" in text


def test_split_offsets_window_sees_splits_not_lines(spark):
    staged = spark.range(10).selectExpr("'f' source_file_name", "0L split_start", "id scan_seq")
    text = plan(row_numbers.split_offsets(staged))
    assert text.index("Window") < text.index("HashAggregate")


def test_hot_key_is_split_by_the_rebalance(spark, tmp_path):
    """One date with nearly all rows is written by several tasks."""
    rows = spark.range(200_000).selectExpr(
        "uuid() reading_id", "if(id % 100 = 0, date'2026-01-02', date'2026-01-01') reading_date"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        path = f"{tmp_path}/t"
        rows.repartition(8).hint("rebalance", "reading_date").write.partitionBy("reading_date").parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = spark.read.parquet(path).where("reading_date = date'2026-01-01'")
    assert len(hot.inputFiles()) > 2 and hot.count() == 198_000


@pytest.mark.parametrize("name", ["silver", "upsert_corrections", "dq_suite", "gold_anomaly_alerts", "incremental_slice"])
def test_no_pairwise_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "SinglePartition, ENSURE"):
        assert operator not in text or (operator.startswith("Single") and name == "dq_suite")


def test_shuffles_are_sized_by_the_table(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with session.sized_shuffles(spark, 10**14):
        assert spark.conf.get(key) == "100000"
    with session.sized_shuffles(spark, 10**11):
        assert spark.conf.get(key) == "1490"
    assert spark.conf.get(key, None) is None
    with session.sized_shuffles(spark, 1000):
        assert spark.conf.get(key, None) is None


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_declared_schemas(spark):
    assert schemas.buildings(spark).schema.names == schemas.DIM_BUILDINGS.names
    assert [f.dataType for f in schemas.buildings(spark).schema] == [f.dataType for f in schemas.DIM_BUILDINGS]
    assert len(schemas.DIM_EQUIPMENT) == 11
    assert schemas.buildings(spark).agg(F.sum("total_floors")).first()[0] == 170
