"""What a merge reads, what it leaves for the tables after it, and what those read."""

import datetime as dt
import json
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorlake import adapter, schemas
from sensorlake.operators import assertions, key_index, upsert
from sensorlake.operators.assertions import AssertionsFailed
from sensorlake.plans import bronze, chain, derived, gold, silver
from sensorlake.registry.queries import _append, _landing
from sensorlake.sources import files
from sensorlake.streaming import follow


def day(n):
    return dt.date(2026, 1, n)


@pytest.fixture
def history(spark):
    """Thirty days with twenty readings each."""
    return spark.range(600).select(
        F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("reading_id"),
        F.date_add(F.lit(day(1)), (F.col("id") / 20).cast("int")).alias("reading_date"),
        F.col("id").alias("value"),
        F.lit("2026-03-01 00:00:00").cast("timestamp_ntz").alias("load_timestamp"),
    )


def later(rows, condition, days=0):
    return rows.where(condition).withColumns(
        {
            "value": F.col("value") + 1000,
            "reading_date": F.date_add("reading_date", days),
            "load_timestamp": F.lit("2026-03-02 00:00:00").cast("timestamp_ntz"),
        }
    )


def partitions_read(frame):
    """The plan and the values that its partition filters allow."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    allowed = " ".join(re.findall(r"PartitionFilters: \[(.*?)\]", plan))
    return plan, set(re.findall(r"\d{4}-\d\d-\d\d|\b\d+\b", re.sub(r"#\d+", "", allowed)))


@pytest.fixture
def opened(monkeypatch):
    """Plans of lookups in the index and of searches for replaced rows, with their partitions."""
    seen = {"index": [], "dates": []}
    lookup, touched = key_index.lookup, upsert._touched_dates

    def looked_up(*args):
        found = lookup(*args)
        seen["index"].append(partitions_read(found))
        return found

    def searched(target, *args):
        plan, dates = partitions_read(target.select("reading_id"))
        seen["dates"].append(sorted(dates))
        assert "FileScan" not in plan or "reading_date" in plan.split("PartitionFilters")[1]
        return touched(target, *args)

    monkeypatch.setattr(key_index, "lookup", looked_up)
    monkeypatch.setattr(upsert, "_touched_dates", searched)
    return seen


def test_batch_opens_its_buckets_and_its_dates(spark, tmp_path, history, monkeypatch, opened):
    monkeypatch.setattr(key_index, "BUCKET_BYTES", 1000)
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    upsert.merge_into(spark, path, later(history, "value in (7, 107)"))
    plan, found = opened["index"][0]
    keys = spark.createDataFrame([("r0007",), ("r0107",)], "reading_id string")
    buckets = upsert._state(spark, path)["buckets"]
    wanted = {str(r[0]) for r in keys.select(key_index.bucket_of("reading_id", buckets)).collect()}
    assert buckets > 10 and found == wanted
    assert "GreaterThanOrEqual(reading_id,r0007)" in plan
    assert opened["dates"] == [["2026-01-01", "2026-01-06"]]
    # The rows of a later batch lie where the first one put them.
    upsert.merge_into(spark, path, later(history, "value = 107", days=5))
    upsert.merge_into(spark, path, later(history, "value = 107", days=7))
    assert opened["dates"][1:] == [["2026-01-06"], ["2026-01-06", "2026-01-11"]]
    got = upsert.read_stored(spark, path)
    assert got.count() == 600
    assert [r.reading_date for r in got.where("reading_id = 'r0107'").collect()] == [day(13)]


def test_new_keys_open_no_date(spark, tmp_path, history, opened):
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    new = later(history, "value < 5").withColumn("reading_id", F.concat("reading_id", F.lit("x")))
    before = {d: os.listdir(f"{path}/reading_date={d}") for d in map(str, map(day, range(2, 31)))}
    upsert.merge_into(spark, path, new)
    assert opened["dates"] == [[]]
    assert before == {d: os.listdir(f"{path}/reading_date={d}") for d in before}
    assert upsert.read_stored(spark, path).count() == 605


@pytest.mark.parametrize("most,shuffled", [(64, False), (1, True)])
def test_large_batch_is_looked_up_in_pieces(spark, tmp_path, history, monkeypatch, opened, most, shuffled):
    monkeypatch.setattr(key_index, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(key_index, "MOST_PIECES", most)
    monkeypatch.setattr(upsert, "BROADCAST_KEY_BYTES", 500)
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    batch = later(history, "value % 7 = 0", days=1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        upsert.merge_into(spark, path, batch)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = opened["index"][0][0]
    assert ("Exchange hashpartitioning" in plan) == shuffled
    assert shuffled or plan.count("BroadcastExchange") > 2
    wanted = upsert.upsert(history, batch)
    got = upsert.read_stored(spark, path)
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_stream_opens_its_dates(spark, sf_dir, tmp_path, opened):
    typed = adapter.readings(spark, sf_dir)
    early = typed.where(adapter.is_early())
    root = _landing(spark, early, f"{tmp_path}/raw/sensors")
    store, path = bronze.BronzeStore(f"{tmp_path}/bronze"), f"{tmp_path}/silver"
    dimension = schemas.buildings(spark)

    def run():
        query = follow.to_silver(spark, root, store, dimension, path, f"{tmp_path}/checkpoint")
        query.awaitTermination()

    run()
    few = adapter.corrections(typed).where("reading_date = date'2024-01-05'")
    _append(few, root)
    run()
    assert opened["dates"] == [["2024-01-05"]]
    assert silver.read(spark, path).count() == early.count()


def test_additions_are_packed(spark, tmp_path, history, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_ADDITIONS", 2)
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    base = None
    for n in range(6):
        upsert.merge_into(spark, path, later(history, f"value = {n}", days=n + 1))
        found = files.partition_numbers(spark, f"{path}/_keys", "added")
        base = base or sorted(os.listdir(f"{path}/_keys/added=0"))
        assert len(found) <= 4 and sorted(os.listdir(f"{path}/_keys/added=0")) == base
    upsert.merge_into(spark, path, later(history, "value < 6", days=9))
    got = upsert.read_stored(spark, path)
    assert got.count() == 600
    assert {r.reading_date for r in got.where("value between 1000 and 1005").collect()} == {day(10)}


def test_merge_that_died_before_its_swap_is_repeated(spark, tmp_path, history, monkeypatch):
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    batch = later(history, "value in (1, 2)", days=3)
    with monkeypatch.context() as patch:
        patch.setattr(files, "partition_dates", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert.merge_into(spark, path, batch)
    upsert.merge_into(spark, path, batch)
    got = upsert.read_stored(spark, path)
    assert got.count() == 600 and got.where("reading_date = date'2026-01-04'").count() == 22


# --- repeated keys ----------------------------------------------------------


def listed(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_repeated_keys_follow_the_merges(spark, tmp_path, history, monkeypatch):
    path = f"{tmp_path}/t"
    twice = history.unionByName(later(history, "value in (3, 4)", days=9))
    upsert.create_table(spark, path, twice)
    assert listed(upsert.repeated_keys(spark, path)) == [("r0003", 2), ("r0004", 2)]
    sizes = []
    counted = upsert.duplicate_keys
    monkeypatch.setattr(
        upsert, "duplicate_keys", lambda rows, key: sizes.append(rows.count()) or counted(rows, key)
    )
    # One of the repeated keys is replaced by one row; a new one comes twice, on two dates.
    new = later(history, "value = 9").withColumn("reading_id", F.lit("new"))
    batch = later(history, "value = 3").unionByName(new).unionByName(later(new, "true", days=2))
    upsert.merge_into(spark, path, batch, on_duplicate="fail_matched")
    assert listed(upsert.repeated_keys(spark, path)) == [("new", 2), ("r0004", 2)]
    assert max(sizes) == 3
    assert listed(upsert.repeated_keys(spark, path)) == listed(
        counted(upsert.read_stored(spark, path), "reading_id")
    )
    assert len([f for f in os.listdir(path) if f.startswith("_repeats")]) == 1
    # A build starts anew.
    upsert.create_table(spark, path, history)
    assert listed(upsert.repeated_keys(spark, path)) == []


# --- marks and versions -----------------------------------------------------


def test_mark_is_noted(spark, tmp_path, history, monkeypatch):
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    with monkeypatch.context() as patch:
        patch.setattr(upsert, "high_water_mark", lambda *a: 1 / 0)
        assert upsert.stored_mark(spark, path) == dt.datetime(2026, 3, 1)
        upsert.merge_into(spark, path, later(history, "value = 5"))
        assert upsert.stored_mark(spark, path) == dt.datetime(2026, 3, 2)
        upsert.merge_into(spark, path, history.where("value = 6"))
        assert upsert.stored_mark(spark, path) == dt.datetime(2026, 3, 2)
    note = f"{path}/_schema.json"
    state = json.loads(files.read_note(spark, note))
    files.write_note(spark, note, json.dumps({k: v for k, v in state.items() if k != "mark"}))
    assert upsert.stored_mark(spark, path) == dt.datetime(2026, 3, 2)
    upsert.merge_into(spark, path, history.where("value = 6"))
    assert json.loads(files.read_note(spark, note))["mark"].startswith("2026-03-02")


def test_changed_dates(spark, tmp_path, history, monkeypatch):
    path = f"{tmp_path}/t"
    assert upsert.version(spark, path) is None
    upsert.create_table(spark, path, history)
    first = upsert.version(spark, path)
    assert upsert.changed_dates(spark, path, first) == []
    upsert.merge_into(spark, path, later(history, "value = 0", days=2))
    second = upsert.version(spark, path)
    upsert.merge_into(spark, path, later(history, "value = 25").withColumn("reading_date", F.lit(None).cast("date")))
    assert upsert.changed_dates(spark, path, second) == [None, day(2)]
    assert upsert.changed_dates(spark, path, first) == [None, day(1), day(2), day(3)]
    assert upsert.changed_dates(spark, path, None) is None
    monkeypatch.setattr(upsert, "KEPT_CHANGES", 1)
    upsert.merge_into(spark, path, later(history, "value = 0"))
    assert upsert.changed_dates(spark, path, first) is None
    # Another type rewrites all dates.
    third = upsert.version(spark, path)
    upsert.merge_into(spark, path, later(history, "value = 1").withColumn("value", F.lit(1.5)))
    assert upsert.changed_dates(spark, path, third) is None
    upsert.create_table(spark, path, history)
    assert upsert.changed_dates(spark, path, second) is None


# --- order within dates -----------------------------------------------------


def row_groups(path, unit, first, last):
    """Row groups of the files below, and those that may hold rows of a unit and time."""
    every, met = 0, 0
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet") and "reading_date=" in folder:
                meta = pq.ParquetFile(f"{folder}/{name}").metadata
                places = {meta.schema.column(i).name: i for i in range(len(meta.schema))}
                for g in range(meta.num_row_groups):
                    of = [meta.row_group(g).column(places[c]).statistics for c in schemas.SILVER_ORDER]
                    every += 1
                    met += of[0].min <= unit <= of[0].max and of[1].min <= last and of[1].max >= first
    return every, met


def test_silver_is_sorted_within_dates(spark, sf_dir, tmp_path):
    """A filter on unit and hour meets few row groups of a date, after a build and after a merge."""
    typed = adapter.readings(spark, sf_dir)
    dated = typed.withColumn("reading_date", F.lit("2024-01-05").cast("date"))
    rows = silver.enrich(dated, schemas.buildings(spark)).repartition(1)
    path = f"{tmp_path}/silver"
    context = spark.sparkContext._jsc.hadoopConfiguration()
    context.setInt("parquet.block.size", 4096)
    context.setInt("parquet.page.size.row.check.min", 10)
    context.setInt("parquet.block.size.row.check.min", 10)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        early = F.col("reading_timestamp") < F.lit("2024-01-16").cast("timestamp_ntz")
        upsert.merge_into(spark, path, rows.where(early), order=schemas.SILVER_ORDER)
        unit = rows.agg(F.min("unit_id")).first()[0]
        hours = dt.datetime(2024, 1, 8, 9), dt.datetime(2024, 1, 8, 10)
        for _ in range(2):
            every, met = row_groups(path, unit, *hours)
            assert every >= 20 and met <= every // 10
            upsert.merge_into(spark, path, rows.where(~early), order=schemas.SILVER_ORDER)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        for key in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
            context.unset(key)
    assert upsert.read_stored(spark, path).count() == typed.count()


# --- derived tables ---------------------------------------------------------


@pytest.fixture
def lake(spark, sf_dir, tmp_path):
    lake = chain.Lake(f"{tmp_path}/lake")
    typed = adapter.readings(spark, sf_dir)
    upsert.create_table(spark, lake.silver, silver.enrich(typed.where(adapter.is_early()), schemas.buildings(spark)))
    chain.build_gold(spark, lake)
    return lake


def same_rows(one, other):
    columns = sorted(one.columns)
    assert columns == sorted(other.columns)
    one, other = one.select(*columns), other.select(*columns)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def assert_gold_is_that_of_silver(spark, lake):
    readings = silver.read(spark, lake.silver)
    for name, model in gold.MODELS.items():
        same_rows(upsert.read_stored(spark, lake.gold(name)), model(readings))


def folders(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


def test_gold_follows_inserts_corrections_and_emptied_dates(spark, sf_dir, lake, monkeypatch):
    typed = adapter.readings(spark, sf_dir)
    dimension = schemas.buildings(spark)
    assert_gold_is_that_of_silver(spark, lake)
    dated = [lake.gold("gold_building_energy_summary"), lake.gold("gold_anomaly_alerts"), lake.health_parts]
    before = [folders(p) for p in dated]
    on = F.col("reading_date")
    # New readings on one day, corrections of another, and all of a third move to a fourth.
    moved = typed.where(on == F.lit("2024-01-03")).withColumn("reading_date", F.lit("2024-01-04").cast("date"))
    batch = (
        typed.where(on == F.lit("2024-01-20"))
        .unionByName(adapter.corrections(typed).where(on == F.lit("2024-01-08")))
        .unionByName(moved)
    )
    upsert.merge_into(spark, lake.silver, silver.enrich(batch, dimension))
    read = []
    monkeypatch.setattr(
        derived.upsert, "in_dates", lambda column, dates, real=upsert.in_dates: read.append(dates) or real(column, dates)
    )
    chain.build_gold(spark, lake)
    touched = [dt.date(2024, 1, d) for d in (3, 4, 8, 20)]
    assert read == [touched] * 3
    assert_gold_is_that_of_silver(spark, lake)
    names = {f"reading_date={d}" for d in touched}
    for path, old in zip(dated, before):
        new = folders(path)
        assert {d for d in old | new if old.get(d) != new.get(d)} == names
        assert "reading_date=2024-01-03" not in new
    # Nothing has changed since, so nothing is written.
    whole = [folders(p) for p in dated], sorted(os.listdir(lake.gold("gold_equipment_health")))
    chain.build_gold(spark, lake)
    assert whole == ([folders(p) for p in dated], sorted(os.listdir(lake.gold("gold_equipment_health"))))


def test_gold_that_died_is_made_up_for(spark, sf_dir, lake, monkeypatch):
    typed = adapter.readings(spark, sf_dir)
    rows = silver.enrich(adapter.corrections(typed).limit(3), schemas.buildings(spark))
    upsert.merge_into(spark, lake.silver, rows)
    with monkeypatch.context() as patch:
        patch.setattr(files, "write_note", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            chain.build_gold(spark, lake)
    upsert.merge_into(spark, lake.silver, silver.enrich(typed.where(~adapter.is_early()), schemas.buildings(spark)))
    chain.build_gold(spark, lake)
    assert_gold_is_that_of_silver(spark, lake)
    # A new build of silver, and one without any rows.
    upsert.create_table(spark, lake.silver, silver.read(spark, lake.silver).limit(5))
    chain.build_gold(spark, lake)
    assert_gold_is_that_of_silver(spark, lake)
    upsert.create_table(spark, lake.silver, silver.read(spark, lake.silver).limit(0))
    chain.build_gold(spark, lake)
    assert_gold_is_that_of_silver(spark, lake)


def test_checks_read_changed_dates_only(spark, sf_dir, lake, monkeypatch):
    def failures():
        try:
            chain.check_silver(spark, lake)
        except AssertionsFailed as failed:
            return str(failed)

    # The adapter's unknown building fails by itself.
    assert failures() == "accepted_values(building_id): 1"
    readings = silver.read(spark, lake.silver)
    ids = [r.reading_id for r in readings.where("reading_date = date'2024-01-05'").limit(2).collect()]
    wrong = readings.where(F.col("reading_id").isin(ids)).withColumns(
        {"building_id": F.lit(None).cast("string"), "compressor_status": F.lit("OFF")}
    )
    sizes = []
    monkeypatch.setattr(
        upsert, "duplicate_keys", lambda rows, key, real=upsert.duplicate_keys: sizes.append(rows.count()) or real(rows, key)
    )
    new = wrong.limit(1).withColumn("reading_id", F.lit("twice"))
    moved = new.withColumn("reading_date", F.lit("2024-01-07").cast("date"))
    upsert.merge_into(spark, lake.silver, wrong.unionByName(new).unionByName(moved), on_duplicate="fail_matched")
    assert failures() == (
        "accepted_values(building_id): 1; accepted_values(compressor_status): 1; "
        "not_null(building_id): 4; unique(reading_id): 1"
    )
    assert sizes == [4]
    whole = {(r.test, r.column): r.failures for r in assertions.run_suite(silver.read(spark, lake.silver)).collect()}
    assert {k: v for k, v in whole.items() if v} == {
        ("accepted_values", "building_id"): 1, ("accepted_values", "compressor_status"): 1,
        ("not_null", "building_id"): 4, ("unique", "reading_id"): 1,
    }
