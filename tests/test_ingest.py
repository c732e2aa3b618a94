"""Loading files: bad lines, row numbers, once each, repeats after a crash."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from sensorlake import schemas
from sensorlake.operators import row_numbers
from sensorlake.operators.assertions import AssertionsFailed
from sensorlake.plans import bronze, chain, silver
from sensorlake.plans.bronze import BronzeStore
from sensorlake.sources import files, json_lines, ndjson
from sensorlake.streaming import follow

DAYS = {1: dt.date(2026, 1, 1), 2: dt.date(2026, 1, 2), 3: dt.date(2026, 1, 3)}


def line(number, day=1, **changes):
    record = {
        "reading_id": f"r{day}-{number}",
        "building_id": "BLDG_001",
        "timestamp": f"2026-01-{day:02d}T08:{number % 60:02d}:00Z",
        "temperature_celsius": 21.0 + number % 5,
        "energy_consumption_kwh": 2.0,
        "runtime_minutes": 5,
        "setpoint_celsius": 21.0,
        "compressor_status": "RUNNING",
        "anomaly_type": "NORMAL",
    }
    return json.dumps({**record, **changes})


def put(root, day, name, lines):
    folder = f"{root}/year=2026/month=01/day={day:02d}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


@pytest.fixture
def landing(tmp_path):
    root = f"{tmp_path}/raw/sensors"
    put(root, 1, "sensors_000.json", [line(1), "{bad json", line(2)])
    put(root, 2, "sensors_000.json", [line(1, 2), "", '{"a": 1, "a": 2}'])
    put(root, 3, "sensors_000.json", ["[1,2]", "5"])
    put(root, 3, "notes.txt", ["anything"])
    return root


@pytest.fixture
def store(tmp_path):
    return BronzeStore(f"{tmp_path}/bronze")


def test_bad_lines_are_set_aside_and_numbers_kept(spark, landing, store):
    assert bronze.load_new_files(spark, landing, store) == 5
    rows = bronze.read_bronze(spark, store)
    found = {
        (r["source_file_name"][-23:], r["source_file_row_num"])
        for r in rows.select("source_file_name", "source_file_row_num").collect()
    }
    assert found == {
        ("day=01/sensors_000.json", 1),
        ("day=01/sensors_000.json", 3),
        ("day=02/sensors_000.json", 1),
        ("day=03/sensors_000.json", 1),
        ("day=03/sensors_000.json", 2),
    }
    rejected = bronze.read_quarantine(spark, store).collect()
    assert sorted((r["line"], r["source_file_row_num"]) for r in rejected) == [
        ("", 2),
        ('{"a": 1, "a": 2}', 3),
        ("{bad json", 2),
    ]
    log = {r["source_file_name"][-23:]: (r["rows_loaded"], r["rows_rejected"]) for r in bronze.read_file_log(spark, store).collect()}
    assert log == {
        "day=01/sensors_000.json": (2, 1),
        "day=02/sensors_000.json": (1, 2),
        "day=03/sensors_000.json": (2, 0),
    }
    assert rows.select("load_id").distinct().count() == 5
    assert rows.select("load_timestamp").distinct().count() == 1
    odd = silver.extract(rows.where("reading_date is null")).drop("reading_date", "load_timestamp").collect()
    assert len(odd) == 2 and all(v is None for r in odd for v in r)


@pytest.mark.parametrize("streaming", [False, True])
def test_each_file_once(spark, landing, store, tmp_path, streaming):
    def load():
        if not streaming:
            return bronze.load_new_files(spark, landing, store)
        before = bronze.read_bronze(spark, store).count()
        follow.to_bronze(spark, landing, store, f"{tmp_path}/checkpoint").awaitTermination()
        return bronze.read_bronze(spark, store).count() - before

    assert load() == 5
    assert load() == 0
    put(landing, 2, "sensors_001.json", [line(n, 2) for n in range(10, 20)])
    assert load() == 10
    assert load() == 0
    times = [r[0] for r in bronze.read_bronze(spark, store).select("load_timestamp").distinct().collect()]
    assert len(times) == 2
    assert bronze.read_quarantine(spark, store).count() == 3


def test_stream_in_small_steps(spark, landing, store, tmp_path):
    follow.to_bronze(spark, landing, store, f"{tmp_path}/cp", max_files=1).awaitTermination()
    rows = bronze.read_bronze(spark, store)
    assert (rows.count(), rows.select("load_timestamp").distinct().count()) == (5, 3)


def test_one_call_is_one_load(spark, landing, store):
    assert bronze.load_new_files(spark, landing, store) == 5
    rows = bronze.read_bronze(spark, store)
    assert (rows.count(), rows.select("load_timestamp").distinct().count()) == (5, 1)
    assert bronze.load_new_files(spark, landing, store) == 0


def test_file_names_are_no_patterns(spark, tmp_path, store):
    root = f"{tmp_path}/odd[1]"
    for n, name in enumerate(["s_1.json", "s_[1].json", "s_{a,b}.json", "s_*.json", "s ?%20.json"]):
        put(root, 1, name, [line(n)])
    assert bronze.load_new_files(spark, root, store) == 5
    assert bronze.read_file_log(spark, store).count() == 5
    assert bronze.load_new_files(spark, root, store) == 0


def test_text_after_a_record_is_rejected(spark, tmp_path, store):
    good = line(1)
    bad = [good + good, good + " x", good + "}", good + "]", good + ",1", good + ",true",
           good + ',"z":2', good + ",true]", good + ",true,null", ",", "]", "[", ""]
    put(f"{tmp_path}/raw", 1, "sensors_000.json", [good, *bad, "  " + good + "  ", "null", "[1,true,2]"])
    assert bronze.load_new_files(spark, f"{tmp_path}/raw", store) == 4
    rejected = bronze.read_quarantine(spark, store).collect()
    assert sorted(r.source_file_row_num for r in rejected) == list(range(2, 2 + len(bad)))
    kept = bronze.read_bronze(spark, store).selectExpr("to_json(raw_data) as j").collect()
    assert "[1,true,2]" in {r.j for r in kept}


def test_windows_of_any_length_follow_one_rule(spark, tmp_path):
    root = f"{tmp_path}/raw"
    for folder in ("year=2026/month=1/day=5", "year=2026/month=01/day=06", "year=2024/month=12/day=31"):
        os.makedirs(f"{root}/{folder}")
        with open(f"{root}/{folder}/a.json", "w") as out:
            out.write(line(1) + "\n")
    end = dt.date(2026, 1, 6)
    for days in (1, 2, 400, 401, 4_000):
        found = json_lines.scan(spark, root, end - dt.timedelta(days=days), end).count()
        assert found == (2 if days == 4_000 or days >= 371 else 1), days
    assert json_lines.scan(spark, root, None, end).count() == 2
    assert json_lines.scan(spark, root, end, None).count() == 1
    assert json_lines.scan(spark, root, end, end).count() == 0
    assert json_lines.scan(spark, root).count() == 3


def test_landing_again_replaces_all_dates(spark, tmp_path, store):
    def lines(*days):
        root = f"{tmp_path}/{len(days)}"
        for day in days:
            put(root, day, "sensors_000.json", [line(day, day)])
        return json_lines.scan(spark, root)

    assert bronze.land(spark, lines(1, 2), store, "a") == 2
    assert bronze.land(spark, lines(1), store, "a") == 1
    assert bronze.read_bronze(spark, store).count() == 1


def test_vanished_file_is_noted(spark, landing, store, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(bronze, "_land_parts", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            bronze.load_new_files(spark, landing, store)
    gone = glob.glob(f"{landing}/*/*/day=02/*.json")[0]
    os.remove(gone)
    put(landing, 2, "sensors_009.json", [line(n, 2) for n in range(10, 20)])
    before = bronze.read_bronze(spark, store).count()
    loaded = bronze.load_new_files(spark, landing, store)
    assert loaded >= 10 and bronze.read_bronze(spark, store).count() == before + loaded
    noted = bronze.read_file_log(spark, store).where("rows_loaded is null").collect()
    assert [os.path.basename(r.source_file_name) for r in noted] == [os.path.basename(gone)]
    assert bronze.load_new_files(spark, landing, store) == 0


def test_rewritten_file_counts_as_new(spark, landing, store):
    bronze.load_new_files(spark, landing, store)
    put(landing, 1, "sensors_000.json", [line(n) for n in range(4)])
    assert bronze.load_new_files(spark, landing, store) == 4


def test_window(spark, landing, store):
    assert bronze.load_day(spark, landing, store, DAYS[2]) == 1
    assert bronze.load_last_days(spark, landing, store, 2, today=dt.date(2026, 1, 3)) == 2
    assert bronze.load_last_days(spark, landing, store, 30, today=dt.date(2020, 1, 1)) == 0
    assert bronze.load_new_files(spark, landing, store, start=DAYS[3]) == 2
    assert json_lines.scan(spark, landing, DAYS[1], DAYS[3]).count() == 6
    assert json_lines.scan(spark, landing, dt.date(2020, 1, 1), dt.date(2020, 1, 5)).count() == 0
    assert json_lines.last_days(30, dt.date(2026, 1, 31)) == (dt.date(2026, 1, 1), dt.date(2026, 1, 31))


def test_load_that_died_is_repeated_under_its_label(spark, landing, store, monkeypatch):
    real = bronze._note_load

    def dies(spark, store, label, moment, rows_loaded):
        if rows_loaded is not None:
            raise RuntimeError("driver lost")
        real(spark, store, label, moment, rows_loaded)

    monkeypatch.setattr(bronze, "_note_load", dies)
    with pytest.raises(RuntimeError, match="driver lost"):
        bronze.load_new_files(spark, landing, store)
    # Written, but not finished: silver must not see it yet.
    first = bronze.read_bronze(spark, store)
    stamps = {r[0] for r in first.select("load_timestamp").distinct().collect()}
    assert bronze.read_since(spark, store, None).count() == 0
    monkeypatch.setattr(bronze, "_note_load", real)
    put(landing, 2, "sensors_001.json", [line(n, 2) for n in range(10, 20)])
    assert bronze.load_new_files(spark, landing, store) == 15
    again = bronze.read_bronze(spark, store)
    assert again.count() == 15
    assert stamps < {r[0] for r in again.select("load_timestamp").distinct().collect()}
    assert bronze.read_since(spark, store, min(stamps)).count() == 10
    assert bronze.read_quarantine(spark, store).count() == 3


def test_load_times_grow_even_if_the_clock_does_not(spark, landing, store):
    now = dt.datetime(2026, 2, 1)
    bronze.load_new_files(spark, landing, store, end=DAYS[2], now=now)
    bronze.load_new_files(spark, landing, store, now=now - dt.timedelta(days=1))
    times = sorted(r[0] for r in bronze.read_bronze(spark, store).select("load_timestamp").distinct().collect())
    assert times == [now, now + dt.timedelta(microseconds=1)]


@pytest.mark.parametrize("broadcast_limit", [0, 4, 200_000])
def test_row_numbers_across_splits(spark, tmp_path, store, monkeypatch, broadcast_limit):
    """One large file in many splits next to small ones; blank lines count."""
    monkeypatch.setattr(row_numbers, "BROADCAST_SPLITS", broadcast_limit)
    root = f"{tmp_path}/raw/sensors"
    big = [line(n, 1, position=n) if n % 7 else "" for n in range(1, 4001)]
    put(root, 1, "sensors_000.json", big)
    for number in range(5):
        put(root, 2, f"sensors_{number:03d}.json", [line(n, 2, position=n) for n in range(1, 30)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        bronze.load_new_files(spark, root, store)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = bronze.read_bronze(spark, store).select(
        "source_file_row_num", F.variant_get("raw_data", "$.position", "bigint").alias("position")
    )
    assert rows.where("source_file_row_num != position").count() == 0
    assert rows.count() == sum(1 for l in big if l) + 5 * 29


def test_row_numbers_can_be_left_out(spark, landing, store):
    bronze.load_new_files(spark, landing, store, row_numbers=False)
    assert bronze.read_bronze(spark, store).where("source_file_row_num is not null").count() == 0


def test_write_days_leaves_existing_days(spark, tmp_path):
    root = f"{tmp_path}/out"
    day1 = spark.sql("select 'a' reading_id, timestamp_ntz'2026-01-01 08:00:00.123456' timestamp, cast(null as double) t")
    both = day1.withColumn("reading_id", F.lit("b")).unionByName(
        spark.sql("select 'c' reading_id, timestamp_ntz'2026-01-12 08:00:00' timestamp, cast(1 as double) t")
    )
    ndjson.write_days(day1, root)
    manifest = ndjson.write_days(both, root)
    text = sorted(r["value"] for r in spark.read.text(root).select("value").collect())
    assert text == [
        '{"reading_id":"a","timestamp":"2026-01-01T08:00:00.123456Z","t":null}',
        '{"reading_id":"c","timestamp":"2026-01-12T08:00:00.000000Z","t":1.0}',
    ]
    assert os.path.isdir(f"{root}/year=2026/month=01/day=12")
    assert {(str(r["date"]), r["record_count"]) for r in manifest.collect()} == {("2026-01-01", 1), ("2026-01-12", 1)}
    assert not os.path.exists(f"{root}/_writing.json")
    listed = files.list_files(spark, root)
    assert listed.count() == 2 and listed.columns == ["path", "length", "modified_micros", "year", "month", "day"]


def test_write_days_repeats_days_left_incomplete(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/out"
    rows = spark.sql("select 'a' reading_id, timestamp_ntz'2026-01-01 08:00:00' timestamp")
    second = spark.sql("select 'b' reading_id, timestamp_ntz'2026-01-02 08:00:00' timestamp")
    third = spark.sql("select 'c' reading_id, timestamp_ntz'2026-01-03 08:00:00' timestamp")
    ndjson.write_days(rows, root)
    real = ndjson._replace_days

    def dies_at_manifest(frame, *partitions):
        if partitions == ("date",):
            raise RuntimeError("driver lost")
        return real(frame, *partitions)

    with monkeypatch.context() as patch:
        patch.setattr(ndjson, "_replace_days", dies_at_manifest)
        with pytest.raises(RuntimeError, match="driver lost"):
            ndjson.write_days(rows.unionByName(second), root)
    assert os.path.exists(f"{root}/_writing.json")
    # Another day in between does not make the torn day count as complete.
    ndjson.write_days(third, root)
    assert os.path.exists(f"{root}/_writing.json")
    again = rows.unionByName(second).unionByName(third).withColumn("reading_id", F.concat("reading_id", F.lit("2")))
    ndjson.write_days(again, root)
    assert not os.path.exists(f"{root}/_writing.json")
    ids = {r[0] for r in spark.read.json(root).select("reading_id").collect()}
    assert ids == {"a", "b2", "c"}


def test_manifest_and_files_are_of_one_evaluation(spark, tmp_path, monkeypatch):
    """The records' own source may go once they have been evaluated."""
    source = f"{tmp_path}/source"
    spark.range(20).selectExpr(
        "cast(id as string) reading_id", "timestamp_ntz'2026-01-01 08:00:00' timestamp"
    ).write.parquet(source)
    real = ndjson._write_days

    def without_source(*args):
        files.delete(spark, source)
        return real(*args)

    monkeypatch.setattr(ndjson, "_write_days", without_source)
    manifest = ndjson.write_days(spark.read.parquet(source), f"{tmp_path}/out").collect()
    assert manifest[0]["record_count"] == spark.read.text(f"{tmp_path}/out").count() == 20


def test_record_without_day_is_refused(spark, tmp_path):
    rows = spark.sql("select 'a' reading_id, cast(null as timestamp_ntz) timestamp")
    with pytest.raises(Exception, match="a record has no day"):
        ndjson.write_days(rows, f"{tmp_path}/out")


def test_chain(spark, landing, tmp_path):
    lake = chain.Lake(f"{tmp_path}/lake")
    dimension = schemas.buildings(spark)
    with pytest.raises(AssertionsFailed, match=r"not_null\(reading_id\): 2"):
        chain.run(spark, landing, lake, dimension)
    put(landing, 2, "sensors_001.json", [line(n, 2) for n in range(10, 20)])
    assert chain.run(spark, landing, lake, dimension, check=False) == 10
    assert chain.run(spark, landing, lake, dimension, check=False) == 0
    assert silver.read(spark, lake.silver).count() == 15
    energy = spark.read.parquet(lake.gold("gold_building_energy_summary"))
    assert energy.where("building_id is not null").agg(F.sum("total_readings")).first()[0] == 13
    assert spark.read.parquet(lake.gold("gold_equipment_health")).count() == 2
    assert spark.read.parquet(lake.gold("gold_anomaly_alerts")).count() == 2


def test_chain_passes_on_clean_data(spark, tmp_path):
    root = f"{tmp_path}/raw/sensors"
    put(root, 1, "sensors_000.json", [line(n) for n in range(20)])
    lake = chain.Lake(f"{tmp_path}/lake")
    assert chain.run(spark, root, lake, schemas.buildings(spark), DAYS[1], DAYS[2]) == 20


def test_positions_with_gaps_fail(spark):
    places = spark.sql(
        "select 'f' source_file_name, 0L split_start, explode(array(4, 5, 7)) scan_seq"
    )
    assert row_numbers.split_offsets(places.where("scan_seq < 6")).first()["shift"] == -3
    with pytest.raises(Exception, match="not read by one task"):
        row_numbers.split_offsets(places).collect()


def test_files_are_read_once(spark, landing, store, monkeypatch):
    """After the lines are landed the files may go: report and numbers need them no more."""
    count = bronze._count_splits

    def without_files(*args):
        for name in glob.glob(f"{landing}/*/*/*/*"):
            os.remove(name)
        count(*args)

    monkeypatch.setattr(bronze, "_count_splits", without_files)
    assert bronze.load_new_files(spark, landing, store) == 5
    numbers = sorted(r.source_file_row_num for r in bronze.read_bronze(spark, store).collect())
    assert numbers == [1, 1, 1, 2, 3]
    assert bronze.read_file_log(spark, store).agg(F.sum("rows_rejected")).first()[0] == 3


@pytest.mark.parametrize("limit", [1, 2, 4])
def test_numbering_never_shuffles_lines(spark, landing, store, monkeypatch, limit):
    monkeypatch.setattr(row_numbers, "BROADCAST_SPLITS", limit)
    bronze.load_new_files(spark, landing, store)
    put(landing, 2, "sensors_001.json", [line(n, 2) for n in range(10, 20)])
    bronze.load_new_files(spark, landing, store)
    rows = bronze.read_bronze(spark, store)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert rows.count() == 15 and rows.where("source_file_row_num is null").count() == 0
    assert rows.agg(F.max("source_file_row_num")).first()[0] == 10


@pytest.mark.parametrize("most", [1, 2, 5])
def test_load_of_many_files_is_written_in_parts(spark, landing, store, monkeypatch, most):
    for n in range(7):
        put(landing, 2, f"more_{n}.json", [line(n, 2), line(n + 50, 2)])
    monkeypatch.setattr(bronze, "MOST_FILES", most)
    sizes = []
    scan = json_lines.scan
    monkeypatch.setattr(json_lines, "scan", lambda *a, paths, **k: sizes.append(len(paths)) or scan(*a, paths=paths, **k))
    real = bronze._write_lines

    def dies(*args):
        if len(sizes) == 3:
            raise RuntimeError("driver lost")
        real(*args)

    if most < 5:
        with monkeypatch.context() as patch:
            patch.setattr(bronze, "_write_lines", dies)
            with pytest.raises(RuntimeError):
                bronze.load_new_files(spark, landing, store)
        assert bronze.read_since(spark, store, None).count() == 0
        sizes.clear()
    assert bronze.load_new_files(spark, landing, store) == 19
    assert sum(sizes) == 10 and len(sizes) > 1
    rows = bronze.read_bronze(spark, store)
    assert rows.select("load_timestamp").distinct().count() == 1
    assert bronze.read_since(spark, store, None).count() == rows.count() == 19
    assert rows.select("load_id").distinct().count() == 19
    files_of = rows.where("source_file_name like '%more_%'").groupBy("source_file_name")
    numbers = files_of.agg(F.sort_array(F.collect_list("source_file_row_num")).alias("n")).collect()
    assert [r.n for r in numbers] == [[1, 2]] * 7
    assert bronze.load_new_files(spark, landing, store) == 0


def test_nothing_new_reads_the_window_only(spark, landing, store, monkeypatch):
    bronze.load_new_files(spark, landing, store)
    read, real = [], bronze._read_folders
    monkeypatch.setattr(bronze, "_read_folders", lambda s, p, c, folders: read.extend(folders) or real(s, p, c, folders))
    before = sorted(os.listdir(store.root))
    assert bronze.load_day(spark, landing, store, DAYS[2]) == 0
    assert read == [f"{store.claimed}/claim_day=2026-01-02"]
    assert sorted(os.listdir(store.root)) == before and not os.listdir(store.open_loads)


def test_claim_that_died_is_made_again(spark, landing, store, monkeypatch):
    real = files.write_note
    notes = []

    def dies_at_third(spark, path, text):
        notes.append(path)
        if len(notes) == 3:
            raise RuntimeError("driver lost")
        real(spark, path, text)

    with monkeypatch.context() as patch:
        patch.setattr(files, "write_note", dies_at_third)
        with pytest.raises(RuntimeError):
            bronze.load_new_files(spark, landing, store)
    assert os.listdir(store.claimed)
    assert bronze.load_new_files(spark, landing, store) == 5
    assert bronze.read_bronze(spark, store).count() == 5
    assert bronze.load_new_files(spark, landing, store) == 0
