"""What a merge writes and joins: each row once, and only what is needed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import key_index, upsert
from sensorlake.sources import files


@pytest.fixture
def history(spark):
    """Ten days with twenty readings each."""
    return spark.range(200).select(
        F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("reading_id"),
        F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") / 20).cast("int")).alias("reading_date"),
        F.col("id").alias("value"),
    )


def listing(path):
    return {
        folder: sorted(n for n in os.listdir(f"{path}/{folder}") if n.endswith(".parquet"))
        for folder in os.listdir(path)
        if folder.startswith("reading_date=")
    }


def changed(rows, condition):
    return rows.where(condition).withColumn("value", F.col("value") + 1000)


@pytest.mark.parametrize("policy", ["fail", "latest"])
def test_merge_writes_rows_once(spark, tmp_path, history, monkeypatch, policy):
    """The files that were staged are those of the table after the swap."""
    path = f"{tmp_path}/t"
    stored = history.withColumn("load_timestamp", F.lit("2026-03-01 00:00:00").cast("timestamp_ntz"))
    upsert.create_table(spark, path, stored)
    real, staged = upsert.recover, []

    def seen(spark, path):
        if os.path.exists(f"{path}/_staged/rows"):
            staged.append(listing(f"{path}/_staged/rows"))
        real(spark, path)

    monkeypatch.setattr(upsert, "recover", seen)
    before = listing(path)
    batch = changed(stored, "value in (3, 45, 46)")
    upsert.merge_into(spark, path, batch, on_duplicate=policy)
    assert len(staged) == 1 and sorted(staged[0]) == ["reading_date=2026-01-01", "reading_date=2026-01-03"]
    assert listing(path) == {**before, **staged[0]}
    assert not os.path.exists(f"{path}/_staged")
    wanted = upsert.upsert(stored, batch)
    got = upsert.read_stored(spark, path)
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_swap_that_died_between_two_dates_is_finished(spark, tmp_path, history, monkeypatch):
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    batch = changed(history, "value % 20 = 0")
    real, moved = files.delete, []

    def dies(spark, target):
        if "/t/reading_date=" in target:
            moved.append(target)
            if len(moved) == 4:
                raise RuntimeError("driver lost")
        real(spark, target)

    with monkeypatch.context() as patch:
        patch.setattr(files, "delete", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            upsert.merge_into(spark, path, batch)
    upsert.recover(spark, path)
    wanted = upsert.upsert(history, batch)
    got = upsert.read_stored(spark, path)
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    assert not os.path.exists(f"{path}/_staged")


def test_stored_rows_meet_stored_keys_only(spark, tmp_path, history, monkeypatch):
    """A batch of many new keys does not make its few replaced ones too many to broadcast."""
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    new = history.withColumn("reading_id", F.concat("reading_id", F.lit("x")))
    batch = new.unionByName(changed(history, "value in (3, 45)"))
    monkeypatch.setattr(upsert, "BROADCAST_KEY_BYTES", 100)
    real, met = upsert.without_keys, []

    def without_keys(target, keys, key, broadcast=False):
        met.append((keys.count(), broadcast))
        return real(target, keys, key, broadcast)

    monkeypatch.setattr(upsert, "without_keys", without_keys)
    upsert.merge_into(spark, path, batch)
    assert met == [(2, True)]
    got = upsert.read_stored(spark, path)
    assert got.count() == 400 and got.where("value >= 1000").count() == 2


def test_rows_that_compress_well_are_indexed_in_several_buckets(spark, tmp_path, history, monkeypatch):
    monkeypatch.setattr(key_index, "BUCKET_ROWS", 30)
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    upsert.merge_into(spark, path, changed(history, "value = 7"))
    assert files.stored_bytes(spark, path) < key_index.BUCKET_BYTES
    assert len(files.partition_numbers(spark, f"{path}/_keys/added=0", "bucket")) == 7


def test_keys_beyond_the_bound_are_never_broadcast(spark, tmp_path, history, monkeypatch):
    """Whatever size Spark takes their files for."""
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    monkeypatch.setattr(upsert, "BROADCAST_KEY_BYTES", 100)
    plans = []

    def noted(real):
        def run(*args, **options):
            found = real(*args, **options)
            plans.append(found._jdf.queryExecution().executedPlan().toString())
            return found

        return run

    monkeypatch.setattr(key_index, "lookup", noted(key_index.lookup))
    monkeypatch.setattr(upsert, "without_keys", noted(upsert.without_keys))
    batch = changed(history, "value % 2 = 0")
    upsert.merge_into(spark, path, batch)
    assert len(plans) == 2
    assert all("SortMergeJoin" in plan and "BroadcastHashJoin" not in plan for plan in plans)
    wanted = upsert.upsert(history, batch)
    got = upsert.read_stored(spark, path)
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_stored_keys_are_searched_for_repeated_ones_only(spark, tmp_path, history, monkeypatch):
    """A batch without repeated keys needs no join for that; one with them is still refused."""
    path = f"{tmp_path}/t"
    upsert.create_table(spark, path, history)
    twice = changed(history, "value = 3")
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.merge_into(spark, path, twice.unionByName(twice), on_duplicate="fail_matched")
    real, searched = upsert.near_dates, []
    counted = upsert.duplicate_keys

    class Searched:
        """Rows that may be joined with keys, but not asked for their own."""

        def __init__(self, rows):
            self.rows = rows

        def select(self, *columns):
            searched.append(columns)
            return self.rows.select(*columns)

    monkeypatch.setattr(upsert, "near_dates", lambda *args: Searched(real(*args)))
    upsert.merge_into(spark, path, twice, on_duplicate="fail_matched", search_days=1)
    assert searched == [("reading_id", "reading_date")]
    assert counted(upsert.read_stored(spark, path), "reading_id").isEmpty()
