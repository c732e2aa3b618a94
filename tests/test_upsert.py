"""Incremental laws of the upsert, in memory and stored."""

import os

import pytest
from pyspark.sql import functions as F

from sensorlake import adapter, schemas
from sensorlake.operators import enrich, upsert
from sensorlake.operators.enrich import DuplicateKeyError
from sensorlake.plans import bronze, chain, silver
from sensorlake.sources import files, tables


def rows(spark, *values):
    """(id, date, value, load day) rows."""
    listed = ", ".join(
        f"({'null' if i is None else repr(i)}, {'null' if d is None else f'date{d!r}'}, {v}, timestamp_ntz'2026-02-{l:02d} 00:00:00')"
        for i, d, v, l in values
    )
    return spark.sql(
        f"select cast(reading_id as string) reading_id, cast(reading_date as date) reading_date, value, load_timestamp "
        f"from values {listed} as t(reading_id, reading_date, value, load_timestamp)"
    )


def content(frame, *columns):
    columns = columns or ("reading_id", "reading_date", "value")
    return sorted((tuple(str(r[c]) for c in columns) for r in frame.collect()))


D1, D2, D3 = "2026-01-01", "2026-01-02", "2026-01-03"


@pytest.fixture
def base(spark):
    return rows(
        spark, ("a", D1, 1, 1), ("b", D1, 2, 1), ("c", D2, 3, 1), (None, D1, 4, 1), ("d", None, 5, 1), ("e", D3, 6, 1)
    )


@pytest.fixture
def change(spark):
    """Replaces b, moves c to another date and d out of the null date, adds f."""
    return rows(spark, ("b", D1, 20, 2), ("c", D3, 30, 2), ("d", D1, 50, 2), ("f", D2, 70, 2), (None, D3, 80, 2))


WANTED = sorted(
    [
        ("a", D1, "1"), ("b", D1, "20"), ("None", D1, "4"), ("d", D1, "50"),
        ("f", D2, "70"), ("c", D3, "30"), ("e", D3, "6"), ("None", D3, "80"),
    ]
)


def test_upsert(base, change):
    assert content(upsert.upsert(base, change)) == WANTED


@pytest.mark.parametrize("key_bytes", [0, 1 << 25])
def test_merge_stored(spark, tmp_path, base, change, monkeypatch, key_bytes):
    monkeypatch.setattr(upsert, "BROADCAST_KEY_BYTES", key_bytes)
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base)
    upsert.merge_into(spark, path, change)
    assert content(upsert.read_stored(spark, path)) == WANTED
    assert not os.path.exists(f"{path}/reading_date=__HIVE_DEFAULT_PARTITION__")
    keyed = change.where("reading_id is not null")
    upsert.merge_into(spark, path, keyed)
    assert content(upsert.read_stored(spark, path)) == WANTED


def test_only_touched_dates_are_rewritten(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base)
    before = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}
    upsert.merge_into(spark, path, rows(spark, ("a", D1, 10, 2)))
    after = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}
    assert [d for d in before if before[d] != after[d]] == [f"reading_date={D1}"]


def test_search_is_bounded_by_days(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base)
    batch = rows(spark, ("c", D3, 30, 2), ("d", D1, 50, 2), (None, None, 7, 2))
    near = upsert.near_dates(upsert.read_stored(spark, path), rows(spark, ("x", D3, 1, 2)), "reading_date", 1)
    assert "PartitionFilters: [" in near._jdf.queryExecution().executedPlan().toString()
    assert D1 not in {str(r.reading_date) for r in near.collect()}
    undated = upsert.near_dates(upsert.read_stored(spark, path), batch.where("reading_date is null"), "reading_date", 1)
    assert all(r.reading_date is None for r in undated.collect())
    upsert.merge_into(spark, path, batch, search_days=3)
    upsert.create_table(spark, f"{tmp_path}/u", base)
    upsert.merge_into(spark, f"{tmp_path}/u", batch)
    assert content(upsert.read_stored(spark, path)) == content(upsert.read_stored(spark, f"{tmp_path}/u"))


def test_date_left_without_rows_disappears(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base)
    upsert.merge_into(spark, path, rows(spark, ("e", D1, 6, 2)))
    assert not os.path.exists(f"{path}/reading_date={D3}")
    assert upsert.read_stored(spark, path).count() == 6


def test_repeated_keys(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    twice = rows(spark, ("a", D1, 10, 2), ("a", D2, 11, 3), (None, D1, 12, 2), (None, D1, 12, 2))
    # The first build keeps everything, as creating a table from a query does.
    upsert.merge_into(spark, path, base.unionByName(base))
    assert upsert.read_stored(spark, path).count() == 12
    with pytest.raises(DuplicateKeyError):
        upsert.merge_into(spark, path, twice)
    with pytest.raises(ValueError, match="on_duplicate"):
        upsert.merge_into(spark, path, twice, on_duplicate="first")
    with pytest.raises(DuplicateKeyError):
        upsert.merge_into(spark, path, twice, on_duplicate="fail_matched")
    unknown = rows(spark, ("z", D1, 1, 2), ("z", D1, 2, 2))
    upsert.merge_into(spark, path, unknown, on_duplicate="fail_matched")
    assert upsert.read_stored(spark, path).where("reading_id = 'z'").count() == 2
    upsert.merge_into(spark, path, twice, on_duplicate="latest")
    got = upsert.read_stored(spark, path)
    assert content(got.where("reading_id = 'a'")) == [("a", D2, "11")]
    assert got.where("reading_id is null").count() == 4


def test_empty_target_counts_as_first_run(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base.where("false"))
    assert upsert.high_water_mark(upsert.read_stored(spark, path)) is None
    upsert.merge_into(spark, path, base)
    assert upsert.read_stored(spark, path).count() == 6


def test_high_water_mark_is_strict(base, change):
    mark = upsert.high_water_mark(base)
    everything = base.unionByName(change)
    assert content(upsert.newer_than(everything, mark)) == content(change)
    assert upsert.newer_than(everything, None).count() == 11


def test_schema_sync_in_memory(base, change):
    wider = change.drop("value").withColumn("site", F.lit("s"))
    got = upsert.upsert(base, wider)
    assert got.columns == wider.columns
    assert got.where("site is null").count() == 3


def test_schema_sync_stored(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base)
    added = rows(spark, ("a", D1, 10, 2)).withColumn("site", F.lit("s"))
    upsert.merge_into(spark, path, added)
    got = upsert.read_stored(spark, path)
    assert content(got, "reading_id", "value", "site")[1:4] == [("a", "10", "s"), ("b", "2", "None"), ("c", "3", "None")]
    dropped = rows(spark, ("c", D2, 0, 3)).drop("value").withColumn("site", F.lit("s2"))
    upsert.merge_into(spark, path, dropped)
    got = upsert.read_stored(spark, path)
    assert "value" not in got.columns and got.count() == 6
    # The column returns: its former values stay gone, also in untouched files.
    upsert.merge_into(spark, path, rows(spark, ("c", D2, 33, 4)).withColumn("site", F.lit("s3")))
    got = upsert.read_stored(spark, path)
    assert content(got.where("value is not null"), "reading_id", "value", "site") == [("c", "33", "s3")]
    assert got.count() == 6


def test_changed_type_rewrites(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base)
    upsert.merge_into(spark, path, rows(spark, ("c", D2, 3, 2)).withColumn("value", F.lit(3.5)))
    got = upsert.read_stored(spark, path)
    assert dict(got.dtypes)["value"] in ("double", "decimal(2,1)")
    assert got.agg(F.sum(F.col("value").cast("double"))).first()[0] == 1 + 2 + 3.5 + 4 + 5 + 6


def test_swap_that_died_is_finished(spark, tmp_path, base, change, monkeypatch):
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base)
    real = upsert.recover
    calls = []

    def dies_second_time(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        real(spark, path)

    monkeypatch.setattr(upsert, "recover", dies_second_time)
    with pytest.raises(RuntimeError, match="driver lost"):
        upsert.merge_into(spark, path, change)
    monkeypatch.setattr(upsert, "recover", real)
    # A date directory is lost between removing the old and moving in the new.
    files.delete(spark, f"{path}/reading_date={D1}")
    upsert.merge_into(spark, path, rows(spark, ("g", D2, 90, 3)))
    assert content(upsert.read_stored(spark, path)) == sorted([*WANTED, ("g", D2, "90")])


def died(*args, **kwargs):
    raise RuntimeError("driver lost")


def test_build_that_died_leaves_what_was_there(spark, tmp_path, base, monkeypatch):
    path = f"{tmp_path}/t"
    with monkeypatch.context() as patch:
        patch.setattr(files, "replace_directory", died)
        with pytest.raises(RuntimeError):
            upsert.merge_into(spark, path, base)
    assert not upsert.table_exists(spark, path)
    upsert.merge_into(spark, path, base)
    with monkeypatch.context() as patch:
        patch.setattr(files, "replace_directory", died)
        with pytest.raises(RuntimeError):
            upsert.create_table(spark, path, base.limit(1))
    assert upsert.read_stored(spark, path).count() == 6
    # Set aside, and the new table never came.
    os.rename(path, f"{tmp_path}/_old_t")
    upsert.recover(spark, path)
    assert upsert.read_stored(spark, path).count() == 6


def test_job_that_fails_half_way_leaves_the_old_table(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    tables.write_full(base, path, "reading_date")
    broken = base.withColumn("bad", F.when(F.col("reading_id") == "b", F.raise_error(F.lit("x"))))
    with pytest.raises(Exception):
        tables.write_full(broken, path, "reading_date")
    assert spark.read.parquet(path).count() == 6
    assert sorted(os.listdir(tmp_path)) == ["t"]


def test_full_replacement_ignores_the_session_mode(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        upsert.create_table(spark, path, base)
        upsert.create_table(spark, path, base.where(F.col("reading_date") == F.lit(D1)))
        assert {str(r.reading_date) for r in upsert.read_stored(spark, path).collect()} == {D1}
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_broken_note_does_not_block(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    upsert.merge_into(spark, path, base)
    open(f"{path}/_pending_swap.json", "w").close()
    upsert.merge_into(spark, path, rows(spark, ("a", D1, 10, 2)))
    assert upsert.read_stored(spark, path).count() == 6


def test_policies_of_a_build(spark, tmp_path, base):
    path = f"{tmp_path}/t"
    newer = rows(spark, ("a", D2, 99, 5))
    both = base.unionByName(newer)
    upsert.build_table(spark, path, both)
    assert upsert.read_stored(spark, path).where("reading_id = 'a'").count() == 2
    with pytest.raises(DuplicateKeyError):
        upsert.build_table(spark, path, both, on_duplicate="fail")
    upsert.build_table(spark, path, both, on_duplicate="latest")
    assert content(upsert.read_stored(spark, path).where("reading_id = 'a'")) == [("a", D2, "99")]
    with pytest.raises(ValueError):
        upsert.build_table(spark, path, both, on_duplicate="first")


def test_chain_with_two_versions_of_an_id(spark, tmp_path):
    """A corrected id in later loads neither stops the chain nor returns by a rebuild."""
    lake = chain.Lake(f"{tmp_path}/lake")
    folder = f"{tmp_path}/raw/year=2026/month=01/day=01"
    os.makedirs(folder)
    dimension = schemas.buildings(spark)

    def put(name, humidity):
        with open(f"{folder}/{name}.json", "w") as out:
            out.write(
                '{"reading_id": "r1", "building_id": "BLDG_001", "timestamp": '
                f'"2026-01-01T08:00:00Z", "humidity_pct": {humidity}}}\n'
            )

    def run(**options):
        chain.run(spark, f"{tmp_path}/raw", lake, dimension, check=False, **options)
        return [r.humidity_pct for r in silver.read(spark, lake.silver).collect()]

    put("a", 40)
    assert run() == [40]
    for name, humidity in (("b", 41), ("c", 42)):
        put(name, humidity)
        bronze.load_new_files(spark, f"{tmp_path}/raw", lake.bronze)
    with pytest.raises(DuplicateKeyError):
        run()
    assert run(on_duplicate="latest") == [42]
    assert run(full=True, on_duplicate="latest") == [42]
    assert sorted(run(full=True)) == [40, 41, 42]


def test_two_batches_equal_one_build(spark, sf_dir, tmp_path):
    typed = adapter.readings(spark, sf_dir)
    dimension = schemas.buildings(spark)
    path = f"{tmp_path}/silver"
    early = typed.where(adapter.is_early())
    upsert.merge_into(spark, path, silver.enrich(early, dimension))
    upsert.merge_into(spark, path, silver.enrich(typed.where(~adapter.is_early()), dimension))
    whole = silver.enrich(typed, dimension)
    stored = silver.read(spark, path)
    assert stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()


def test_later_dimension_changes_reach_old_rows_by_full_refresh_only(spark, tmp_path):
    store = bronze.BronzeStore(f"{tmp_path}/bronze")
    path = f"{tmp_path}/silver"
    folder = f"{tmp_path}/raw/year=2026/month=01/day=01"
    os.makedirs(folder)
    dimension = schemas.buildings(spark)
    renamed = dimension.withColumn("building_name", F.lit("New name"))

    def load(name, reading):
        with open(f"{folder}/{name}.json", "w") as out:
            out.write(f'{{"reading_id": "{reading}", "building_id": "BLDG_001", "timestamp": "2026-01-01T08:00:00Z"}}\n')
        bronze.load_new_files(spark, f"{tmp_path}/raw", store)

    load("a", "r1")
    silver.refresh(spark, store, dimension, path)
    load("b", "r2")
    silver.refresh(spark, store, renamed, path)
    names = dict(content(silver.read(spark, path), "reading_id", "building_name"))
    assert names == {"r1": "Emirates Tower Complex", "r2": "New name"}
    silver.refresh(spark, store, renamed, path, full=True)
    names = dict(content(silver.read(spark, path), "reading_id", "building_name"))
    assert names == {"r1": "New name", "r2": "New name"}


def test_repeated_building_is_refused(spark):
    dimension = schemas.buildings(spark)
    with pytest.raises(DuplicateKeyError):
        enrich.sized_dimension(dimension.unionByName(dimension))


def test_large_dimension_is_not_broadcast_by_hint(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(enrich, "BROADCAST_ROWS", 2)
    typed = adapter.readings(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = silver.enrich(typed, schemas.buildings(spark))
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == typed.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
