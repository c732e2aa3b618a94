"""What a refresh by date writes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sensorlake.sources import files, tables


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


def test_dates_are_replaced_by_files_written_once(spark, tmp_path, history, monkeypatch):
    path = f"{tmp_path}/t"
    tables.write_full(history, path, "reading_date")
    before = listing(path)
    dates = [dt.date(2026, 1, 2), dt.date(2026, 1, 5)]
    fresh = changed(history, F.col("reading_date") == F.lit(dates[0]))
    real, staged = files.move_partitions, []

    def seen(spark, source, target, column):
        staged.append(listing(source))
        real(spark, source, target, column)

    monkeypatch.setattr(files, "move_partitions", seen)
    for _ in range(2):
        tables.replace_dates(fresh, path, "reading_date", dates)
        wanted = {**before, **staged[-1]}
        del wanted["reading_date=2026-01-05"]
        assert listing(path) == wanted
        assert spark.read.parquet(path).where("value >= 1000").count() == 20
        assert not os.path.exists(f"{path}/_staged")
