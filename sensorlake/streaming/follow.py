"""Follow a landing folder: each file once into bronze, then upsert silver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sensorlake import schemas
from sensorlake.operators import upsert
from sensorlake.plans import bronze, silver
from sensorlake.plans.bronze import BronzeStore
from sensorlake.sources import json_lines


def file_stream(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Lines of files as they appear below ``root``, at most ``max_files`` at a time if given."""
    reader = spark.readStream.format("text").option("pathGlobFilter", json_lines.JSON_GLOB)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return json_lines.with_provenance(reader.load(root))


def _label(batch_id: int) -> str:
    return f"stream-{batch_id:010d}"


def follow(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    each_batch: Callable[[DataFrame, int], None],
    max_files: int | None = None,
) -> StreamingQuery:
    """Runs over all files not seen before, in one micro-batch or several of ``max_files``."""
    return (
        file_stream(spark, root, max_files)
        .writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def to_bronze(
    spark: SparkSession,
    root: str,
    store: BronzeStore,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Loads every file once.

    A micro-batch that is replayed has the same files and the same label, so it
    replaces its own rows and keeps its load time.
    """

    def each_batch(lines: DataFrame, batch_id: int) -> None:
        bronze.land(lines.sparkSession, lines, store, _label(batch_id))

    return follow(spark, root, checkpoint, each_batch, max_files)


def to_silver(
    spark: SparkSession,
    root: str,
    store: BronzeStore,
    buildings: DataFrame,
    path: str,
    checkpoint: str,
    max_files: int | None = None,
    on_cast_error: str = "fail",
    on_duplicate: str = "fail_matched",
) -> StreamingQuery:
    """Loads every file once and upserts its readings into silver.

    Each micro-batch merges the bronze rows of its own load, found by partition.
    There is no watermark: late readings are accepted without limit.
    """

    def each_batch(lines: DataFrame, batch_id: int) -> None:
        session = lines.sparkSession
        label = _label(batch_id)
        bronze.land(session, lines, store, label)
        landed = bronze.read_load(session, store, label, row_numbers=False)
        rows = silver.build(landed, buildings, on_cast_error=on_cast_error)
        upsert.merge_into(
            session, path, rows, on_duplicate=on_duplicate, order=schemas.SILVER_ORDER
        )

    return follow(spark, root, checkpoint, each_batch, max_files)
