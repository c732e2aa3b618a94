"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # A bad value must fail a strict cast instead of turning into null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small partitions, splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

# Compressed table bytes per shuffle partition, and the most partitions to ask for.
BYTES_PER_PARTITION = 64 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_own_dirs: dict[str, str] = {}


def local_session(cores: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sensorlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, because a machine-local folder would
    be invisible to the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="sensorlake-")
    return _own_dirs[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/sensorlake/{label}-{uuid.uuid4().hex}"


@contextmanager
def sized_shuffles(spark: SparkSession, table_bytes: int) -> Iterator[None]:
    """Within this context shuffles start with partitions enough for such a table.

    The adaptive plan merges those that stay small, so starting high costs
    little, while too few would each have to spill. A setting of the session's
    own is left alone.
    """
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(table_bytes // BYTES_PER_PARTITION, MAX_SHUFFLE_PARTITIONS)
    if wanted <= usual or spark.conf.get(_INITIAL_PARTITIONS, None) is not None:
        yield
        return
    spark.conf.set(_INITIAL_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        spark.conf.unset(_INITIAL_PARTITIONS)
