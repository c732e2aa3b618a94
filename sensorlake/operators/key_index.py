"""Where the rows of a key lie: a stored index from keys to partition dates.

The entries lie in buckets by a hash of the key, sorted by key within each file. A
merge adds entries and takes none away, so an entry may name a date that its key has
left since: the index tells which dates can hold rows of some keys, and the rows
decide. A lookup opens the buckets of its keys only, and within them the row groups
that their range of keys meets.

Additions lie beside the first build; when there are many, they alone are packed
into one, so the entries of a long history are neither rewritten nor shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.sources import files

# Bytes and rows of the table per bucket, and the most buckets there are. Rows that
# compress well are few bytes, and a bucket is written and read by a task or a few.
BUCKET_BYTES = 64 * 1024 * 1024
BUCKET_ROWS = 500_000
MOST_BUCKETS = 16_384
# Additions that lie beside the first build before they are packed.
MOST_ADDITIONS = 32
# Broadcasts by which the keys of one batch are looked up at most; they pass through the driver.
MOST_PIECES = 8

_ADDED = "added"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int").alias("bucket")


def entries(rows: DataFrame, key: str, partition: str, buckets: int) -> DataFrame:
    """The entry of each row; rows without a key have none."""
    found = rows.where(F.col(key).isNotNull())
    return found.select(bucket_of(key, buckets), key, partition)


def write(found: DataFrame, folder: str, key: str) -> None:
    """Stores entries by bucket; a very full bucket is split over several files."""
    (
        found.hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("bucket")
        .parquet(folder)
    )


def added(folder: str, number: int) -> str:
    return f"{folder}/{_ADDED}={number}"


def build(
    spark: SparkSession, folder: str, rows: DataFrame, key: str, partition: str, table_bytes: int
) -> int:
    """Indexes all rows anew; returns the number of buckets."""
    wanted = max(-(-table_bytes // BUCKET_BYTES), -(-rows.count() // BUCKET_ROWS))
    buckets = max(1, min(MOST_BUCKETS, wanted))
    files.delete(spark, folder)
    # Distinct reduces before it shuffles: very many rows of a key on a date are one entry.
    write(entries(rows, key, partition, buckets).distinct(), added(folder, 0), key)
    return buckets


def read(
    spark: SparkSession, folder: str, key: T.StructField, partition: T.StructField
) -> DataFrame:
    """All entries, with the bucket; entries may be repeated."""
    number = T.IntegerType()
    schema = T.StructType([key, partition]).add(_ADDED, number).add("bucket", number)
    return spark.read.schema(schema).parquet(folder)


def lookup(
    index: DataFrame,
    keys: DataFrame,
    key: str,
    buckets: Sequence[int],
    span: tuple[object, object],
    broadcasts: int,
) -> DataFrame:
    """Entries of some keys, which lie in ``buckets`` and within ``span``.

    ``broadcasts`` says into how many pieces the keys must be cut to be broadcast. A
    piece is the keys of some buckets and meets these buckets only, so no entry is
    shuffled or read twice. Beyond ``MOST_PIECES`` keys and entries are shuffled.
    """
    if not buckets:
        return index.limit(0)
    near = index.where(F.col("bucket").isin(buckets)).where(F.col(key).between(*span))
    if broadcasts > min(MOST_PIECES, len(buckets)):
        return near.join(keys.select(key).hint("merge"), key, "left_semi")
    pieces = max(1, broadcasts)
    found = []
    for turn in range(pieces):
        own = F.col("bucket").isin(buckets[turn::pieces])
        known = F.broadcast(keys.where(own).select(key))
        found.append(near.where(own).join(known, key, "left_semi"))
    return reduce(DataFrame.unionByName, found)


def pack(
    spark: SparkSession, folder: str, key: T.StructField, partition: T.StructField
) -> None:
    """Puts the additions into one when there are many.

    The new one is written before the others go. A crash in between leaves entries
    twice, which changes nothing.
    """
    numbers = [n for n, _ in files.partition_numbers(spark, folder, _ADDED) if n > 0]
    # Merges use even numbers, so the odd one after the last is free.
    if len(numbers) <= MOST_ADDITIONS or numbers[-1] % 2:
        return
    additions = read(spark, folder, key, partition).where(F.col(_ADDED) > 0)
    packed = additions.select("bucket", key.name, partition.name).distinct()
    write(packed, added(folder, numbers[-1] + 1), key.name)
    for number in numbers:
        files.delete(spark, added(folder, number))
