"""File listings and the few file-system calls the DataFrame API lacks."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a directory holds anything readers would see."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return False
    return any(
        not status.getPath().getName().startswith(("_", "."))
        for status in fs.listStatus(target)
    )


def stored_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _locate(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def read_note(spark: SparkSession, path: str) -> str | None:
    """Content of a small side file, or None when it does not exist."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a side file at once: a crash leaves the old content or the new."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/_draft{name}"
    fs, target = _locate(spark, draft)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    move_over(spark, draft, path)


def move_over(spark: SparkSession, source: str, path: str) -> None:
    """Renames a file or an empty place's directory over ``path``, replacing a file there."""
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    _, start = _locate(spark, source)
    _, target = _locate(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(start, target, options)


def replace_directory(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts the finished directory ``fresh`` in the place of ``path``.

    The old directory is set aside first and goes last. A crash in between leaves
    it beside ``path``, where ``restore_directory`` finds it.
    """
    fs, source = _locate(spark, fresh)
    _, target = _locate(spark, path)
    _, aside = _locate(spark, _aside(path))
    if fs.exists(target):
        fs.delete(aside, True)
        fs.rename(target, aside)
    elif target.getParent() is not None:
        fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{fresh} could not be moved to {path}")
    fs.delete(aside, True)


def move_partitions(spark: SparkSession, staged: str, path: str, column: str) -> None:
    """Puts each finished directory ``column=value`` of ``staged`` in the place of that of ``path``.

    Both lie in one file system. A directory that has been moved is no longer staged, so
    a call that died is completed by the next one.
    """

    def move(folder: str) -> None:
        target = f"{path}/{folder.rstrip('/').rpartition('/')[2]}"
        delete(spark, target)
        fs, source = _locate(spark, folder)
        if not fs.rename(source, _locate(spark, target)[1]):
            raise OSError(f"{folder} could not be moved to {target}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, [folder for _, folder in partition_folders(spark, staged, column)]))


def restore_directory(spark: SparkSession, path: str) -> None:
    """Brings back a directory whose replacement was broken off."""
    fs, target = _locate(spark, path)
    _, aside = _locate(spark, _aside(path))
    if fs.exists(aside) and not fs.exists(target):
        fs.rename(aside, target)


def _aside(path: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_old_{name}"


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a path."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def partition_folders(spark: SparkSession, path: str, column: str) -> list[tuple[str, str]]:
    """Value and path of each directory ``column=value`` directly below a path."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    found = []
    for status in fs.listStatus(target):
        key, _, value = status.getPath().getName().partition("=")
        if key == column and status.isDirectory():
            found.append((value, status.getPath().toString()))
    return found


def partition_numbers(spark: SparkSession, path: str, column: str) -> list[tuple[int, str]]:
    """The numbers of directories ``column=number`` below a path, with their paths."""
    found = partition_folders(spark, path, column)
    return sorted((int(value), folder) for value, folder in found if value.isdigit())


def partition_folder(column: str, value: object) -> str:
    """The folder name of a partition."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def partition_dates(spark: SparkSession, path: str, column: str) -> list[dt.date | None]:
    """The dates of directories ``column=date`` below a path; None for the one without a date."""
    return [
        None if value == "__HIVE_DEFAULT_PARTITION__" else dt.date.fromisoformat(value)
        for value, _ in partition_folders(spark, path, column)
    ]


def escaped(path: str) -> str:
    """A path that readers take literally, not as a pattern."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def list_files(
    spark: SparkSession, prefix: str, glob: str = "*.json", paths: list[str] | None = None
) -> DataFrame:
    """Files below a prefix with length and modification time; no content is read.

    ``paths`` limits the listing to some directories below the prefix. Hive-style
    directories below the prefix come back as columns.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    listing = reader.option("basePath", prefix).load(paths or prefix)
    fixed = ("path", "modificationTime", "length", "content")
    return listing.select(
        "path",
        "length",
        F.unix_micros("modificationTime").alias("modified_micros"),
        *[c for c in listing.columns if c not in fixed],
    )
