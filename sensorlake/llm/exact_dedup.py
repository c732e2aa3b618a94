"""Exact duplicates by 128-bit content hash, with the bytes compared inside groups.

DataFrame functions only. Texts shuffle once, already reduced to one per
distinct text and task, so a group holding a third of all rows costs each task
one text. Members carry digests, not texts, to their group.

Defined cases: a null text counts as empty; an empty table gives an empty result;
rows with a null id are members, and are kept only in a group without any id; of
rows that repeat the kept id and its text each is reported as kept and counted. Texts
of any length are compared whole. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import body, materialize


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    ``keep`` says whether the ``smallest`` or the ``largest`` id of equal texts stays.
    """
    choose = {"smallest": F.min, "largest": F.max}[keep]
    rows = docs.select(F.col(id_col).alias("doc_id"), body(text_col).alias("body"))
    digest, sha = F.unhex(F.md5("body")).alias("digest"), F.sha2("body", 256).alias("text_sha256")

    # Grouping by the text itself, beside its hash, compares the bytes.
    texts = (
        rows.select("doc_id", digest, "body")
        .groupBy("digest", "body")
        .agg(choose("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", sha, "keep_id", "group_size")
    )
    different = F.count(F.lit(1)) > 1
    groups = texts.groupBy("digest", "text_sha256").agg(
        F.when(different, F.raise_error(F.lit("different texts share both digests")))
        .otherwise(F.max("keep_id"))
        .alias("keep_id"),
        F.max("group_size").alias("group_size"),
    )
    # Stored, the join has a shuffle of its own on either side, so that the
    # adaptive plan can split the members of a group that is very large.
    groups = materialize(groups, "exact-groups")
    return (
        rows.select("doc_id", digest, sha)
        .join(groups, ["digest", "text_sha256"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )


def without_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row of ``docs`` for each text, with its columns.

    It is that with the kept id; of rows that repeat the id and the text, the least by
    all columns.
    """
    groups = exact_groups(docs, keep=keep).where("kept")
    kept = groups.groupBy("doc_id", F.col("text_sha256").alias("key")).agg(
        F.count(F.lit(1)).alias("times")
    )
    return rows_of(docs, materialize(kept, "exact-kept"))


def rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """A row of ``docs`` for each id and SHA-256 of a text in ``kept``: ``doc_id, key, times``.

    ``times`` says how many rows have both. Only where there are several are they
    compared, and each task hands on one.
    """
    left, right = docs.alias("d"), kept.alias("k")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (
        F.sha2(body("d.text"), 256) == F.col("k.key")
    )
    once = left.join(right.where("k.times = 1"), same, "left_semi")
    tied = kept.where("times > 1")
    if tied.isEmpty():
        return once
    found = left.join(tied.alias("k"), same).select("k.key", F.struct("d.*").alias("row"))
    least = found.groupBy(F.col("row.doc_id").alias("id"), "key").agg(F.min("row").alias("row"))
    return once.unionByName(least.select("row.*"))
