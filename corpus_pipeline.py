"""A corpus pipeline: each stage is one operator of ``sensorlake.llm``.

Every stage takes what its predecessor kept, as written, and all but the last
return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import exact_dedup, mixing, queries, simhash, toxicity
from sensorlake.llm.common import materialize


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay."""
    labels = queries.table(spark, sf_dir, "labels")
    scorer = toxicity.fit(docs, labels, training=queries.fold(5) != 0)
    rows = docs.select(F.struct("*").alias("doc"))
    scored = scorer.score(rows, F.col("doc.text"), out="toxic_score")
    return scored.where("toxic_score < 0.5").select("doc.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.without_copies(docs, keep="largest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays."""
    return simhash.without_near_copies(docs, words=4, max_bits=4)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at equal shares of characters; documents repeat or go accordingly."""
    return mixing.mix(docs).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of the bytes they decode to."""
    bpe = queries.tokenizer(spark)
    return queries.token_digests(docs.select("doc_id", "source", "text"), bpe, "source", "ids")


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("source_mixing", source_mixing),
    ("byte_bpe", encoding),
]

#: Learned scores, linked components and tokenization are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
