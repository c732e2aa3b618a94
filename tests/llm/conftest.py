from __future__ import annotations

import pytest
from pyspark.sql import functions as F

#: Text of many kinds: null, empty, blank, one word, long, many lines, wide characters.
TEXTS = [
    (0, "one two three four five six seven", "a"),
    (1, "one two three four five six seven", "b"),
    (2, None, "a"),
    (3, "", None),
    (4, "  \t\n ", "a"),
    (5, "Word", "a"),
    (6, "ÀÉÎ ßtraße 東京 🙂🙂 don't I'll  x\x1c\x85y  z", "b"),
    (7, "line one is here\nline two is there\n\nline three\n" * 40, "a"),
    (8, "x" * 30_000, "b"),
    (9, "zebra " * 9_000, "b"),
    (10, "The quick brown fox jumps over the lazy dog. " * 3 + "END", "a"),
    (11, "Prefix. " + "The quick brown fox jumps over the lazy dog. " * 3 + "tail", "a"),
    (12, "a\x00b\x00" * 100, "a"),
    (None, "a row without an id", "a"),
    (0, "one two three four five six seven", "a"),
    (14, "ONE two THREE four five six seven", None),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows and clashing column names."""
    rows = [(i, t, s, None if i is None else i % 3) for i, t, s in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    for name in ("body", "digest", "bits", "ids", "copy", "n", "h", "unit", "kept", "rate", "row"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs.repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
