"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A code is cut into segments. Two codes within distance ``m * (r + 1) - 1`` agree on
at least one of ``m`` segments up to ``r`` bits, so probing every segment with all
values up to ``r`` bits away finds them all. Radii grow, segment by segment, for
each query until its k-th best verified distance is covered, which proves that
nothing nearer is left.

Codes that repeat are searched once, as their ids of least value; a query set with
repeated codes likewise. Pairs leave the join verified and within the distance a
query can still use: at first its k-th distance among a bounded sample of codes,
which no better result can exceed.

Defined cases: a row with a null or empty vector, or without an id, is neither
query nor result; vectors must have one length; fewer codes than k give as many
results as there are; ties go to the smaller id; repeated rows are results each;
a query meets its own row too; an empty table gives an empty result. Columns other
than ``id`` and ``code`` are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.llm.common import hashed_sample, materialize

#: Codes whose distances give each query its first bound.
SAMPLE = 2_048
_WORD = 64


def sign_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, code``: a bit for each component, set where it is positive, in 64-bit words."""

    @F.arrow_udf(T.ArrayType(T.LongType(), False))
    def code(column: pa.Array) -> pa.Array:
        rows = []
        for vector in column:
            bits = np.array([x is not None and x > 0 for x in vector.as_py()], bool)
            words = np.packbits(np.pad(bits, (0, -len(bits) % _WORD)))
            rows.append(words.view(">i8").astype(np.int64))
        return pa.array(rows, pa.list_(pa.int64()))

    some = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    some = some.where(F.col("id").isNotNull() & (F.size("vector") > 0))
    return some.select("id", code("vector").alias("code"))


def hamming(a: str, b: str) -> Column:
    differing = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differing, F.lit(0), lambda s, n: s + n)


def _segment(code: str, number: Column, width: int) -> Column:
    """The bits of a segment as a number."""
    per_word = _WORD // width
    word = F.element_at(code, (F.floor(number / per_word) + 1).cast("int"))
    shift = (number % per_word * width).cast("int")
    return F.call_function("shiftrightunsigned", word, shift).bitwiseAND(F.lit((1 << width) - 1))


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]


def nearest(
    codes: DataFrame, queries: DataFrame, bits: int, k: int = 10, width: int = 16
) -> DataFrame:
    """``query_id, rank, id, distance``: the k nearest codes of every query.

    ``codes`` and ``queries`` have ``id`` and ``code``; ``width`` divides 64 and is
    the length of a segment, about the logarithm of the number of codes.
    """
    spark = codes.sparkSession
    segments = -(-bits // width)
    # Of equal codes the k smallest ids are enough; the limit applies before the shuffle.
    order = W.partitionBy("code").orderBy("id")
    members = (
        codes.select("id", "code")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k)
    )
    members = materialize(members, "codes")
    index = materialize(
        members.groupBy("code").agg(
            F.min("id").alias("least_id"), F.count(F.lit(1)).alias("held")
        ),
        "codes-distinct",
    )
    asked = materialize(queries.select(F.col("code").alias("query")).distinct(), "codes-asked")
    sample = hashed_sample(index, "code", SAMPLE)
    first = _first_bounds(asked, sample, k)
    bounds = materialize(first.withColumn("bound", F.least("bound", F.lit(bits))), "codes-bounds")
    keyed = index.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment")
    ).withColumn("value", _segment("code", F.col("segment"), width))
    keyed = materialize(keyed, "codes-index")

    open_queries, best, done = bounds, None, []
    for radius in range(width + 1):
        # Segments a query still needs: with those before, they cover its bound.
        needed = F.col("bound") - F.lit(segments * radius - 1)
        probes = (
            open_queries.withColumn(
                "segment", F.explode(F.sequence(F.lit(0), F.least(needed, F.lit(segments)) - 1))
            )
            .withColumn("at", _segment("query", F.col("segment"), width))
            .withColumn("mask", F.explode(F.lit(_masks(width, radius)).cast("array<long>")))
            .select("query", "bound", "segment", F.col("at").bitwiseXOR(F.col("mask")).alias("value"))
        )
        distance = hamming("query", "code")
        found = (
            # The planner takes exploded probes for fewer than they are; neither
            # side has a bound, so neither is broadcast.
            probes.join(keyed.hint("merge"), ["segment", "value"])
            .where(distance <= F.col("bound"))
            .select("query", "code", "least_id", "held", distance.alias("distance"))
        )
        found = found if best is None else found.union(best)
        rank = W.partitionBy("query").orderBy("distance", "least_id")
        best = materialize(
            found.distinct().withColumn("r", F.row_number().over(rank)).where(f"r <= {k}").drop("r"),
            "codes-best",
        )
        covered = segments * (radius + 1) - 1
        # The k-th distance so far is a bound too; a query whose bound is covered is complete.
        reached = W.partitionBy("query").orderBy("distance", "least_id")
        kth = (
            best.withColumn("sum", F.sum("held").over(reached))
            .where(f"sum >= {k}")
            .groupBy("query")
            .agg(F.min("distance").alias("kth"))
        )
        state = materialize(
            open_queries.join(kth, "query", "left").select(
                "query", F.least("bound", F.coalesce("kth", "bound")).alias("bound")
            ),
            "codes-open",
        )
        done.append(best.join(state.where(f"bound <= {covered}"), "query", "left_semi"))
        open_queries = state.where(f"bound > {covered}")
        if open_queries.isEmpty():
            break
        best = best.join(open_queries, "query", "left_semi")
    result = done[0]
    for part in done[1:]:
        result = result.union(part)
    near = result.select("query", "code", "distance").join(members.select("id", "code"), "code")
    final = W.partitionBy("query").orderBy("distance", "id")
    ranked = near.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return queries.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(
        ranked, "query"
    ).select("query_id", "rank", "id", "distance")


def _first_bounds(asked: DataFrame, sample: DataFrame, k: int) -> DataFrame:
    """Each query's k-th distance among the sample; all bits where the sample is too small."""
    spark = asked.sparkSession
    rows = [r["code"] for r in sample.select("code").collect()]
    known = spark.sparkContext.broadcast(np.array(rows, np.int64).view(np.uint64))

    @F.arrow_udf(T.IntegerType())
    def kth(column: pa.Array) -> pa.Array:
        out = []
        for query in column:
            code = np.array(query.as_py(), np.int64).view(np.uint64)
            if len(known.value) < k:
                out.append(len(code) * _WORD)
                continue
            apart = np.bitwise_count(known.value ^ code).sum(axis=1)
            out.append(int(np.partition(apart, k - 1)[k - 1]))
        return pa.array(out, pa.int32())

    return asked.select("query", kth("query").alias("bound"))
