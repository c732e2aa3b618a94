"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge; ``root`` is the least node reachable.

    ``edges`` has two columns of the same type. Alternates two star operations,
    each of which hands neighbours on to the least one: larger neighbours, then
    smaller ones, until nothing changes, after a number of rounds logarithmic in
    the graph. Minima are aggregated before the shuffle and stored before they are
    joined, so the adaptive plan can split a node with very many neighbours.
    """
    a, b = edges.columns
    found = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    found = materialize(found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    before = None
    while (now := _state(found)) != before:
        before = now
        found = materialize(_small_star(_large_star(found)), "edges")
    roots = found.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return found.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges already point from the larger node to the smaller.
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = edges.join(least, "u").where("v <> m")
    handed = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.union(least.select("u", F.col("m").alias("v"))).distinct()
