"""Mixing sources to target weights by Poisson replication.

DataFrame functions only. Each source has a mean repetition rate: its target
share of the characters to draw, over the characters it has. Each document draws
its number of copies by inverting that Poisson distribution at a number hashed
from its id and the seed, so a rerun, or a run over other partitions, draws the
same. Copies are then dealt to partitions and ordered by a second hash, which is
the global shuffle. A source with a third of all rows needs no group: documents
meet only the small table of rates.

Defined cases: a null text counts as empty; a null source is a source of its own;
a source without any character gets no copies; an empty table gives an empty
result; rows repeating an id draw the same number, as do rows without an id;
columns of ``docs`` named ``copy`` or ``mix_key`` are replaced. Texts of any length
count with all their characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import body, materialize

#: A larger rate is drawn as a sum of Poisson numbers of rates up to this one.
MOST_RATE = 8
#: Beyond this count, such a distribution has less than the last bit of a double left.
TERMS = 64


def _hash_bits(digits: int, *parts: Column) -> Column:
    """The first hexadecimal digits of the MD5 of the joined parts, as a number."""
    name = F.concat_ws(":", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(name), 1, digits), 16, 10).cast("long")


def rates(
    docs: DataFrame, weights: dict[str, float] | None = None, total_chars: int | None = None
) -> DataFrame:
    """``source, chars, rate``: how often each document of a source is to appear on average.

    ``weights`` are target shares by source, in any unit; a source not named gets
    none. Without them all sources get the same share. ``total_chars`` is the
    volume to draw; by default as much as there is.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.length(body("text"))).alias("chars"))
    sizes = sizes.where("chars > 0")
    if weights is None:
        weight = F.lit(1.0)
    else:
        named = [F.when(F.col("source").eqNullSafe(k), F.lit(float(w))) for k, w in weights.items()]
        weight = F.coalesce(*named, F.lit(0.0))
    sizes = materialize(sizes.withColumn("weight", weight), "mix-sizes")
    whole = sizes.agg(F.sum("weight").alias("weight"), F.sum("chars").alias("chars")).first()
    chars = whole["chars"] if total_chars is None else total_chars
    share = F.col("weight") / F.lit(whole["weight"] or 1.0)
    return sizes.select(
        "source", "chars", (share * F.lit(float(chars or 0)) / F.col("chars")).alias("rate")
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    total_chars: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """The columns of ``docs`` with ``copy`` (from 1) and ``mix_key``, in shuffled order."""
    docs = docs.drop("copy", "mix_key")
    rated = rates(docs, weights, total_chars).where("rate > 0")
    parts = F.ceil(F.col("rate") / MOST_RATE).cast("int")
    mean = F.col("rate") / F.col("parts")
    first = F.exp(-mean)
    # cdf: the chance of at most 0, 1, 2, ... copies.
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(first.alias("term"), first.alias("sum"), F.array(first).alias("cdf")),
        lambda a, k: F.struct(
            (a["term"] * mean / k).alias("term"),
            (a["sum"] + a["term"] * mean / k).alias("sum"),
            F.concat(a["cdf"], F.array(a["sum"] + a["term"] * mean / k)).alias("cdf"),
        ),
    )
    table = rated.withColumn("parts", parts).select(
        F.col("source").alias("of_source"), "parts", grown["cdf"].alias("cdf")
    )
    name = F.coalesce(F.col("mixed.doc_id").cast("string"), F.lit("null"))

    def drawn(part: Column) -> Column:
        u = _hash_bits(13, F.lit(seed), name, part) / F.lit(float(2**52))
        return F.size(F.filter("cdf", lambda c: c <= u))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda a, p: a + drawn(p))
    place = _hash_bits(15, F.lit(seed), name, F.col("copy"), F.lit("place"))
    return (
        docs.select(F.struct("*").alias("mixed"))
        .join(table, F.col("mixed.source").eqNullSafe(F.col("of_source")))
        .select("mixed", copies.alias("copies"))
        .where("copies > 0")
        .select("mixed", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("mixed.*", "copy", place.alias("mix_key"))
        .repartition("mix_key")
        .sortWithinPartitions("mix_key")
    )
