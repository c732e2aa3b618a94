"""Phrases whose words occur together more often than chance would have it.

Every place of a text is the start of one window of the longest length, its words
in lead columns and padded where the piece ends. Only these windows are counted;
ROLLUP then sums the counts over shorter and shorter prefixes, and since a phrase
starts a window wherever it occurs, its prefix sum is its count. No other n-grams
are exploded.

Before that, windows are padded from the first pair of neighbours that is too rare
to be in a candidate: a phrase is never more frequent than a pair within it. Pairs
are counted by hash for this; pairs that share a hash only cut less. Where the hashes
of frequent pairs are more than may be broadcast, windows stay whole. Neither changes
a result, only the number of different windows.

Scores are of exact decimals. Defined cases: a null text counts as empty, and an
empty one has no words; rows without a language belong to ``und``, as do those of
that name; repeated rows count each; ties are ordered by the phrase; a very long text
is read whole, by one task that holds one row; other columns are not read, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import body, discard, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Pair hashes that are broadcast at most, 8 bytes each and as much again for the table.
BROADCAST_PAIRS = 2_000_000
#: Shares of a language that are ranked by themselves first.
SHARES = 64


def windows(
    docs: DataFrame, words: int, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang, w1, ..``: the window that starts at each word, null beyond its piece."""
    lowered = F.translate(body(text_col), UPPER, LOWER)
    pieces = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.explode(F.split(lowered, "[.,;:!?\\x0A-\\x0D]")).alias("piece"),
    )
    listed = pieces.select(
        "lang", F.filter(F.split("piece", "[ \\t]+"), lambda w: w != "").alias("w")
    )
    # Lists are zipped to the longest, so words near the end get null leads.
    leads = [F.slice("w", F.lit(k + 1), F.size("w")) for k in range(words)]
    return listed.select("lang", F.inline(F.arrays_zip(*leads))).toDF("lang", *_names(words))


def _names(words: int) -> list[str]:
    return [f"w{k}" for k in range(1, words + 1)]


def _pair(k: int) -> Column:
    return F.when(
        F.col(f"w{k + 1}").isNotNull(), F.xxhash64("lang", F.col(f"w{k}"), F.col(f"w{k + 1}"))
    )


def _frequent_pairs(found: DataFrame, least: int) -> DataFrame:
    pairs = found.select(_pair(1).alias("pair")).where("pair is not null")
    counted = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted.where(F.col("n") >= least).select("pair"), "collocation-pairs")


def _padded_at_rare_pairs(found: DataFrame, frequent: DataFrame, words: int) -> DataFrame:
    """Windows that end before the second word of the first pair that is not frequent."""
    reaches = F.lit(True)
    columns = {}
    for k in range(1, words):
        known = F.broadcast(frequent.select(F.col("pair").alias(f"p{k}")))
        found = found.join(known, _pair(k) == F.col(f"p{k}"), "left")
        reaches = reaches & F.col(f"p{k}").isNotNull()
        columns[f"w{k + 1}"] = F.when(reaches, F.col(f"w{k + 1}"))
    return found.select("lang", "w1", *[c.alias(name) for name, c in columns.items()])


def phrase_counts(
    docs: DataFrame, words: int, least: int, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang, size, phrase, words, f``: what occurs ``least`` times, up to ``words`` words.

    The row of size 0 holds the number of all words of the language.
    """
    found = windows(docs, words, text_col, lang_col)
    pairs = _frequent_pairs(found, least)
    if pairs.count() <= BROADCAST_PAIRS:
        found = _padded_at_rare_pairs(found, pairs, words)
    names = _names(words)
    longest = materialize(
        found.groupBy("lang", *names).agg(F.count(F.lit(1)).alias("f")), "collocation-windows"
    )
    discard(pairs)
    summed = longest.rollup("lang", *names).agg(
        F.grouping_id().alias("rolled"), F.sum("f").alias("f")
    )
    # One bit for each column that is summed over, the last column lowest.
    kept = words - F.bit_count("rolled")
    listed = F.array(*names)
    phrase = F.slice(listed, F.lit(1), F.greatest(kept, F.lit(0)))
    counts = summed.where(kept >= 0).select("lang", kept.alias("kept"), phrase.alias("words"), "f")
    # A prefix that ends in padding is a shorter phrase, counted by itself.
    ended = F.when(F.col("kept") > 0, F.get("words", F.col("kept") - 1).isNotNull()).otherwise(True)
    counts = counts.where(ended & ((F.col("f") >= least) | (F.col("kept") == 0)))
    # Words hold no spaces, so a joined phrase stands for its words.
    phrase = F.array_join("words", " ").alias("phrase")
    out = materialize(
        counts.select("lang", F.col("kept").alias("size"), phrase, "words", "f"),
        "collocation-counts",
    )
    discard(longest)
    return out


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(18,0)")


def collocations(
    docs: DataFrame,
    words: int = 5,
    least: int = 100,
    most: int = 2000,
    share: int = 100,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``most`` best phrases of each language.

    ``a`` is the count of a phrase of two words or more, ``l`` and ``r`` those of the
    parts of the cut that scores lowest, ``floor(1000 a n / (l r))``, ``n`` the number
    of words. A phrase inside a longer one with ``share`` percent of its count goes.
    """
    counts = phrase_counts(docs, words, least, text_col, lang_col)
    # Stored, so that its size is known: of few languages it is broadcast.
    totals = materialize(
        counts.where("size = 0").select("lang", F.col("f").alias("n")), "collocation-totals"
    )
    parts = counts.where("size > 0").select("lang", "phrase", "f")
    candidates = counts.where("size > 1").withColumnRenamed("f", "a")

    def joined(begin: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", begin, length), " ")

    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k",
        joined(F.lit(1), F.col("k")).alias("left"),
        joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    ls = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rs = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cut.join(ls, ["lang", "left"]).join(rs, ["lang", "right"]).join(totals, "lang")
    # 38 digits hold a thousand times two counts of 17 digits; beyond that the query fails.
    thousand = F.lit(1000).cast("decimal(4,0)")
    above, below = _exact("a") * _exact("n") * thousand, _exact("l") * _exact("r")
    lowest = (
        scored.select("*", above.alias("above"), below.alias("below"))
        .withColumn("score", F.expr("above div below"))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )

    runs = [
        F.struct(F.lit(b).alias("b"), F.lit(m).alias("m"))
        for m in range(2, words)
        for b in range(1, words - m + 2)
    ]
    inside = (
        candidates.where("size > 2")
        .select("lang", "words", "size", "a", F.inline(F.array(*runs)))
        .where("m < size and b + m - 1 <= size")
        .groupBy("lang", joined(F.col("b"), F.col("m")).alias("phrase"))
        .agg(F.max("a").alias("longer"))
    ) if runs else candidates.select("lang", "phrase", F.col("a").alias("longer")).limit(0)
    kept = (
        lowest.join(inside, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    # Ranked in shares first: of a large language few rows meet in one task.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    first = Window.partitionBy("lang", "some").orderBy(*best)
    kept = kept.withColumn("some", some).withColumn("rank", F.row_number().over(first))
    kept = kept.where(F.col("rank") <= most).drop("some", "rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    return (
        kept.withColumn("rank", rank)
        .where(F.col("rank") <= most)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
