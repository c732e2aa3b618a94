"""Removal of repeated lines by aligning documents pairwise.

Documents that share a rare line are aligned with patience diff: lines unique in
both are anchors, their longest increasing run is kept, and gaps are aligned in
turn. Blocks of aligned lines that hold a shared rare line go from the later
document.

Each rare line pairs a document with the first document that has it. Where that
leaves the line in place, the document meets the other earlier ones in rounds, each
four times as long, until the line goes or none is left. Patience diff aligns nothing
in two texts that share neither their first line, nor their last, nor a line standing
once in both (a seed). So a document meets only those that share a line that stays
and a seed with it, and each of them once: a divider in every text makes no pairs by
itself. The rare lines that go are those that go when all pairs are aligned, but most
documents meet one other. (With a limit given for rare lines only the first round is
made.) Only line hashes travel; texts are read once more at the end. Of equal texts
the first stands for all, and the others, aligned with it from end to end, lose every
line.

Defined cases: a null text counts as empty; blank lines are never rare and go only
inside a block; lines are compared without surrounding blanks; an empty table gives
an empty result; a row without an id comes before all others; rows repeating an id
and text are one document, reported for each row; rows repeating an id with other
texts are ordered by a digest of the text. Texts of any length are aligned whole, a
pair in one task. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import body, discard, materialize

#: A usual limit for rare lines, for calls that want one; without it every shared line is rare.
MOST_DOCUMENTS = 10_000


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of positions aligned, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo_a, hi_a, lo_b, hi_b = todo.pop()
        while lo_a < hi_a and lo_b < hi_b and a[lo_a] == b[lo_b]:
            out.append((lo_a, lo_b))
            lo_a, lo_b = lo_a + 1, lo_b + 1
        while lo_a < hi_a and lo_b < hi_b and a[hi_a - 1] == b[hi_b - 1]:
            hi_a, hi_b = hi_a - 1, hi_b - 1
            out.append((hi_a, hi_b))
        if lo_a == hi_a or lo_b == hi_b:
            continue
        in_a, in_b = Counter(a[lo_a:hi_a]), Counter(b[lo_b:hi_b])
        place = {x: i for i, x in enumerate(a[lo_a:hi_a], lo_a) if in_a[x] == 1 and in_b[x] == 1}
        common = [(place[x], j) for j, x in enumerate(b[lo_b:hi_b], lo_b) if x in place]
        anchors = _longest_increasing(common)
        if not anchors:
            continue
        out.extend(anchors)
        inner = [(lo_a - 1, lo_b - 1), *anchors, (hi_a, hi_b)]
        todo.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(inner[:-1], inner[1:]))
    return sorted(out)


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs ordered by the second, the longest run increasing in the first."""
    tops: list[int] = []
    ends: list[int] = []
    before = []
    for n, (i, _) in enumerate(pairs):
        pile = bisect_left(tops, i)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(i)
            ends.append(n)
        else:
            tops[pile], ends[pile] = i, n
    out = []
    n = ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def common_blocks(a: list, b: list, rare: set) -> list[int]:
    """Lines of ``b`` in aligned blocks that hold a rare line."""
    out: list[int] = []
    block: list[int] = []
    last = None
    for i, j in [*patience(a, b), (-9, -9)]:
        if last is not None and (i, j) != (last[0] + 1, last[1] + 1):
            if any(b[x] in rare for x in block):
                out.extend(block)
            block = []
        block.append(j)
        last = (i, j)
    return out


@F.arrow_udf(T.ArrayType(T.IntegerType(), False))
def _aligned(a: pa.Array, b: pa.Array, rare: pa.Array) -> pa.Array:
    rows = zip(a, b, rare)
    made = [common_blocks(x.as_py(), y.as_py(), set(z.as_py())) for x, y, z in rows]
    return pa.array(made, pa.list_(pa.int32()))


@F.arrow_udf(T.ArrayType(T.IntegerType(), False))
def _aligned_whole(a: pa.Array, b: pa.Array, blank: pa.Array) -> pa.Array:
    """As ``_aligned`` where every shared line but the blank one is rare."""
    rows = ((x.as_py(), y.as_py(), z.as_py()) for x, y, z in zip(a, b, blank))
    made = [common_blocks(x, y, set(y) - {z}) for x, y, z in rows]
    return pa.array(made, pa.list_(pa.int32()))


@F.arrow_udf(T.ArrayType(T.LongType(), False))
def _seeds(lines: pa.Array) -> pa.Array:
    """Numbers of the lines that stand once, and of the first and the last as such.

    Two lines may get one number: documents may then meet in vain, but none is missed.
    """
    made = []
    for row in lines:
        values, times = np.unique(np.array(row.as_py(), np.int64), return_counts=True)
        ends = np.array([row[0].as_py() ^ 0x5DEECE66D, row[-1].as_py() ^ 0x2545F4914F6CDD1D], np.int64)
        made.append(np.concatenate([values[times == 1], ends]))
    return pa.array(made, pa.list_(pa.int64()))


@F.arrow_udf(T.ArrayType(T.LongType(), False))
def _staying(lines: pa.Array, gone: pa.Array, asked: pa.Array) -> pa.Array:
    """The lines asked for that are left somewhere once others are gone."""
    made = []
    for x, y, z in zip(lines, gone, asked):
        away = set(y.as_py())
        left = {line for n, line in enumerate(x.as_py()) if n not in away}
        made.append([line for line in z.as_py() if line in left])
    return pa.array(made, pa.list_(pa.int64()))


def _ranked(holders: DataFrame) -> DataFrame:
    """``key, line, place, digest, rank``: the documents of each key numbered in order.

    By a global sort, so a key of very many documents is cut into several tasks.
    """
    columns = ["key", "line", "place", "digest"]
    part, at = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    ordered = materialize(
        holders.sort("key", "place", "digest", "line").select(*columns, part, at), "lines-ordered"
    )
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ordered.groupBy("key", "part")
        .agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("n"))
        .withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    parts = materialize(parts, "lines-parts")
    rank = (F.col("at") - F.col("begin") + F.col("skip")).alias("rank")
    ranked = materialize(ordered.join(parts, ["key", "part"]).select(*columns, rank), "lines-ranked")
    discard(ordered, parts)
    return ranked


def _keyed(texts: DataFrame, holders: DataFrame, open_lines: DataFrame) -> DataFrame:
    """``key, line, place, digest``: a key for each open line of a document and each of its seeds."""
    lines = materialize(open_lines.select("line").distinct(), "lines-wanted")
    who = materialize(
        holders.join(lines, "line", "left_semi").select("line", "place", "digest"), "lines-who"
    )
    involved = who.select("digest").distinct()
    seeds = materialize(
        texts.join(involved, "digest", "left_semi")
        .select("digest", F.explode(_seeds("lines")).alias("seed")),
        "lines-seeds",
    )

    def shared(rows: DataFrame, name: str) -> DataFrame:
        twice = rows.groupBy(name).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
        return rows.join(materialize(twice.select(name), f"lines-{name}s"), name, "left_semi")

    keyed = who.join(shared(seeds, "seed"), "digest").select(
        F.xxhash64("line", "seed").alias("key"), "line", "place", "digest"
    )
    # Only stored once reduced twice: by seeds of one document, then by keys of one.
    return shared(materialize(keyed, "lines-keyed"), "key")


def _later_rounds(texts: DataFrame, holders: DataFrame, met: DataFrame, found: DataFrame) -> DataFrame:
    """All that is ``found``, once lines left by their first holder have met the others.

    ``met`` are the pairs aligned so far.
    """

    def staying(asked: DataFrame) -> DataFrame:
        left = _staying("lines", F.coalesce("gone", F.array().cast("array<int>")), "asked")
        return (
            asked.groupBy("digest")
            .agg(F.collect_set("line").alias("asked"))
            .join(texts.select("digest", "lines"), "digest")
            .join(_gone(found), "digest", "left")
            .select("digest", F.explode(left).alias("line"))
        )

    open_lines = materialize(staying(holders.where("digest != first.digest")), "lines-open")
    if open_lines.isEmpty():
        return found
    ranked = _ranked(_keyed(texts, holders, open_lines))
    open_keys = ranked.join(open_lines, ["line", "digest"], "left_semi")
    low, high = 0, 4
    while True:
        open_keys = materialize(open_keys.where(F.col("rank") > low), "lines-open")
        if open_keys.isEmpty():
            return found
        earlier = ranked.where(F.col("rank").between(low, high - 1)).select(
            "key", F.col("digest").alias("a_digest"), F.col("rank").alias("a_rank")
        )
        pairs = (
            open_keys.join(earlier, "key")
            .where((F.col("rank") > F.col("a_rank")) & (F.col("digest") != F.col("a_digest")))
            .select("a_digest", "digest")
            .distinct()
            .join(met, ["a_digest", "digest"], "left_anti")
        )
        pairs = materialize(pairs, "lines-pairs")
        met = met.union(pairs)
        found = found.union(materialize(_align(texts, pairs), "lines-aligned"))
        open_keys = open_keys.join(staying(open_keys), ["line", "digest"], "left_semi")
        low, high = high, 4 * high


def _gone(found: DataFrame) -> DataFrame:
    """``digest, gone``: of each text the numbers of the lines that go, each once before it is collected."""
    each = found.select("digest", F.explode("gone").alias("line_no")).distinct()
    return each.groupBy("digest").agg(F.collect_list("line_no").alias("gone"))


def _align(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``digest, a_place, gone`` of the pairs in which something aligned goes."""
    earlier = texts.select(
        F.col("digest").alias("a_digest"), F.col("place").alias("a_place"), F.col("lines").alias("a")
    )
    if "rare" in pairs.columns:
        gone = _aligned("a", "b", "rare")
    else:
        gone = _aligned_whole("a", "b", F.xxhash64(F.lit("")))
    return (
        pairs.join(earlier, "a_digest")
        .join(texts.select("digest", F.col("lines").alias("b")), "digest")
        .select("digest", "a_place", gone.alias("gone"))
        .where(F.size("gone") > 0)
    )


def repeated_lines(rows: DataFrame, most_documents: int | None) -> DataFrame:
    """``digest, first, gone, partners`` for each distinct text.

    ``first`` is the place of the first document with that text, ``gone`` the
    numbers of its lines to delete, ``partners`` the earlier documents that have them.
    """
    marked = rows.select(
        "place",
        "digest",
        F.transform(F.split("body", "\n"), lambda x: F.xxhash64(F.trim(x))).alias("lines"),
    )
    marked = materialize(marked, "lines")
    # Aggregates are stored before they are joined: the joins then have shuffles of
    # their own, which the adaptive plan can split at a very frequent text or line.
    firsts = materialize(marked.groupBy("digest").agg(F.min("place").alias("place")), "lines-firsts")
    texts = materialize(
        marked.join(firsts, ["digest", "place"]).dropDuplicates(["digest"]), "lines-texts"
    )
    blank = F.xxhash64(F.lit(""))
    held = texts.select("place", "digest", F.explode(F.array_distinct("lines")).alias("line"))
    held = held.where(F.col("line") != blank)
    who = F.struct("place", "digest")
    rare = (
        held.groupBy("line")
        .agg(F.count(F.lit(1)).alias("documents"), F.min(who).alias("first"))
        .where(F.col("documents") >= 2 if most_documents is None else F.col("documents").between(2, most_documents))
    )
    rare = materialize(rare, "lines-rare")
    holders = held.join(rare, "line").drop("documents")
    if most_documents is None:
        holders = materialize(holders, "lines-holders")
    pairs = holders.where(F.col("digest") != F.col("first.digest"))
    pair = [F.col("first.digest").alias("a_digest"), "digest"]
    if most_documents is None:
        met = materialize(pairs.select(*pair).distinct(), "lines-pairs")
        found = materialize(_align(texts, met), "lines-aligned")
        found = _later_rounds(texts, holders, met, found)
    else:
        met = pairs.groupBy(*pair).agg(F.collect_list("line").alias("rare"))
        found = materialize(_align(texts, materialize(met, "lines-pairs")), "lines-aligned")
    partners = found.groupBy("digest").agg(F.array_sort(F.collect_set("a_place")).alias("partners"))
    aligned = _gone(found).join(partners, "digest")
    return texts.select("digest", F.col("place").alias("first")).join(aligned, "digest", "left")


def without_repeats(
    docs: DataFrame,
    most_documents: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_lines, n_removed, partner_ids, kept``: each text without its repeated lines.

    With ``most_documents`` a line in more documents is not rare, and a document meets
    only the first one that has a line.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), body(text_col).alias("body"))
    # Places order documents; a row without an id comes first.
    least = F.lit(-(1 << 63)).cast("long")
    rows = rows.withColumn("place", F.coalesce("doc_id", least))
    rows = rows.withColumn("digest", F.unhex(F.md5("body")))
    found = materialize(repeated_lines(rows, most_documents), "lines-found")
    lines = F.split("body", "\n")
    copy = F.col("place") != F.col("first")
    gone = F.when(copy, F.sequence(F.lit(0), F.size(lines) - 1)).otherwise(
        F.coalesce("gone", F.array().cast("array<int>"))
    )
    # An empty text has one empty line, which is no repeat of anything.
    gone = F.when(F.trim("body") == "", F.array().cast("array<int>")).otherwise(gone)
    partners = F.when(copy, F.array("first")).otherwise(
        F.coalesce("partners", F.array().cast("array<long>"))
    )
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("gone"), i))
    return (
        rows.select("doc_id", "body", "place", "digest")
        .join(found, "digest")
        .select("doc_id", "body", gone.alias("gone"), partners.alias("partners"))
        .select(
            "doc_id",
            F.size(lines).alias("n_lines"),
            F.size("gone").alias("n_removed"),
            F.when(F.size("gone") == 0, F.array().cast("array<long>"))
            .otherwise(F.filter("partners", lambda p: p != least))
            .alias("partner_ids"),
            F.array_join(kept, "\n").alias("kept"),
        )
    )
