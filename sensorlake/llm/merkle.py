"""A Merkle manifest of a table: a digest and a witness of every row, one root.

Rows are leaves of one tree per group, in order; the subroots of the groups, in
order, are the leaves of a last tree. While a tree has several nodes, every two
consecutive ones become the hash of both, and a lone last one its own hash.

Leaves are appended to blocks of ``2**block``, aligned to their places, and each
block streams through one task: an append attaches the partial witness known so far
to every leaf of an open subtree, and a later sibling extends it. The roots of the
blocks are appended in the same way, level by level, until one is left. On the way
back the witness of a block comes into its task as the first row and extends the
witnesses of its leaves. A group with a third of all rows is many blocks.

Defined cases: a null field is written ``-``, an empty text ``0:``; rows without a
group are a group of their own, the first; rows without an order value come first
in theirs; rows that tie are ordered by their leaf, and repeated rows are leaves of
their own; a very long text is hashed whole by its own task and never shuffled;
columns of other names are left out, whatever they are called; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.common import discard, materialize

#: Levels of the tree within a block: a task holds this many leaves (as a power of two).
BLOCK = 9

_WITNESS = T.ArrayType(T.StringType())


def framed(*columns: str | Column) -> Column:
    """Fields as text that can be read in one way only: bytes, a colon, the value; or ``-``."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.concat(
        *[
            F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
            for t in texts
        ]
    )


def leaf(*columns: str | Column) -> Column:
    return F.sha2(framed(*columns), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Appender:
    """A growing tree that keeps the witness of each of its leaves.

    A witness lists the siblings from the leaf upwards: ``L`` or ``R`` for the side
    and the digest, or nothing where the node is alone.
    """

    def __init__(self):
        self.witnesses: list[list[str]] = []
        self._open: list[tuple[int, str, int]] = []  # height, digest, first leaf

    def append(self, node: str) -> None:
        self.witnesses.append([])
        self._add(0, node, len(self.witnesses) - 1)

    def _add(self, height: int, node: str, first: int) -> None:
        while self._open and self._open[-1][0] == height:
            _, left, begin = self._open.pop()
            for witness in self.witnesses[begin:first]:
                witness.append("R" + node)
            for witness in self.witnesses[first:]:
                witness.append("L" + left)
            height, node, first = height + 1, digest(left + node), begin
        self._open.append((height, node, first))

    def close(self, height: int = 0) -> str:
        """The root, at ``height`` or above: what is still open is completed with lone nodes."""
        while len(self._open) > 1 or self._open[-1][0] < height:
            at, node, first = self._open.pop()
            for witness in self.witnesses[first:]:
                witness.append("")
            self._add(at + 1, digest(node), first)
        return self._open[-1][1]


def fold(start: Column, witness: Column) -> Column:
    """The root that a leaf and a witness lead to."""

    def step(node: Column, sibling: Column) -> Column:
        other = F.substring(sibling, 2, 64)
        joined = (
            F.when(sibling.startswith("L"), F.concat(other, node))
            .when(sibling.startswith("R"), F.concat(node, other))
            .otherwise(node)
        )
        return F.sha2(joined, 256)

    return F.aggregate(witness, start, step)


def proof(witness: Column) -> Column:
    """Digest of a witness: its siblings in a row."""
    siblings = F.transform(witness, lambda s: F.substring(s, 2, 64))
    return F.sha2(F.array_join(siblings, ""), 256)


# --- places -----------------------------------------------------------------


def _placed(nodes: DataFrame, *order: str) -> DataFrame:
    """Adds ``place``, from 0 within each ``grp``, and ``n``, the nodes of the group.

    Rows are dealt by ranges, so a group may span many tasks; what stands before a
    task's part of a group is a sum over one row per task and group.
    """
    keys = ["grp", *order]
    # Rows that tie in everything can still be dealt to several tasks.
    tied = materialize(nodes.withColumn("tie", F.monotonically_increasing_id()), "merkle-nodes")
    ordered = materialize(
        tied.repartitionByRange(*keys, "tie")
        .sortWithinPartitions(*keys, "tie")
        .drop("tie")
        .withColumn("seq", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("seq", 33)),
        "merkle-ordered",
    )
    discard(tied)
    runs = ordered.groupBy("grp", "part").agg(
        F.min("seq").alias("first"), F.count(F.lit(1)).alias("size")
    )
    whole = Window.partitionBy("grp")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    # Stored, so that its size is known before it is joined.
    runs = materialize(
        runs.select(
            F.col("grp").alias("run_grp"),
            F.col("part").alias("run_part"),
            (before - F.col("first")).alias("shift"),
            F.sum("size").over(whole).alias("n"),
        ),
        "merkle-runs",
    )
    same = F.col("grp").eqNullSafe(F.col("run_grp")) & (F.col("part") == F.col("run_part"))
    return (
        ordered.join(runs, same)
        .withColumn("place", F.col("seq") + F.col("shift"))
        .drop("seq", "part", "run_grp", "run_part", "shift")
    )


# --- blocks -----------------------------------------------------------------


def _blocked(nodes: DataFrame) -> DataFrame:
    keys = ["grp", "block"]
    return nodes.repartition(*keys).sortWithinPartitions(*keys, "place")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block after the other."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        groups, blocks = batch.column("grp").to_pylist(), batch.column("block").to_pylist()
        begin = 0
        for end in range(1, batch.num_rows + 1):
            own = (groups[begin], blocks[begin])
            if end < batch.num_rows and (groups[end], blocks[end]) == own:
                continue
            if held and own != key:
                yield pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(begin, end - begin))
            begin = end
    if held:
        yield pa.Table.from_batches(held)


def _grown(rows: pa.Table, block: int) -> tuple[Appender, str]:
    tree = Appender()
    for node in rows.column("digest").to_pylist():
        tree.append(node)
    n = rows.column("n")[0].as_py()
    return tree, tree.close(block if n > 1 << block else 0)


_ROOTS = pa.schema(
    [("grp", pa.string()), ("digest", pa.string()), ("n", pa.int64()), ("place", pa.int64())]
)


def _roots(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            n = rows.column("n")[0].as_py()
            row = (
                rows.column("grp")[0].as_py(),
                _grown(rows, block)[1],
                (n + (1 << block) - 1) >> block,
                rows.column("block")[0].as_py(),
            )
            columns = [pa.array([v], f.type) for v, f in zip(row, _ROOTS)]
            yield pa.RecordBatch.from_arrays(columns, schema=_ROOTS)

    return run


def _extended(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            # The first row is the block itself, as a node of the level above.
            above, rows = rows.slice(0, 1), rows.slice(1)
            upper = above.column("witness")[0].as_py()
            tree, _ = _grown(rows, block)
            witnesses = pa.array([w + upper for w in tree.witnesses], pa.list_(pa.string()))
            subroots = pa.array(above.column("subroot").to_pylist() * rows.num_rows, pa.string())
            for name, values in (("witness", witnesses), ("subroot", subroots)):
                rows = rows.set_column(rows.schema.get_field_index(name), name, values)
            yield from rows.combine_chunks().to_batches()

    return run


def _levels(leaves: DataFrame, block: int) -> list[DataFrame]:
    """Placed nodes: the leaves, the roots of their blocks, the roots of blocks of those, ..."""
    levels = [leaves]
    own = F.shiftright("place", block).alias("block")
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        nodes = levels[-1].where("n > 1").select("grp", own, "place", "n", "digest")
        schema = "grp string, digest string, n long, place long"
        levels.append(materialize(_blocked(nodes).mapInArrow(_roots(block), schema), "merkle-level"))
    return levels


def _subroots(levels: Sequence[DataFrame]) -> DataFrame:
    alone = [level.where("n = 1").select("grp", "digest") for level in levels]
    subroots = alone[0]
    for some in alone[1:]:
        subroots = subroots.unionByName(some)
    return subroots


def _witnessed(levels: Sequence[DataFrame], outer: DataFrame, block: int) -> DataFrame:
    """The leaves with ``witness`` and ``subroot``.

    ``outer`` has the witness of each group's subroot in the tree of subroots.
    """
    outer = outer.withColumnRenamed("grp", "outer_grp")
    found = None
    for height in reversed(range(len(levels))):
        level = levels[height]
        tops = level.where("n = 1").join(outer, F.col("grp").eqNullSafe(F.col("outer_grp")))
        done = tops.drop("outer_grp").withColumn("subroot", F.col("digest"))
        if found is not None:
            nodes = (
                level.where("n > 1")
                .withColumn("block", F.shiftright("place", block))
                .withColumn("witness", F.lit(None).cast(_WITNESS))
                .withColumn("subroot", F.lit(None).cast("string"))
            )
            marks = found.select(
                "grp", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"),
                "witness", "subroot",
            )
            rows = _blocked(nodes.unionByName(marks, allowMissingColumns=True))
            made = rows.mapInArrow(_extended(block), rows.schema).drop("block")
            done = made.unionByName(done)
        found = materialize(done, "merkle-witness") if height else done
    return found


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``leaf, witness, subroot, root``, the group and the order value, for every row.

    ``carry`` are further columns, computed where the row is read.
    """
    leaves = docs.select(
        F.col(group).cast("string").alias("grp"),
        F.col(order).alias("by"),
        leaf(*fields).alias("digest"),
        *[value.alias(f"carried_{name}") for name, value in (carry or {}).items()],
    )
    levels = _levels(_placed(leaves, "by", "digest"), block)
    tops = _subroots(levels).select(F.lit("").alias("grp"), F.col("grp").alias("own"), "digest")
    upper = _levels(_placed(tops, "own"), block)
    last = _subroots(upper).first()  # one row, or none of an empty table
    alone = T.StructType().add("grp", "string").add("witness", _WITNESS)
    none = docs.sparkSession.createDataFrame([("", [])], alone)
    outer = _witnessed(upper, none, block).select(F.col("own").alias("grp"), "witness")
    return _witnessed(levels, materialize(outer, "merkle-outer"), block).select(
        F.col("by").alias(order),
        F.col("grp").alias(group),
        F.col("digest").alias("leaf"),
        "witness",
        "subroot",
        F.lit(last["digest"] if last else None).cast("string").alias("root"),
        *[F.col(f"carried_{name}").alias(name) for name in carry or {}],
    )
