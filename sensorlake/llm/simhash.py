"""Near-duplicates by SimHash fingerprints that differ in few bits.

A fingerprint of 64 bits is cut into blocks, two more than the bits that may
differ, so two linked fingerprints agree on at least two whole blocks. Distinct
fingerprints meet on every pair of blocks; inside such a bucket the Hamming
distance of all members is verified, and only a spanning forest of the links
leaves the task. A bucket beyond ``TILE`` members is cut into tiles, and each pair
of tiles is a task's unit of its own. Copies are one fingerprint, so they never
meet as pairs.

Defined cases: a null text counts as empty; a text without words has fingerprint
zero and is linked like any other; one with fewer words than a shingle has its
whole sequence as the only shingle; an empty table gives an empty result; repeated
rows share a component; rows without an id get the least id of their component,
or null if it has none. Texts of any length are hashed whole, by one task each. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import body, materialize
from sensorlake.llm.components import components
from sensorlake.llm.exact_dedup import rows_of

BITS = 64
#: Members of a bucket that one unit of work compares with each other, about.
TILE = 1024
HASH_SEED = 42
#: Shingle hashes whose bits are counted at a time.
COUNTED = 65_536


def fingerprint(text: str, words: int) -> int:
    """The SimHash of one text over shingles of ``words`` words, as an unsigned number."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(begins[:last].tolist(), ends[min(words, len(tokens)) - 1 :].tolist())
    hashes = np.fromiter((digest(joined[b:e], HASH_SEED) for b, e in spans), np.uint64, last)
    counts = np.zeros(BITS, np.int64)
    for begin in range(0, last, COUNTED):
        part = hashes[begin : begin + COUNTED].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > last).tobytes(), "big")


def fingerprints(
    docs: DataFrame,
    words: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    others: Sequence[str] = (),
) -> DataFrame:
    """``doc_id`` and ``bits``, the fingerprint as a signed long; also ``others``."""

    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        made = (fingerprint(text.as_py(), words) for text in texts)
        return pa.array(np.fromiter(made, np.uint64, len(texts)).view(np.int64))

    return docs.select(F.col(id_col).alias("doc_id"), simhash(body(text_col)).alias("bits"), *others)


def _block_masks(max_bits: int) -> list[int]:
    """A mask for every pair of blocks, as signed longs."""
    edges = np.linspace(0, BITS, max_bits + 3).round().astype(int).tolist()
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges[:-1], edges[1:])]
    return [_signed(a | b) for a, b in combinations(blocks, 2)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _forest(bits: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint with a smaller one in its component here: it and the smallest."""
    plain = bits.view(np.uint64)  # of signed numbers, bits of the absolute value are counted
    left = np.arange(len(bits))
    members, roots = [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for start in range(0, len(front), TILE):
                some = plain[front[start : start + TILE], None] ^ plain[None, left]
                near |= (np.bitwise_count(some) <= max_bits).any(axis=0)
            front, left = left[near], left[~near]
            members.append(front)
            roots.append(np.full(len(front), root))
    if not members:
        return bits[:0], bits[:0]
    return bits[np.concatenate(members)], bits[np.concatenate(roots)]


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _linker(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def close():
            if held:
                bits = np.unique(np.concatenate(held))
                if len(bits) > 1:
                    out.append(_forest(bits, max_bits))

        def flush():
            u, v = (np.concatenate(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=_EDGES)

        for batch in batches:
            unit = batch.column("unit").to_numpy()
            bits = batch.column("bits").to_numpy()
            cuts = np.flatnonzero(np.diff(unit)) + 1
            starts = np.concatenate(([0], cuts)) if len(unit) else []
            for begin, end in zip(starts, np.append(cuts, len(unit))):
                if key is None or unit[begin] != key:
                    close()
                    key, held = unit[begin], []
                held.append(bits[begin:end])
            if out:
                yield flush()
                out = []
        close()
        if out:
            yield flush()

    return run


def links(bits: DataFrame, max_bits: int) -> DataFrame:
    """``u, v``: edges that connect the distinct fingerprints ``bits`` within ``max_bits``."""
    masks = F.array(*[F.lit(m) for m in _block_masks(max_bits)])
    keyed = bits.select("bits", F.posexplode(masks).alias("cut", "mask")).select(
        "bits", F.xxhash64("cut", F.col("bits").bitwiseAND(F.col("mask"))).alias("bucket")
    )
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("bits", F.lit("tile")), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    units = (
        keyed.join(sizes, "bucket")
        .withColumn("tiles", tiles)
        .withColumn("own", own)
        .withColumn("other", other)
        .select(
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
            "bits",
        )
    )
    return (
        units.repartition("unit")
        .sortWithinPartitions("unit")
        .mapInArrow(_linker(max_bits), "u long, v long")
    )


def _components(marked: DataFrame, max_bits: int) -> DataFrame:
    """``bits, root, component_id`` of each fingerprint in ``marked``.

    ``root`` names the component by a fingerprint, ``component_id`` by its least id,
    which is null where no row has one.
    """
    distinct = materialize(
        marked.groupBy("bits").agg(F.min("doc_id").alias("least_id")), "simhash-distinct"
    )
    grouped = components(links(distinct.select("bits"), max_bits))
    rooted = distinct.join(
        grouped.withColumnRenamed("node", "bits"), "bits", "left"
    ).withColumn("root", F.coalesce("root", "bits"))
    # Stored before it is joined back, so that a very large component can be split.
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    least = materialize(least, "simhash-least")
    return rooted.join(least, "root").select("bits", "root", "component_id")


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    max_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Fingerprints differing in at most ``max_bits`` bits are linked; a component is
    named by its smallest id.
    """
    marked = materialize(fingerprints(docs, words, id_col, text_col), "simhash")
    named = _components(marked, max_bits).select("bits", "component_id")
    hexed = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return marked.join(named, "bits").select("doc_id", hexed, "component_id")


def without_near_copies(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each component, with its columns.

    It is a row with the component's least id; of several, that with the least SHA-256
    of the text, and of rows that repeat both, the least by all columns.
    """
    keyed = docs.select("doc_id", "text", F.sha2(body("text"), 256).alias("key"))
    marked = materialize(fingerprints(keyed, words, others=["key"]), "simhash")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    found = marked.join(_components(marked, max_bits), "bits").where(own)
    counted = found.groupBy("root", "doc_id", "key").agg(F.count(F.lit(1)).alias("times"))
    kept = counted.groupBy("root").agg(F.min(F.struct("key", "doc_id", "times")).alias("kept"))
    return rows_of(docs, materialize(kept.select("kept.*"), "simhash-kept"))
