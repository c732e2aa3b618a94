"""Removal of repeated passages by content-defined chunks.

A gear hash rolls over the last 32 bytes of a text, and a chunk ends where its top
bits are zero, moved on to the end of a character. Since a boundary depends on the
bytes just before it only, an insertion changes the chunks around it and no
others. Chunks are compared by a 128-bit digest of their bytes; the earliest
occurrence of each stays. The last chunk of a text may be shorter than the others; with
``lone_tails=False`` such a tail goes only together with the chunk before it, where an
earlier text ends in the same two.

Defined cases: a null text counts as empty, an empty text has no chunks; an empty
table gives an empty result; a row without an id comes before all others; rows
repeating an id and text are one document, searched once and reported for each row;
rows repeating an id with other texts are ordered by a hash of the text. Texts of any
length are cut whole, by one task each. Other columns are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import body, discard, materialize, one_of_each

#: Fewest bytes of a chunk, but for the last of a text; also what the hash looks at.
LEAST = 32
#: Bits that are zero at a boundary: chunks are about ``LEAST`` + 2**ZEROS bytes long.
ZEROS = 4
#: A chunk without a boundary ends here.
MOST = 1024
#: Bytes hashed at a time.
PIECE = 1 << 18


def _gear() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, over the 32 bytes that end there."""
    hashes = _GEAR[data]
    width = 1
    while width < 32:
        older = hashes[:-width] << np.uint32(width)
        hashes = hashes.copy()
        hashes[width:] += older
        width *= 2
    return hashes


def boundaries(data: bytes) -> np.ndarray:
    """Ends of candidate chunks: where the hash says so, moved to the end of a character."""
    found = []
    for base in range(0, len(data), PIECE):
        begin = max(0, base - LEAST + 1)
        hashes = gear_hashes(np.frombuffer(data[begin : base + PIECE], np.uint8))[base - begin :]
        found.append(np.flatnonzero(hashes >> np.uint32(32 - ZEROS) == 0) + base + 1)
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    padded = np.frombuffer(data + b"    ", np.uint8)
    for _ in range(3):
        ends = ends + (padded[ends] & 0xC0 == 0x80)
    return ends


def cuts(data: bytes) -> list[int]:
    """The end of every chunk of a text."""
    out, last, size = [], 0, len(data)

    def forced(until: int) -> int:
        nonlocal last
        while until - last > MOST:
            last += MOST
            # A last character of several bytes may reach to the end of the text.
            while last < size and data[last] & 0xC0 == 0x80:
                last += 1
            out.append(last)
        return last

    for end in boundaries(data).tolist():
        if end - forced(end) >= LEAST:
            out.append(end)
            last = end
    forced(size)
    if last < size:
        out.append(size)
    return out


_CHUNKS = pa.schema([(c, pa.int64()) for c in ("high", "low", "doc_id", "doc_key", "run")])


def _chunker(lone_tails: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            digests: list[bytes] = []
            docs: list[tuple] = []
            runs: list[np.ndarray] = []

            def flush():
                parts = np.frombuffer(b"".join(digests), ">i8").astype(np.int64)
                sizes = [len(r) for r in runs]
                ids = pa.array([d[0] for d in docs], pa.int64())
                which = pa.array(np.repeat(np.arange(len(docs)), sizes))
                keys = np.repeat(np.array([d[1] for d in docs], np.int64), sizes)
                columns = [parts[::2], parts[1::2], ids.take(which), keys, np.concatenate(runs)]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_CHUNKS)

            for doc_id, key, text in zip(*(batch.column(c) for c in ("doc_id", "doc_key", "body"))):
                data = text.as_buffer().to_pybytes()
                ends = cuts(data)
                if not ends:
                    continue
                begins = [0, *ends[:-1]]
                named = list(begins)
                if not lone_tails and len(ends) > 1 and ends[-1] - begins[-1] < LEAST:
                    # A short tail is compared with the chunk before it in front.
                    named[-1] = begins[-2]
                digests.extend(digest(data[b:e]) for b, e in zip(named, ends))
                at = np.array(begins, np.int64)
                runs.append(at * (2 * MOST) + (np.array(ends, np.int64) - at))
                docs.append((doc_id.as_py(), key.as_py()))
                if len(digests) >= 100_000:
                    yield flush()
                    digests, docs, runs = [], [], []
            if digests:
                yield flush()

    return run


def repeats(rows: DataFrame, lone_tails: bool = True) -> DataFrame:
    """``doc_id, doc_key, run, first_id``: chunks that also occur earlier, and where first."""
    schema = "high long, low long, doc_id long, doc_key long, run long"
    chunks = materialize(rows.mapInArrow(_chunker(lone_tails), schema), "chunks")
    name = ["high", "low"]
    shared = chunks.groupBy(*name).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    # Stored, so that the joins can be split where a chunk is very frequent.
    shared = materialize(shared.drop("times"), "chunks-repeated")
    met = materialize(chunks.join(shared.hint("shuffle_hash"), name), "chunks-shared")
    discard(chunks, shared)
    place = F.struct(
        F.col("doc_id").isNotNull().alias("named"), "doc_id", "doc_key", "run"
    )
    first = materialize(met.groupBy(*name).agg(F.min(place).alias("first")), "chunks-first")
    # Rows repeating an id and text are one document: the same place is no repeat.
    later = met.join(first, name).where(place > F.col("first"))
    return later.select("doc_id", "doc_key", "run", F.col("first.doc_id").alias("first_id"))


_KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_chunks", pa.int64()),
        ("n_repeated", pa.int64()),
        ("n_removed", pa.int64()),
        ("first_ids", pa.list_(pa.int64())),
        ("kept", pa.string()),
    ]
)


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for doc_id, text, runs in zip(*(batch.column(c) for c in ("doc_id", "body", "runs"))):
            data = text.as_buffer().to_pybytes()
            found = runs.as_py() or []
            gone = sorted({divmod(r["run"], 2 * MOST) for r in found})
            parts, place = [], 0
            for begin, length in gone:
                parts.append(data[place:begin])
                place = begin + length
            parts.append(data[place:])
            kept = b"".join(parts)
            ids = sorted({r["first_id"] for r in found if r["first_id"] is not None})
            n = len(cuts(data))
            rows.append(
                (doc_id.as_py(), len(data), n, len(gone), len(data) - len(kept), ids, kept.decode())
            )
            size += len(data)
            if size >= 1 << 22:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _KEPT)]
    return pa.RecordBatch.from_arrays(columns, schema=_KEPT)


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lone_tails: bool = True
) -> DataFrame:
    """Each text without the chunks that occur earlier, and the documents that had them first."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), body(text_col).alias("body"))
    rows = rows.withColumn("doc_key", F.xxhash64("doc_id", "body"))
    later = repeats(one_of_each(rows, "doc_id", "doc_key"), lone_tails)
    runs = later.groupBy("doc_id", "doc_key").agg(
        F.collect_list(F.struct("run", "first_id")).alias("runs")
    )
    left, right = rows.alias("d"), runs.alias("r")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.doc_key") == F.col("r.doc_key"))
    joined = left.join(right, same, "left").select("d.doc_id", "d.body", "r.runs")
    schema = (
        "doc_id long, n_bytes long, n_chunks long, n_repeated long, n_removed long, "
        "first_ids array<long>, kept string"
    )
    return joined.mapInArrow(_remover, schema)
