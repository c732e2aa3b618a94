"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes when a string of ``length`` bytes covering it also starts earlier. The
work is a suffix sort cut to what can repeat:

1. Every window of ``length`` bytes is named by the least hash among its 32-byte
   grams. Equal windows have equal names, so a name seen once drops its windows,
   and neighbouring windows of one name travel together as one segment.
2. Segments meet by name. Whole names form blocks of bounded size. In a block,
   ranks of a difference-cover sample are computed by doubling, then one suffix
   bucket after another is sorted by its first bytes, and ties longer than that
   are resolved by the ranks at the offset at which both suffixes meet the sample.
3. Neighbours in that order which agree on ``length`` bytes are one class; all but
   its earliest member are repeats.

A name with more than ``SALTED`` segments (a passage that many documents share) is
salted: each part is sorted as above, and the earliest members of its classes meet
again by the window itself, so no task holds more than one salt's share.

Defined cases: a null text counts as empty; texts shorter than ``length`` stay
whole; an empty table gives an empty result; a row without an id starts before all
others; rows repeating an id and text are one document, searched once and reported
for each row; rows repeating an id with other texts are ordered by a hash of the
text. Texts of any length are searched whole. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import body, discard, materialize, one_of_each

#: Bytes of the grams that name a window.
GRAM = 32
#: Bytes hashed at a time; longer texts are cut into overlapping pieces.
PIECE = 1 << 18
#: Text bytes of one block, about.
BLOCK = 1 << 22
#: Suffixes of one bucket, about.
BUCKET = 1 << 18
#: Segments of one name that are sorted together.
SALTED = 20_000
#: Period of the cover, and residues of which some pair has any given difference.
PERIOD = 16
COVER = (0, 1, 2, 5, 8)
#: Sample ranks order suffixes by so many bytes at least.
DEPTH = 128


def _byte_names() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


_NAMES = _byte_names()
_MIX = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    hashes = _NAMES[data]
    width = 1
    while width < GRAM:
        hashes = hashes[:-width] * _MIX + hashes[width:]
        hashes ^= hashes >> np.uint64(29)
        width *= 2
    return hashes


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :])


def segments(pieces: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """``piece, name, at, n, times``: runs of ``n`` windows of one name from ``at`` in a piece.

    ``times`` is 2 where windows inside the run may repeat each other, else 1.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    width = length - GRAM + 1
    hashes = gram_hashes(data)
    names = _sliding_min(hashes, width)
    cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
    cuts = np.unique(np.concatenate((cuts, begins, np.maximum(ends - length + 1, begins))))
    cuts = cuts[cuts < len(names)]
    after = np.append(cuts[1:], len(names))
    # If two windows of a run are equal, the naming gram leaves the run's windows
    # before the run ends: another copy of that gram goes on naming them.
    left = np.flatnonzero(hashes[: len(names)] == names)
    run = np.searchsorted(cuts, left, side="right") - 1
    again = np.zeros(len(cuts), np.int64)
    again[run[left + 1 < after[run]]] = 1
    # Long runs, as of a repeated letter, are cut to what a gram can name.
    parts = -(-(after - cuts) // width)
    at = np.repeat(cuts, parts)
    times = 1 + np.repeat(again, parts)
    step = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
    at = at + step * width
    n = np.minimum(np.repeat(after, parts) - at, width)
    piece = np.searchsorted(begins, at, side="right") - 1
    inside = at + length <= ends[piece]
    at, n, piece = at[inside], n[inside], piece[inside]
    return piece, names[at].view(np.int64), at - begins[piece], n, times[inside]


_ROWS = pa.schema([(c, pa.int64()) for c in ("name", "doc_key", "run", "times")])


def _namer(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int, int, bytes]] = []
            size = 0
            for key, text in zip(batch.column("doc_key").to_pylist(), batch.column("body")):
                data = text.as_buffer().to_pybytes()
                for base in range(0, max(1, len(data) - length + 1), PIECE):
                    piece = data[base : base + PIECE + length - 1]
                    if len(piece) >= length:
                        held.append((key, base, piece))
                        size += len(piece)
                    if size >= PIECE:
                        yield named(held)
                        held, size = [], 0
            if held:
                yield named(held)

    def named(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        keys, bases, pieces = zip(*held)
        piece, name, at, n, times = segments(list(pieces), length)
        run_of = (at + np.array(bases, np.int64)[piece]) * 128 + n
        columns = [name, np.array(keys, np.int64)[piece], run_of, times]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_ROWS)

    return run


_SEGMENTS = pa.schema(
    [
        ("bucket", pa.int64()),
        ("salted", pa.bool_()),
        ("doc_id", pa.int64()),
        ("doc_key", pa.int64()),
        ("at", pa.int64()),
        ("piece", pa.binary()),
    ]
)


def _cutter(length: int):
    """Cuts the segments of documents out of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            columns = [batch.column(c) for c in ("doc_id", "doc_key", "body", "runs")]
            for doc_id, key, text, runs in zip(*columns):
                data, doc_id, key = text.as_buffer().to_pybytes(), doc_id.as_py(), key.as_py()
                for one in runs.as_py():
                    at, n = divmod(one["run"], 128)
                    piece = data[at : at + n + length - 1]
                    rows.append((one["bucket"], one["salted"], doc_id, key, at, piece))
                    size += len(piece)
                    if size >= BLOCK:
                        yield _batch(rows, _SEGMENTS)
                        rows, size = [], 0
            if rows:
                yield _batch(rows, _SEGMENTS)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class Block:
    """Suffixes of a few texts, sorted far enough to tell windows of ``length`` bytes apart.

    Texts of different ``names`` have no window in common and are kept apart.
    """

    def __init__(self, texts: list[bytes], anchors: np.ndarray, names: np.ndarray, length: int):
        self.length = length
        self.names = names
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        # Texts are padded so that their anchors share a residue: suffixes that
        # agree on many bytes then mostly meet the sample at the same offset.
        pads, place = [], 0
        self.begins = np.empty(len(texts), np.int64)
        for i, (size, anchor) in enumerate(zip(sizes.tolist(), anchors.tolist())):
            pad = -(place + anchor) % PERIOD
            place += pad
            self.begins[i] = place
            place += size
            pads.append(pad)
        joined = bytearray()
        for pad, text in zip(pads, texts):
            joined += b"\xff" * pad
            joined += text
        joined += b"\xff" * (DEPTH + 2 * PERIOD + length)
        data = np.frombuffer(bytes(joined), np.uint8)
        words = data
        for width, kind in ((1, np.uint16), (2, np.uint32), (4, np.uint64)):
            words = words[:-width].astype(kind) << kind(8 * width) | words[width:]
        self.words = words
        counts = np.maximum(sizes - length + 1, 0)
        self.text_of = np.repeat(np.arange(len(texts)), counts)
        within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        self.starts = self.begins[self.text_of] + within
        self.ranks = self._sample_ranks(place + length)
        self.offsets = _common_offsets()

    def _sample_ranks(self, size: int) -> np.ndarray:
        """The rank of every sampled suffix among them, by ``DEPTH`` bytes; others 0."""
        residues = np.arange(0, size, PERIOD)[:, None] + np.array(COVER)
        sample = residues.ravel()
        sample = sample[sample < len(self.words) - DEPTH - PERIOD]
        order = np.lexsort((self.words[sample + 8], self.words[sample]))
        first, second = self.words[sample[order]], self.words[sample[order] + 8]
        new = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        ranks = np.zeros(len(self.words) + DEPTH, np.int64)
        ranks[sample[order]] = np.concatenate(([1], np.cumsum(new) + 1))
        depth = PERIOD
        while depth < DEPTH:
            pair = ranks[sample] << np.int64(32) | ranks[sample + depth]
            order = np.argsort(pair)
            pair = pair[order]
            ranks[sample[order]] = np.concatenate(([1], np.cumsum(pair[1:] != pair[:-1]) + 1))
            depth *= 2
        return ranks

    def classes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For one suffix bucket after another: windows (their numbers) and class borders.

        A border marks a window that differs from the one before it.
        """
        leading = self.words[self.starts]
        buckets = -(-len(leading) // BUCKET)
        if buckets <= 1:
            yield self._sorted(np.arange(len(leading)))
            return
        some = np.sort(leading[:: max(1, len(leading) // (buckets * 64))])
        splitters = np.unique(some[:: max(1, len(some) // buckets)][1:])
        bucket = np.searchsorted(splitters, leading, side="right")
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(len(splitters) + 2))
        for begin, end in zip(cuts[:-1], cuts[1:]):
            if end > begin:
                yield self._sorted(order[begin:end])

    def _sorted(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.starts[windows]
        name = self.names[self.text_of[windows]]
        order = np.lexsort((self.words[at + 8], self.words[at], name))
        windows, at, name = windows[order], at[order], name[order]
        first, second = self.words[at], self.words[at + 8]
        new = np.ones(len(at), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (name[1:] != name[:-1])
        # Ties of different residues take longer to resolve: most of them part
        # within some more bytes.
        for offset in range(16, min(64, self.length - 7), 8):
            heads = np.flatnonzero(new)
            residue = at % PERIOD
            mixed = np.minimum.reduceat(residue, heads) != np.maximum.reduceat(residue, heads)
            tie = np.cumsum(new) - 1
            some = np.flatnonzero(mixed[tie])
            if not len(some):
                break
            word = self.words[at[some] + offset]
            order = np.lexsort((word, tie[some]))
            word = word[order]
            windows[some], at[some] = windows[some[order]], at[some[order]]
            new[some[1:][word[1:] != word[:-1]]] = True
        tie = np.cumsum(new)
        residue = at % PERIOD
        own = self.ranks[at + self.offsets[residue, residue]]
        order = np.argsort(tie << np.int64(32) | own)
        windows, at, residue = windows[order], at[order], residue[order]
        heads = np.flatnonzero(new)
        mixed = np.minimum.reduceat(residue, heads) != np.maximum.reduceat(residue, heads)
        some = np.flatnonzero(mixed[tie - 1])
        if len(some):
            order = some[self._merged(at[some], residue[some], tie[some])]
            windows[some], at[some] = windows[order], at[order]
        same = ~new
        pairs = np.flatnonzero(same)
        for offset in (*range(16, self.length - 7, 8), self.length - 8):
            pairs = pairs[self.words[at[pairs] + offset] == self.words[at[pairs - 1] + offset]]
        border = np.ones(len(at), bool)
        border[pairs] = False
        return windows, border

    def _merged(self, at: np.ndarray, residue: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """The order of suffixes in ties whose members have different residues.

        A suffix's place in its tie is the number of smaller ones, counted for one
        residue after another at the offset that takes both into the sample.
        """
        smaller = np.zeros(len(at), np.int64)
        groups = {r: np.flatnonzero(residue == r) for r in np.unique(residue).tolist()}
        tie = tie << np.int64(32)
        for r, mine in groups.items():
            for q, theirs in groups.items():
                offset = self.offsets[r, q]
                known = np.sort(tie[theirs] | self.ranks[at[theirs] + offset])
                below = np.searchsorted(known, tie[mine] | self.ranks[at[mine] + offset])
                smaller[mine] += below - np.searchsorted(known, tie[mine])
        return np.lexsort((smaller, tie))


def _common_offsets() -> np.ndarray:
    """For two residues, the least offset that takes both into the cover."""
    cover = set(COVER)
    return np.array(
        [
            [
                next(d for d in range(PERIOD) if {(a + d) % PERIOD, (b + d) % PERIOD} <= cover)
                for b in range(PERIOD)
            ]
            for a in range(PERIOD)
        ]
    )


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("doc_key", pa.int64()),
        ("at", pa.int64()),
        ("n", pa.int64()),
        ("window", pa.binary()),
    ]
)


def repeated_windows(
    keys: list[tuple], texts: list[bytes], names: list[int], length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, Block | None, np.ndarray]:
    """Runs of windows that also start earlier, as ``text, offset, n``.

    ``keys`` are the places of the texts, in an order that tells earlier from
    later; only texts of one name are compared. Texts at the same place are the
    same text. Also returns the block and
    the windows in it that stay, by text number.
    """
    order = sorted(range(len(texts)), key=lambda i: (names[i], keys[i]))
    seen: dict[tuple[int, bytes], int] = {}
    whole: list[int] = []
    last = None
    for i in order:
        if (names[i], keys[i]) == last:
            continue
        last = names[i], keys[i]
        if seen.setdefault((names[i], texts[i]), i) != i:
            whole.append(i)
    distinct = list(seen.values())  # of each name the earliest first
    counts = np.array([len(texts[i]) - length + 1 for i in whole], np.int64)
    runs = [(np.array(whole, np.int64), np.zeros(len(whole), np.int64), counts)]
    some = [texts[i] for i in distinct]
    block = Block(some, _anchors(some), np.array([names[i] for i in distinct]), length)
    stays = np.ones(len(block.starts), bool)
    for windows, border in block.classes():
        heads = np.flatnonzero(border)
        # Numbers grow with the place, so the least of a class is the earliest.
        earliest = np.minimum.reduceat(windows, heads)
        stays[windows] = windows == np.repeat(earliest, np.diff(np.append(heads, len(windows))))
    gone = np.flatnonzero(~stays)
    if len(gone):
        text = block.text_of[gone]
        cut = np.ones(len(gone), bool)
        cut[1:] = (np.diff(gone) != 1) | (text[1:] != text[:-1])
        heads = np.flatnonzero(cut)
        offset = block.starts[gone[heads]] - block.begins[text[heads]]
        runs.append(
            (np.array(distinct, np.int64)[text[heads]], offset, np.diff(np.append(heads, len(gone))))
        )
    text, offset, n = (np.concatenate(x) for x in zip(*runs))
    return text, offset, n, block, np.array(distinct, np.int64)[block.text_of[stays]] * (1 << 32) + (
        block.starts[stays] - block.begins[block.text_of[stays]]
    )


def _anchors(texts: list[bytes]) -> np.ndarray:
    """In each text, the place of its least gram hash: the same bytes in texts of one name."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    hashes = gram_hashes(np.frombuffer(b"".join(texts) + b"\xff" * GRAM, np.uint8))
    begins = ends - sizes
    position = np.arange(ends[-1])
    # Grams that reach into the next text do not count.
    hashes = hashes[: ends[-1]].copy()
    hashes[position > np.repeat(ends, sizes) - GRAM] = np.iinfo(np.uint64).max
    least = np.minimum.reduceat(hashes, begins)
    at = np.flatnonzero(hashes == np.repeat(least, sizes))
    text = np.searchsorted(begins, at, side="right") - 1
    return at[np.searchsorted(text, np.arange(len(texts)))] - begins


def _sorter(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        bucket = None
        for batch in batches:
            for row in zip(*(batch.column(f.name).to_pylist() for f in _SEGMENTS)):
                if size >= BLOCK and row[0] != bucket:
                    yield from found(rows)
                    rows, size = [], 0
                bucket = row[0]
                rows.append(row)
                size += len(row[-1])
        if rows:
            yield from found(rows)

    def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys = [(row[2] is not None, row[2] or 0, row[3], row[4]) for row in rows]
        texts, names = [row[5] for row in rows], [row[0] for row in rows]
        text, offset, n, _, kept = repeated_windows(keys, texts, names, length)
        out = [
            (rows[i][2], rows[i][3], rows[i][4] + o, k, None)
            for i, o, k in zip(text.tolist(), offset.tolist(), n.tolist())
        ]
        for one in kept[np.array([row[1] for row in rows])[kept >> 32]].tolist():
            row, o = rows[one >> 32], one & 0xFFFFFFFF
            out.append((row[2], row[3], row[4] + o, 1, row[5][o : o + length]))
            if len(out) >= 50_000:
                yield _batch(out, _FOUND)
                out = []
        if out:
            yield _batch(out, _FOUND)

    return run


def _sort_buckets(pieces: DataFrame, length: int) -> DataFrame:
    schema = "doc_id long, doc_key long, at long, n long, window binary"
    ordered = pieces.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(_sorter(length), schema)


def repeats(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, doc_key, at, n``: runs of ``n`` windows that also start earlier."""
    rows = docs.select("doc_key", "body").where(F.octet_length("body") >= length)
    named = materialize(
        rows.mapInArrow(_namer(length), "name long, doc_key long, run long, times long"), "suffix-names"
    )
    shared = named.groupBy("name").agg(F.sum("times").alias("times"))
    # Stored, so that the join below can be split where a name is very frequent.
    shared = materialize(shared.where("times > 1"), "suffix-shared")
    salts = F.ceil(F.col("times") / SALTED)
    salt = F.pmod(F.xxhash64("doc_key", "run"), salts)
    runs = (
        named.drop("times").join(shared.hint("shuffle_hash"), "name")
        .select(
            "doc_key",
            F.struct(
                "run",
                F.xxhash64("name", salt).alias("bucket"),
                (F.col("times") > SALTED).alias("salted"),
            ).alias("one"),
        )
        .groupBy("doc_key")
        .agg(F.collect_list("one").alias("runs"))
    )
    runs = materialize(runs, "suffix-runs")
    discard(named, shared)
    schema = "bucket long, salted boolean, doc_id long, doc_key long, at long, piece binary"
    pieces = docs.join(runs, "doc_key").select("doc_id", "doc_key", "body", "runs")
    found = materialize(_sort_buckets(pieces.mapInArrow(_cutter(length), schema), length), "suffix-found")
    discard(runs)
    again = found.where("window is not null").select(
        F.xxhash64("window").alias("bucket"),
        F.lit(False).alias("salted"),
        "doc_id",
        "doc_key",
        "at",
        F.col("window").alias("piece"),
    )
    columns = ["doc_id", "doc_key", "at", "n"]
    return found.where("window is null").select(columns).union(
        _sort_buckets(again, length).select(columns)
    )


_KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


def merged_spans(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """Byte ranges that runs of windows cover, joined where they touch."""
    spans: list[list[int]] = []
    for begin, end in sorted((r["at"], r["at"] + r["n"] - 1 + length) for r in runs):
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([begin, end])
    return [(b, e) for b, e in spans]


def _remover(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            columns = [batch.column(c) for c in ("doc_id", "body", "runs")]
            for doc_id, text, runs in zip(*columns):
                data = text.as_buffer().to_pybytes()
                spans = merged_spans(runs.as_py() or [], length)
                parts, place = [], 0
                for begin, end in spans:
                    parts.append(data[place:begin])
                    place = end
                parts.append(data[place:])
                made = [{"begin": b, "end": e} for b, e in spans]
                rows.append((doc_id.as_py(), len(data), made, b"".join(parts)))
                size += len(data)
                if size >= BLOCK:
                    yield _batch(rows, _KEPT)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _KEPT)

    return run


def without_repeats(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: removed byte ranges and the bytes left of each text."""
    if length < GRAM + 1 or length - GRAM + 1 > 127:
        raise ValueError(f"length must be from {GRAM + 1} to {GRAM + 126}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), body(text_col).alias("body"))
    rows = rows.withColumn("doc_key", F.xxhash64("doc_id", "body"))
    found = repeats(one_of_each(rows, "doc_id", "doc_key"), length)
    runs = found.groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    left, right = rows.alias("d"), runs.alias("r")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.doc_key") == F.col("r.doc_key"))
    joined = left.join(right, same, "left").select("d.doc_id", "d.body", "r.runs")
    schema = "doc_id long, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary"
    return joined.mapInArrow(_remover(length), schema)
