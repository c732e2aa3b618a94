"""Byte-level BPE through a sentencepiece model made from the vocabulary itself.

Every token's bytes are written as one letter per byte and become a piece scored
by its negative rank, with identity normalisation; no training is involved. The
merge order by score is then the merge order by rank. Pre-tokens are encoded one
by one, each distinct one once per task; decoding maps pieces back to bytes.

The model is a constant of the vocabulary file (a few MB) and is broadcast.

Defined cases: a null text counts as empty; an empty text has no ids and decodes
to no bytes; an empty table gives an empty result; repeated rows give equal rows;
texts of any length are encoded whole. A pre-token without a break of any kind is
one unit for the model, as its merges may span all of it. Columns of ``docs`` of the
names of the results are replaced, all others kept.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.common import body

#: Bytes are written as the letters from this code point on; none is a space.
FIRST_LETTER = 0x100
#: Distinct pre-tokens whose ids a task keeps at hand.
CACHED = 150_000

_IDS = T.ArrayType(T.IntegerType(), False)
_CODED = T.StructType([T.StructField("ids", _IDS), T.StructField("decoded", T.BinaryType())])


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_LETTERS)


_LETTERS = {b: chr(FIRST_LETTER + b) for b in range(256)}


def serialized_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    by_rank = sorted(ranks.items(), key=lambda item: item[1])
    if [rank for _, rank in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ... without a gap")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a token: {missing}")
    model = proto.ModelProto()
    for token, rank in by_rank:
        model.pieces.add(piece=letters(token), score=-float(rank))
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(by_rank)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


def _pieces(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def bytes_of_ids(pieces) -> list[bytes]:
    """The letters of each piece back to its bytes; the unknown piece never occurs in ids."""
    spelled = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    spelled[pieces.unk_id()] = ""
    return [bytes(ord(c) - FIRST_LETTER for c in piece) for piece in spelled]


class Codec:
    """Encodes and decodes in one process."""

    def __init__(self, model: bytes, pattern: str):
        import regex

        self.pieces = _pieces(model)
        self.split = regex.compile(pattern).findall
        self.bytes_of = bytes_of_ids(self.pieces)
        # A pre-token that is a token is that token, even where merges would not lead to it.
        self.whole = {token: (i,) for i, token in enumerate(self.bytes_of) if token}
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.split(text) for text in texts]
        if len(self.known) > CACHED:
            self.known = {}
        known = self.known
        new = list({token for tokens in split for token in tokens if token not in known})
        data = [token.encode() for token in new]
        spelled = self.pieces.encode([letters(x) for x in data], out_type=int, num_threads=1)
        for token, x, ids in zip(new, data, spelled):
            known[token] = self.whole.get(x) or tuple(ids)
        get = known.__getitem__
        return [list(chain.from_iterable(map(get, tokens))) for tokens in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=1)
def _codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


@lru_cache(maxsize=1)
def _table(model: bytes) -> list[bytes]:
    """All that decoding needs: a task that decodes holds no model."""
    return bytes_of_ids(_pieces(model))


class ByteBpe:
    """The encoder and decoder as columns.

    ``path`` names a rank file that the driver can read; ``pattern`` splits texts
    into pre-tokens.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        model = spark.sparkContext.broadcast(serialized_model(read_ranks(path)))

        @F.arrow_udf(_IDS)
        def encoded(texts: pa.Array) -> pa.Array:
            codec = _codec(model.value, pattern)
            made = [_ids(codec.encode(part)) for part in _slices(texts)]
            return pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.int32()))

        @F.arrow_udf(T.BinaryType())
        def decoded(ids: pa.Array) -> pa.Array:
            get = _table(model.value).__getitem__
            return pa.array([b"".join(map(get, x)) for x in _lists(ids)], pa.binary())

        @F.arrow_udf(_CODED)
        def coded(texts: pa.Array) -> pa.Array:
            codec = _codec(model.value, pattern)
            made = []
            for part in _slices(texts):
                ids = codec.encode(part)
                back = pa.array(map(codec.decode, ids), pa.binary())
                made.append(pa.StructArray.from_arrays([_ids(ids), back], ["ids", "decoded"]))
            empty = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
            return pa.concat_arrays(made) if made else pa.array([], empty)

        # Marked so that the planner does not run the encoder once for each use of its ids.
        self._encoded, self._decoded = encoded.asNondeterministic(), decoded
        self._coded = coded.asNondeterministic()

    def ids(self, text: str | Column) -> Column:
        """``array<int>``: the ids of a text, null as empty."""
        return self._encoded(body(text))

    def bytes(self, ids: str | Column) -> Column:
        """``binary``: the bytes that ids stand for."""
        return self._decoded(F.col(ids) if isinstance(ids, str) else ids)

    def coded(self, text: str | Column) -> Column:
        """``struct<ids, decoded>``: the ids of a text and the bytes they stand for, from one Python process."""
        return self._coded(body(text))


def _slices(texts: pa.Array, most: int = 500_000):
    """The texts in lists with a bounded number of bytes, or of one text."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    begin = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > most:
            yield texts[begin:row].to_pylist()
            begin, held = row, 0
        held += size
    if begin < len(sizes):
        yield texts[begin:].to_pylist()


def _ids(ids: list[list[int]]) -> pa.ListArray:
    sizes = np.fromiter(map(len, ids), np.int32, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _lists(ids: pa.Array):
    flat = ids.values.to_numpy(zero_copy_only=False)
    offsets = ids.offsets.to_numpy(zero_copy_only=False)
    for begin, end in zip(offsets[:-1], offsets[1:]):
        yield flat[begin:end].tolist()


def encode(
    docs: DataFrame, bpe: ByteBpe, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """``docs`` with the ids of each whole text."""
    return docs.withColumn(ids_col, bpe.ids(text_col))


def decode(docs: DataFrame, bpe: ByteBpe, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that its ids stand for."""
    return docs.withColumn(out, bpe.bytes(ids_col))


def encode_and_decode(
    docs: DataFrame, bpe: ByteBpe, text_col: str = "text", ids_col: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``docs`` with the ids of each whole text and the bytes that these ids stand for.

    One Python process a task does both; ``decode(encode(docs))`` holds two.
    Columns of these two names are replaced, all others kept.
    """
    kept = [c for c in docs.columns if c not in (ids_col, out)]
    rows = docs.select(F.struct(*kept).alias("doc") if kept else F.lit(0).alias("doc"), bpe.coded(text_col).alias("coded"))
    return rows.select(
        *(F.col("doc").getField(c).alias(c) for c in kept),
        F.col("coded.ids").alias(ids_col),
        F.col("coded.decoded").alias(out),
    )
