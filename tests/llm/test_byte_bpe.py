import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken

from sensorlake.llm import byte_bpe
from sensorlake.llm.queries import token_digests, tokenizer


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def codec(library):
    return byte_bpe.Codec(byte_bpe.serialized_model(library._mergeable_ranks), public_tokenizers.PATTERN)


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        out.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def digests(spark, docs):
    return sorted(map(tuple, token_digests(docs, tokenizer(spark)).collect()), key=repr)


def test_documents_match_the_library(spark, documents, library):
    rows = documents.select("doc_id", "text").collect()
    assert digests(spark, documents) == expected(library, rows)


def test_edges(spark, edge_docs, no_docs, library):
    rows = edge_docs.select("doc_id", "text").collect()
    assert digests(spark, edge_docs) == expected(library, rows)
    assert digests(spark, no_docs) == []


def test_both_at_once_equal_one_after_the_other(spark, edge_docs):
    bpe = tokenizer(spark)
    docs = edge_docs.selectExpr("*", "'x' AS coded", "'y' AS doc")
    apart = byte_bpe.decode(byte_bpe.encode(docs, bpe), bpe)
    both = byte_bpe.encode_and_decode(docs, bpe)
    assert set(both.columns) == set(apart.columns)
    both = both.select(apart.columns)
    assert sorted(map(repr, both.collect())) == sorted(map(repr, apart.collect()))


def test_every_character_and_every_token(library, codec):
    """Each code point between letters, and each token that is text, as the library does."""
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c} {c}b  {c}{c}1" for c in points]
    texts += [t.decode() for t in library._mergeable_ranks if regex.fullmatch(rb"[ -~]+", t)]
    got = codec.encode(texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(ids).decode() for ids in got] == texts


def test_vocabulary_with_gaps_is_refused():
    with pytest.raises(ValueError):
        byte_bpe.serialized_model({b"a": 0, b"b": 2})
