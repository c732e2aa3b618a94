"""Each stage against a plain version on its own input, and the whole run."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from sensorlake.llm import byte_bpe, exact_dedup, mixing, simhash
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def steps(spark, documents, sf_dir):
    """What each stage took and returned."""
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir).cache()
        out[name] = (docs, made)
        docs = made
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_order_and_columns(steps, documents):
    assert list(steps) == ["toxicity", "exact_dedup", "simhash", "source_mixing", "byte_bpe"]
    for name in list(steps)[:-1]:
        assert steps[name][1].columns == documents.columns


def test_toxic_documents_go_and_clean_ones_stay(spark, steps, sf_dir):
    docs, kept = steps["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = set(ids(kept))
    clean = [i for i in ids(docs) if labels.get(i) == 0]
    assert sum(i in left for i in clean) >= 0.97 * len(clean)


def test_exact_copies(steps):
    docs, kept = steps["exact_dedup"]
    rows = docs.select("doc_id", "text").collect()
    largest = {}
    for r in rows:
        largest[r.text] = max(r.doc_id, largest.get(r.text, -1))
    assert ids(kept) == sorted(largest.values())


def test_near_copies(steps):
    docs, kept = steps["simhash"]
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    named = plain_components(rows, 4)
    assert ids(kept) == sorted(i for i, f in rows if named[f] == i)


def test_mixing(steps):
    docs, mixed = steps["source_mixing"]
    want = mixing.mix(docs).groupBy("doc_id").count().collect()
    got = mixed.groupBy("doc_id").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_encoding(steps):
    docs, coded = steps["byte_bpe"]
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = coded.collect()
    assert sorted(r.doc_id for r in rows) == ids(docs)
    for r in rows:
        assert r.ids == library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages(spark, steps, sf_dir):
    assert ids(corpus_pipeline.run(spark, sf_dir)) == ids(steps["byte_bpe"][1])


def test_empty_and_odd_documents(spark, edge_docs, no_docs, sf_dir):
    for docs in (no_docs, edge_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == edge_docs.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()


def texts(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_repeated_and_absent_ids_leave_one_row_of_a_text(spark):
    rows = [(1, "a a a a a"), (1, "a a a a a"), (None, "x y z u v"), (None, "x y z u v"), (None, "a a a a a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(1, "a a a a a"), (None, "x y z u v")]
    assert texts(exact_dedup.without_copies(docs, keep="largest")) == want
    assert texts(simhash.without_near_copies(docs)) == want


def test_rows_that_tie_are_told_apart_by_their_other_columns(spark):
    rows = [(1, "b", "t"), (1, "a", "t"), (1, "a", "t"), (2, "z", "other text"), (1, None, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == [(1, "a", "t"), (1, None, "u"), (2, "z", "other text")]


def test_one_row_of_a_component_stays(spark):
    """Texts of one id that are near copies, a component without ids, and two apart."""
    near = " ".join(f"word{i}" for i in range(400))
    other = " ".join(f"term{i}" for i in range(50))
    rows = [(1, near), (1, near + " end"), (2, near), (None, other), (None, other), (None, "short one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = {r.component_id for r in simhash.near_duplicates(docs).where("doc_id is not null").collect()}
    assert named == {1}
    first = min((near, near + " end"), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert texts(simhash.without_near_copies(docs)) == sorted(
        [(1, first), (None, other), (None, "short one")], key=repr
    )


def test_a_third_of_the_rows_is_one_row_repeated(spark, documents):
    one = documents.orderBy("doc_id").limit(1)
    hot = documents.unionByName(one.crossJoin(spark.range(documents.count() // 2)).drop("id"))
    hot = hot.select(*documents.columns)
    assert texts(exact_dedup.without_copies(hot)) == texts(exact_dedup.without_copies(documents))
    assert texts(simhash.without_near_copies(hot)) == texts(simhash.without_near_copies(documents))
