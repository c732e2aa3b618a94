import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import toxicity
from sensorlake.llm.queries import fold, op4_toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    """Made of given texts: insults in some, with and without tricks of spelling."""
    rng = np.random.default_rng(3)
    plain = ["river", "stone", "garden", "music", "window", "paper", "you", "are", "the", "of"]
    bad = ["dimwit", "dullard", "blockhead"]
    rows = []
    for i in range(1_200):
        words = rng.choice(plain, rng.integers(8, 60)).tolist()
        toxic = i % 4 == 0
        if toxic:
            for at in rng.integers(0, len(words), 3):
                words[at] = str(rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()


def auc(scores, labels):
    order = np.argsort(np.argsort(scores))
    ones = np.array(labels) == 1
    n = ones.sum()
    return (order[ones].sum() - n * (n - 1) / 2) / (n * (len(labels) - n))


def test_held_out_accuracy(labelled):
    scorer = toxicity.fit(labelled.select("doc_id", "text"), labelled, fold(5) != 0)
    rows = scorer.score(labelled.where(fold(5) == 0), "text").collect()
    assert auc([r.score for r in rows], [r.toxic for r in rows]) > 0.99
    wrong = [r for r in rows if (r.score >= 0.5) != (r.toxic == 1)]
    assert len(wrong) <= 0.02 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_documents_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = op4_toxicity(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert auc([r.score for r in rows], [r.toxic for r in rows]) > 0.85
    assert scored.count() == 1_000


def test_edges(spark, edge_docs, no_docs, labelled):
    scorer = toxicity.fit(labelled.select("doc_id", "text"), labelled, fold(5) != 0)
    rows = scorer.score(edge_docs.withColumn("score", F.lit("clash")), "text").collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert scorer.score(no_docs, "text").count() == 0


def test_labels_of_one_kind_or_none(edge_docs, labelled):
    docs = labelled.select("doc_id", "text")
    one = toxicity.fit(docs, labelled.where("toxic = 1"), fold(5) != 0)
    assert {r.score for r in one.score(edge_docs, "text").collect()} == {1.0}
    none = toxicity.fit(docs, labelled.withColumn("toxic", F.lit(None).cast("int")), fold(5) != 0)
    assert {r.score for r in none.score(edge_docs, "text").collect()} == {0.0}


def test_features():
    lexicon = toxicity.Lexicon({"dimwit": 4.0, "dull*": 3.0})
    named = lambda text: dict(zip(toxicity.FEATURES, lexicon.features(text)))
    plain = named("a quiet day")
    assert plain["word_density"] == plain["stem_density"] == plain["strongest"] == 0
    assert named("")["length"] == 0
    assert named("you dimwit of the day")["proximity"] > named("you were, on that day long ago in spring then, a dimwit")["proximity"]
    assert named("DIMWIT!!")["shouted"] == 1 and named("DIMWIT!!")["punctuation_runs"] == 1
    assert named("dullness")["stem_density"] == 1
    assert named("d1mw1t a")["hidden_density"] > 0 and named("d.i.m.w.i.t a")["hidden_density"] > 0
    assert all(np.isfinite(lexicon.features("\x00 \x85 ß 東京 " * 50)))
