import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from sensorlake.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """The root of nodes, and for each the siblings on the way up with their side."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        pairs = [list(range(i, min(i + 2, len(nodes)))) for i in range(0, len(nodes), 2)]
        for pair in pairs:
            for own in pair:
                other = [x for x in pair if x != own]
                mark = ("LR"[other[0] > own] + nodes[other[0]]) if other else ""
                for m in members[own]:
                    paths[m].append(mark)
        members = [[m for x in pair for m in members[x]] for pair in pairs]
        nodes = [h(*[nodes[x] for x in pair]) for pair in pairs]
    return nodes[0], paths


def plain(rows):
    """``doc_id, leaf, subroot, root, siblings`` of every row."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, upper = climb([trees[g][0] for g in order])
    return [
        (x[3][0], x[2], trees[g][0], root, path + upper[i])
        for i, g in enumerate(order)
        for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1])
    ]


def compare(docs, block=2):
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    got = merkle.manifest(docs, block=block).select("doc_id", "leaf", "subroot", "root", "witness").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("block", [1, 2, 9])
def test_documents_match_brute_force(documents, block):
    compare(documents, block)


def test_edges(edge_docs, no_docs):
    docs = edge_docs.withColumn("lang", F.when(F.col("doc_id") != 5, F.col("source")))
    for name in ("grp", "by", "place", "tie", "witness", "leaf", "root", "block"):
        docs = docs.withColumn(name, F.lit("clash"))
    compare(docs)
    compare(docs.unionByName(docs).unionByName(docs.where("doc_id = 0")))
    compare(docs.limit(1))
    compare(docs.withColumn("lang", F.lit(None).cast("string")))
    assert merkle.manifest(no_docs.withColumn("lang", F.lit("en"))).count() == 0


def test_many_groups(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"),
        F.concat(F.lit("g"), F.pmod(F.hash("id"), F.lit(37)).cast("string")).alias("lang"),
        F.lit(1).cast("long").alias("n_chars"), F.col("id").cast("string").alias("text"),
    )
    compare(docs)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 64, 65])
def test_appended_nodes_have_their_witnesses(n):
    nodes = [h(str(i)) for i in range(n)]
    tree = merkle.Appender()
    for i, node in enumerate(nodes):
        tree.append(node)
        # Whole subtrees have the same witnesses already that they keep.
        assert all(w == full[: len(w)] for w, full in zip(tree.witnesses, climb(nodes)[1]))
    assert (tree.close(), tree.witnesses) == climb(nodes)


def test_query_finds_changed_rows(spark, sf_dir, documents):
    rows = [tuple(r) for r in documents.select(*FIELDS).collect()]
    siblings = {(d, x): [s[1:] for s in w if s] for d, x, _, _, w in plain(rows)}
    for r in queries.op13_merkle_manifest(spark, sf_dir).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) == (r.folded_root == r.root)
        assert r.proof_sha256 == h(*siblings[r.doc_id, r.leaf])
