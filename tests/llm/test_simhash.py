import numpy as np
import xxhash

from sensorlake.llm import simhash
from sensorlake.llm.components import components


def plain_fingerprint(text, words=4):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def plain_components(rows, max_bits):
    """Least id reachable, by flooding over all pairs."""
    bits = np.array([f for _, f in rows], np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None]) <= max_bits
    out, done = {}, set()
    for start in range(len(rows)):
        if start in done:
            continue
        seen, front = {start}, [start]
        while front:
            front = [j for i in front for j in np.flatnonzero(near[i]) if j not in seen]
            seen |= set(front)
            front = list(set(front))
        done |= seen
        ids = [rows[i][0] for i in seen if rows[i][0] is not None]
        out |= {rows[i][1]: min(ids, default=None) for i in seen}
    return out


def compare(docs, max_bits=4):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    named = plain_components(rows, max_bits)
    want = sorted(((i, f"{f:016x}", named[f]) for i, f in rows), key=repr)
    got = sorted(map(tuple, simhash.near_duplicates(docs, 4, max_bits).collect()), key=repr)
    assert got == want


def test_documents_match_brute_force(documents):
    compare(documents)


def test_wider_links_match_brute_force(documents):
    compare(documents, max_bits=9)


def test_edges(edge_docs, no_docs):
    compare(edge_docs)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_tiled_buckets_lose_no_link(spark, monkeypatch):
    """Many fingerprints in one bucket, cut into small tiles."""
    monkeypatch.setattr(simhash, "TILE", 8)
    rng = np.random.default_rng(3)
    values = {simhash._signed(1 << a | 1 << b) for a, b in rng.integers(0, 64, (200, 2)).tolist()}
    rows = spark.createDataFrame([(v,) for v in values], "bits long")
    found = {r.node: r.root for r in components(simhash.links(rows, 2)).collect()}
    want = plain_components([(v, v % (1 << 64)) for v in values], 2)
    assert {v % (1 << 64): found.get(v, v) for v in values} == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id as a", "id + 1 as b").union(
        spark.range(300, 310).selectExpr("id", "300")
    )
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 300 for i in range(300, 310) if i != 300}, 300: 300}
    assert components(edges.limit(0)).count() == 0
