import hashlib

from sensorlake.llm import exact_dedup


def plain(rows, choose):
    out = []
    for i, text in rows:
        same = [j for j, t in rows if (t or "") == (text or "")]
        keep = choose((j for j in same if j is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((i, keep, len(same), i == keep, digest))
    return sorted(out, key=repr)


def test_edges(edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    for keep, choose in (("smallest", min), ("largest", max)):
        got = sorted(map(tuple, exact_dedup.exact_groups(edge_docs, keep=keep).collect()), key=repr)
        assert got == plain(rows, choose)
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_kept_rows_have_their_columns(edge_docs):
    kept = exact_dedup.without_copies(edge_docs, keep="largest")
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, None], key=repr)


def test_texts_shuffle_once_and_stay_in_the_engine(documents):
    plan = exact_dedup.exact_groups(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortAggregate" not in plan
