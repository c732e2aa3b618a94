from collections import defaultdict

import numpy as np

from sensorlake.llm import line_dedup


def plain(rows, most):
    """The same rule over all documents in memory, lines compared as text."""
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows}, key=lambda r: r[:2])
    first = {}
    for named, i, text in order:
        first.setdefault(text, (named, i))
    lines = {t: [x.strip(" ") for x in t.split("\n")] for t in first}
    holders = defaultdict(list)
    for text in first:  # in order of place
        for line in dict.fromkeys(lines[text]):
            if line:
                holders[line].append(text)
    rare = defaultdict(lambda: defaultdict(set))
    for line, texts in holders.items():
        if 2 <= len(texts) <= most:
            for text in texts[1:]:
                rare[text][texts[0]].add(line)
    out = []
    for i, text in rows:
        text = text or ""
        own, gone, partners = text.split("\n"), set(), set()
        if text.strip(" ") and ((i is not None, i or 0) != first[text]):
            gone, partners = set(range(len(own))), {first[text]}
        elif text.strip(" "):
            for other, shared in rare[text].items():
                found = line_dedup.common_blocks(lines[other], lines[text], shared)
                gone |= set(found)
                partners |= {first[other]} if found else set()
        kept = "\n".join(x for n, x in enumerate(own) if n not in gone)
        ids = sorted(p for named, p in partners if named)
        out.append((i, len(own), len(gone), ids, kept))
    return sorted(out, key=repr)


def compare(docs, most=line_dedup.MOST_DOCUMENTS):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, line_dedup.without_repeats(docs, most).collect()), key=repr)
    assert got == plain(rows, most)


def test_documents_match_plain_rule(documents):
    compare(documents)
    compare(documents, most=2)


def test_edges(edge_docs, no_docs):
    compare(edge_docs)
    assert line_dedup.without_repeats(no_docs).count() == 0


def test_blocks_around_rare_lines(spark):
    rows = [
        (1, "intro\nshared rare\nshared two\ncommon\nend one"),
        (2, "other\nshared rare\nshared two\nnew\ncommon"),
        (3, "common\nalone"),
        (4, "common\nalso alone"),
        (5, "x\nintro\nshared rare\nshared two\ncommon\nend one"),
    ]
    got = {r.doc_id: r for r in line_dedup.without_repeats(
        spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()}
    assert got[1].n_removed == 0 and got[3].n_removed == 0
    assert got[2].kept == "other\nnew\ncommon" and got[2].partner_ids == [1]
    assert got[5].kept == "x" and got[5].n_removed == 5


def test_patience_is_increasing_and_finds_moved_text():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = rng.integers(0, 12, rng.integers(0, 20)).tolist()
        b = rng.integers(0, 12, rng.integers(0, 20)).tolist()
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    assert line_dedup.patience(list("abcde"), list("xabyde")) == [(0, 1), (1, 2), (3, 4), (4, 5)]
    assert line_dedup.patience([], [1]) == []


def all_pairs(rows):
    """The texts left, by id, when each document is aligned with all earlier ones; ids and texts are distinct."""
    lines = {i: [x.strip(" ") for x in t.split("\n")] for i, t in rows}
    out = {}
    for i, text in rows:
        gone = set()
        for j in sorted(lines):
            if j < i:
                shared = set(lines[i]) & set(lines[j]) - {""}
                gone |= set(line_dedup.common_blocks(lines[j], lines[i], shared))
        out[i] = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
    return out


def test_lines_the_first_holder_leaves_meet_all_others(spark):
    cases = [
        ["a\np\nb\np\nc", "x\np\ny", "z\np\nw"],
        ["p\nq", "x\nq\np\ny", "z\nq\np\nw"],
        # None of the first thirty aligns the line; the last two do.
        [f"a{n}\nr\nb{n}\nr\nc{n}" for n in range(30)] + ["u\nr\nv", "s\nr\nt"],
    ]
    rng = np.random.default_rng(3)
    for _ in range(3):
        sizes = rng.integers(1, 9, 25)
        cases.append(["\n".join(f"l{x}" for x in [100 + n, *rng.integers(0, 12, size)]) for n, size in enumerate(sizes)])
    for texts in cases:
        rows = list(enumerate(texts))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.kept for r in line_dedup.without_repeats(docs).collect()}
        assert got == all_pairs(rows)


def test_frequent_lines_go_whatever_their_number(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MOST_DOCUMENTS", 3)
    rows = [(i, f"own {i}\nshared one\nshared two\nend {i}") for i in range(12)]
    got = {r.doc_id: r.kept for r in line_dedup.without_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: rows[0][1]} | {i: f"own {i}\nend {i}" for i in range(1, 12)}


def all_earlier(rows):
    """``id, lines left but for blank ones``: each distinct text aligned with all earlier ones."""
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows}, key=lambda r: r[:2])
    first = {}
    for named, i, text in order:
        first.setdefault(text, (named, i))
    lines = {t: [x.strip(" ") for x in t.split("\n")] for t in first}
    left = {}
    for n, text in enumerate(first):
        gone = set()
        for other in list(first)[:n]:
            shared = set(lines[text]) - {""}
            gone |= set(line_dedup.common_blocks(lines[other], lines[text], shared))
        left[text] = [x for k, x in enumerate(lines[text]) if k not in gone and x]
    copies = lambda i, t: (i is not None, i or 0) != first[t]
    return sorted(((i, [] if copies(i, t or "") else left[t or ""]) for i, t in rows), key=repr)


def compare_all(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = line_dedup.without_repeats(docs).select("doc_id", "kept").collect()
    left = [(r.doc_id, [x.strip(" ") for x in r.kept.split("\n") if x.strip(" ")]) for r in got]
    assert sorted(left, key=repr) == all_earlier(rows)


def test_the_mode_of_the_query_equals_all_pairs(spark, documents, edge_docs):
    compare_all(documents)
    compare_all(edge_docs)
    rng = np.random.default_rng(11)
    texts = set()
    while len(texts) < 120:  # many repeated lines, equal first and last lines, blank lines
        lines = [f"l{x}" if x else "" for x in rng.integers(0, 9, rng.integers(1, 12))]
        texts.add("\n".join(lines))
    compare_all(spark.createDataFrame(list(enumerate(sorted(texts))), "doc_id long, text string"))


def test_a_divider_in_every_text_makes_no_pairs(spark, monkeypatch):
    align, pairs = line_dedup._align, []

    def counted(texts, met):
        pairs.append(met.count())
        return align(texts, met)

    monkeypatch.setattr(line_dedup, "_align", counted)
    for n in (100, 200):
        texts = [f"head {i}\n---\nbody {i}\n---\ntail {i}" for i in range(n)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        pairs.clear()
        assert [r.n_removed for r in line_dedup.without_repeats(docs).collect()] == [0] * n
        assert sum(pairs) == n - 1
