"""Components against all pairs in plain Python."""

import re

import pytest
from helpers import edge_docs, edge_rows, empty_docs, random_docs

from lineflow.llm import jaccard


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(texts, width, threshold):
    sets = [shingles(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= threshold * (len(a) + len(sets[j]) - both) and both:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("width, threshold, seed", [(3, 90, 1), (3, 50, 2), (5, 80, 3), (1, 70, 4)])
def test_components(spark, monkeypatch, width, threshold, seed):
    monkeypatch.setattr(jaccard, "GROUP", 3)
    monkeypatch.setattr(jaccard, "QUERIES_PER_TASK", 2)
    monkeypatch.setattr(jaccard, "SKETCH_BITS", 10)
    texts = [*random_docs(seed, 250), None, "", " \n", "One", "one", "one two", "Two one", "é ü", "É ü"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    got = {r.id: (r.n, r.component) for r in jaccard.components(df, width=width, threshold=threshold).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, width, threshold)


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i:i + 100]) for i in range(0, 300, 3)]  # only neighbours are linked
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.component for r in jaccard.components(df).collect()}
    assert got == {c for _, c in brute(texts, 3, 90)}


def test_keep_one(spark):
    texts = [*random_docs(7, 150), None, None, "", ""]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(0, texts[0], "k"), (None, texts[1], "k"), (None, "lonely words of it", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string").repartition(5)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in jaccard.keep_one(df).collect())
    parts = {}
    for (i, t, _), (n, c) in zip(rows, brute([t for _, t, _ in rows], 3, 90), strict=True):
        parts.setdefault(c if n else ("none", len(parts)), []).append((i if i is not None else -1, t or ""))
    assert got == sorted(min(v) for v in parts.values())


def test_edges(spark):
    rows = edge_rows()
    got = sorted((r.n, r.id if r.id is not None else -1, r.component if r.component is not None else -1)
                 for r in jaccard.components(edge_docs(spark)).collect())
    want = []
    for (n, c), r in zip(brute([r[1] for r in rows], 3, 90), rows, strict=True):
        ids = [q[0] for q, (m, d) in zip(rows, brute([q[1] for q in rows], 3, 90), strict=True) if m and d == c and q[0] is not None]
        own = r[0] if r[0] is not None else -1
        want.append((n, own, min(ids, default=-1) if n else own))
    assert got == sorted(want)
    assert jaccard.components(empty_docs(spark)).count() == 0
    assert jaccard.keep_one(empty_docs(spark)).count() == 0
