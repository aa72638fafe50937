"""The Merkle manifest against a plain Python tree, with many levels and leaf partitions."""

import random
from hashlib import sha256

import pytest
from helpers import edge_docs, empty_docs
from pyspark.sql import functions as F

from lineflow.llm import merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests):
    """Levels of the tree, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = at - at % 3
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + 3])))
        at //= 3
    return out


def expected(rows):
    """(source, id, leaf, subroot, root, proof) of rows (source, id, text)."""
    groups = {}
    for source, i, text in rows:
        groups.setdefault("" if source is None else "=" + source, []).append((i is not None, i or 0, h(field(source) + field(i) + field(text))))
    trees = {k: tree([leaf for *_, leaf in sorted(v)]) for k, v in groups.items()}
    names = sorted(trees, key=str.encode)
    top = tree([trees[k][-1][0] for k in names])
    out = []
    for k in names:
        for at, (known, i, leaf) in enumerate(sorted(groups[k])):
            proof = siblings(trees[k], at) + siblings(top, names.index(k))
            out.append((k[1:] if k else None, i if known else None, leaf, trees[k][-1][0], top[-1][0], tuple(proof)))
    return sorted(out, key=str)


def proved(docs, span):
    columns = [F.col(c) for c in ("source", "doc_id", "text")]
    made = merkle.build(docs, "source", "doc_id", merkle.leaf_of(*columns), {"source": columns[0], "doc_id": columns[1]}, span)
    rows = merkle.prove(made).withColumn("folded", merkle.fold(F.col("_leaf"), F.col("_proof"))).collect()
    assert all(r["folded"] == r["_root"].hex() for r in rows)
    return sorted(((r["_row"]["source"], r["_row"]["doc_id"], r["_leaf"].hex(), r["_subroot"].hex(), r["_root"].hex(),
                    tuple((s["left"], s["right"]) for s in r["_proof"])) for r in rows), key=str), made


def test_missing_is_minimal():
    rng = random.Random(3)
    for size in (1, 2, 3, 4, 26, 27, 28, 100):
        levels = tree([str(i) for i in range(size)])
        known = sorted(rng.sample(range(size), rng.randint(1, size)))
        need = set(merkle.missing(known, size))
        derived, wanted = {(0, i) for i in known}, set()
        for level, nodes in enumerate(levels[:-1]):
            for at in {i for lv, i in derived if lv == level}:
                wanted |= {(level, j) for j in range(at - at % 3, min(at - at % 3 + 3, len(nodes)))}
                derived.add((level + 1, at // 3))
        assert need == wanted - derived


@pytest.mark.parametrize("span", [1, 2, 8])
def test_against_plain_tree(spark, span):
    rng = random.Random(5)
    rows = [("hot", i, f"t{i % 40}") for i in range(100)] + [(f"s{rng.randrange(12)}", i, "x") for i in range(100, 140)]
    rows += [(None, None, None), (None, 7, ""), ("é", 7, "a\nb"), ("z", None, "q"), ("z", 3, "q"), ("one", 1, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "source string, doc_id long, text string").repartition(5)
    got, made = proved(docs, span)
    assert got == expected(rows)
    assert [r["root"] for r in made.root.collect()] == [got[0][4]]


def test_a_hot_id_and_copies_spread(spark):
    """Rows equal in all they are ordered by are dealt to several ranges, and take any of their places."""
    rows = [("a", 1, "same")] * 400 + [("a", i, "x") for i in range(2, 30)]
    docs = spark.createDataFrame(rows, "source string, doc_id long, text string").repartition(4)
    got, made = proved(docs, 2)
    assert got == expected(rows)
    assert made.leaves.where("_at < 400").select(F.expr("_at div 9")).distinct().count() == 45


def test_tampering_shows(spark):
    docs = spark.createDataFrame([("a", i, f"l\n{i}") for i in range(10)], "source string, doc_id long, text string")
    leaf = merkle.leaf_of(F.col("doc_id"), F.col("text"))
    other = merkle.leaf_of(F.col("doc_id"), F.replace("text", F.lit("\n"), F.lit("")))
    made = merkle.build(docs, "source", "doc_id", leaf, {"now": other})
    assert merkle.prove(made).where(merkle.fold(F.col("_row.now"), F.col("_proof")) == F.lower(F.hex("_root"))).count() == 0


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r["source"], r["doc_id"], r["text"]) for r in docs.collect()]
    assert proved(docs, 1)[0] == expected(rows)
    got, made = proved(empty_docs(spark), 2)
    assert got == [] and made.root.count() == 0
