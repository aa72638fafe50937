"""Line dedup against plain Python."""

import random
from collections import defaultdict

import pytest
from helpers import edge_docs, edge_rows, empty_docs

import corpus_pipeline
from lineflow.llm import linededup


def plain(rows, min_sites):
    """Text, lines and removed lines of each row (text, site)."""
    first = {}
    for text, site in rows:
        if text:
            first[text] = min(first.get(text, "=~"), "" if site is None else "=" + site)
    sites = defaultdict(set)
    for text, site in first.items():
        for line in text.split("\n"):
            if line.strip(" \t\r"):
                sites[line.strip(" \t\r")].add(site)
    gone = {k for k, v in sites.items() if len(v) >= min_sites}
    out = []
    for text, _ in rows:
        lines = (text or "").split("\n")
        cut = [x.strip(" \t\r") in gone for x in lines]
        if text and any(cut):
            out.append(("\n".join(x for x, c in zip(lines, cut, strict=True) if not c), len(lines), sum(cut)))
        else:
            out.append((text, len(lines) if text else 0, 0))
    return out


def fixture():
    rng = random.Random(9)
    shared = [f"shared line number {i} é" for i in range(12)]
    rows = []
    for i in range(400):
        lines = [f"own words {i} {k} " + "x" * rng.randrange(40, 90) for k in range(rng.randrange(1, 6))]
        for k, s in enumerate(shared):
            if rng.random() < 0.25 and i % 30 <= k + 3:  # line k is on k + 4 sites
                lines.insert(rng.randrange(len(lines) + 1), rng.choice(["", "  ", "\t"]) + s + rng.choice(["", "\r"]))
        rows.append(("\n".join(lines), f"site{i % 30}"))
    rows += [("", "a"), (None, "a"), ("\n\n \n", "b"), (shared[11], "site1"), ("a\n", None)] + [rows[3]] * 4
    return rows


@pytest.mark.parametrize("few", [linededup.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("min_sites", [8, 5, 2])
def test_matches_plain_python(spark, monkeypatch, min_sites, few):
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", few)
    rows = fixture()
    df = spark.createDataFrame([(i, t, s, "clash") for i, (t, s) in enumerate(rows)], "i int, text string, source string, n_lines string")
    out = linededup.remove_boilerplate(df, min_sites=min_sites)
    assert out.columns == ["i", "text", "source", "n_lines", "n_removed"]
    got = {r.i: (r.text, r.n_lines, r.n_removed) for r in out.collect()}
    assert [got[i] for i in range(len(rows))] == plain(rows, min_sites)
    assert sum(r[2] for r in got.values()) > 0


def test_no_share_of_a_text_saves_its_boilerplate(spark):
    """Short pages lose their notice although it is most of them."""
    notice = "this notice is on every site " * 20
    rows = [(f"own {i}\n{notice}", f"s{i}") for i in range(linededup.MIN_SITES)]
    df = spark.createDataFrame(rows, "text string, source string")
    assert sorted(r.text for r in linededup.remove_boilerplate(df).collect()) == sorted(f"own {i}" for i in range(linededup.MIN_SITES))


def test_counts_at_the_threshold_are_exact(spark):
    rows = [(f"line {n}\nown {n} {s} " + "y" * 200, f"s{s}") for n in range(1, 120) for s in range(n)]
    df = spark.createDataFrame(rows, "text string, source string")
    for t in (10, 60):
        n = linededup.boilerplate_lines(df, min_sites=t).count()
        assert n == 120 - t


def test_edges(spark):
    rows = edge_rows()
    got = linededup.remove_boilerplate(edge_docs(spark), min_sites=2).collect()
    assert len(got) == len(rows)
    want = plain([(r[1], r[3]) for r in rows], 2)
    assert sorted((g.text or "", g.n_removed) for g in got) == sorted((w[0] or "", w[2]) for w in want)
    assert linededup.remove_boilerplate(empty_docs(spark)).count() == 0


def test_pipeline_cuts_boilerplate_and_keeps_copies_whole(spark):
    notice = "this notice is on every site " * 3
    rows = [(i, f"own {i}\n{notice}", "en", f"s{i}", 0) for i in range(linededup.MIN_SITES)]
    rows += [(50, notice, "en", "s1", 0)] + [(100 + i, "whole\ncopy", "en", f"s{i}", 0) for i in range(linededup.MIN_SITES)]
    rows += [(200 + i, f"whole\nwith own {i}", "en", "s1", 0) for i in range(2)]
    # a syndicated page still loses the lines that other texts spread
    rows += [(300 + i, f"page\n{notice}", "en", f"s{i}", 0) for i in range(linededup.MIN_SITES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert [got[i] for i in range(linededup.MIN_SITES)] == [f"own {i}" for i in range(linededup.MIN_SITES)]
    assert got[50] == ""
    assert {got[100 + i] for i in range(linededup.MIN_SITES)} == {"whole\ncopy"}
    assert [got[200], got[201]] == ["whole\nwith own 0", "whole\nwith own 1"]  # copying made no line of theirs boilerplate
    assert {got[300 + i] for i in range(linededup.MIN_SITES)} == {"page"}
