"""The registered queries: names, SQL, and the pipeline stage by stage."""

import pytest
from check_oracles import compare, duck
from test_decontam import brute as phrase_brute
from test_jaccard import brute as jaccard_brute
from test_linededup import plain as line_brute

import __spark_entry__
import corpus_pipeline
from lineflow.llm import linededup, queries

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    _, n, m, status, _ = compare(spark, duck(SF), name, SF)
    assert status == "ok", status


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        rows = sorted(docs.collect(), key=lambda r: r.doc_id)
        out = spark.createDataFrame(stage(spark, docs, SMALL).collect(), stage(spark, docs, SMALL).schema)
        got = sorted(out.collect(), key=lambda r: r.doc_id)
        kept = [r.doc_id for r in got]
        if name != "bpe":
            assert out.columns == docs.columns
        if name == "language":
            assert kept == [r.doc_id for r in rows if r.text and any(c.isalpha() for c in r.text)]
        elif name == "line_dedup":
            want = line_brute([(r.text, r.source) for r in rows], linededup.MIN_SITES)
            assert [r.text for r in got] == [w[0] for w in want]
            assert all(r.n_chars == len(r.text) for r in got)
        elif name == "jaccard":
            parts = jaccard_brute([r.text for r in rows], 5, 80)
            assert kept == [r.doc_id for i, (r, (n, c)) in enumerate(zip(rows, parts, strict=True)) if not n or c == i]
        elif name == "decontaminate":
            assert kept == [r.doc_id for r in rows if not phrase_brute(r.text, items)[1]]
        else:
            assert kept == [r.doc_id for r in rows] and all(r.round_trip for r in got)
        docs = out


def test_stages_keep_further_columns(spark):
    """Columns that only the caller knows go through every stage but the last, whatever their names."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30).selectExpr("*", "doc_id AS _row", "'x' AS score", "'y' AS component")
    for _name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert all(r["_row"] == r["doc_id"] and r["score"] == "x" and r["component"] == "y" for r in out.collect())


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"]
    assert 0 < out.count() < 200
