"""The byte network: held-out accuracy, gradients, edges."""

import zlib

import numpy as np
from helpers import edge_docs, empty_docs
from pyspark.sql import functions as F

import corpus_pipeline
from lineflow.llm import langid
from lineflow.llm.queries import op3_language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op3_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients_match_differences():
    spec = langid.TrainSpec(window=12, embedding=3, widths=(2, 3), filters=2)
    net = langid.ByteNet(["a", "b", "c"], spec)
    for name in ("emb", "conv", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        places = 12 - net.wide + 1
        z = sum(net.emb[x][:, k:k + places] @ net.conv[k] for k in range(net.wide))
        p = langid.softmax(np.maximum(z.max(1) + net.bias, 0) @ net.out + net.out_bias)
        return -np.log(p[np.arange(5), y]).mean()

    grads = net._gradients(x, y, np.ones(5))
    for param, grad in zip([net.emb, net.conv, net.bias, net.out, net.out_bias], grads, strict=True):
        for at in np.argwhere(np.abs(grad) > 1e-3)[:6]:
            at, eps, old = tuple(at), 1e-6, param[tuple(at)]
            param[at] = old + eps
            up = loss()
            param[at] = old - eps
            down = loss()
            param[at] = old
            assert abs((up - down) / (2 * eps) - grad[at]) < 1e-4


def test_tables_equal_the_convolution():
    spec = langid.TrainSpec(window=32)
    net = langid.ByteNet(["a", "b"], spec)
    x = np.random.default_rng(4).integers(0, 256, (50, 32)).astype(np.uint8)
    z = sum(net.emb[x][:, k:k + 32 - net.wide + 1] @ net.conv[k] for k in range(net.wide))
    want = langid.softmax(np.maximum(z.max(1) + net.bias, 0) @ net.out + net.out_bias)
    assert np.allclose(net.window_probabilities(net.pair_tables(), x.reshape(-1)), want, atol=1e-4)


def test_edges(spark):
    docs = edge_docs(spark).withColumn("lang_pred", F.lit(1)).withColumn("score", F.lit("s"))
    net = langid.train(docs)
    out = langid.predict(docs, net)
    assert out.columns == [*docs.columns[:-2], "lang_pred", "score"]
    for r in out.collect():
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr", "de") and 0 < r.score <= 1
    assert langid.train(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.train(empty_docs(spark)) is None
    assert langid.predict(empty_docs(spark), net).count() == 0


def test_pipeline_keeps_lettered_rows_without_labels(spark):
    docs = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = sorted(r.text for r in corpus_pipeline.language(spark, docs, "").collect())
    assert kept and kept == sorted(r.text for r in docs.collect() if r.text and any(c.isalpha() for c in r.text))


def test_copies_count_for_one_in_the_sample(spark):
    """A text that fills a label is learned once, and whatever the partitions the sample is the same."""
    rows = [("the cat and the dog of the house", "en")] * 3000 + [(f"der hund nummer {i} und die katze", "de") for i in range(900)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    nets = [langid.train(docs.repartition(n)) for n in (1, 7)]
    assert nets[0].labels == ["de", "en"]
    got = [[r.lang_pred for r in langid.predict(docs.where("doc_id % 500 = 0").orderBy("doc_id"), net).collect()] for net in nets]
    assert got[0] == got[1] == ["en"] * 6 + ["de"] * 2
