"""Byte BPE against the tokenizers library."""

import random

import pytest
from helpers import edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

import public_tokenizers
from lineflow.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
CASES = ["", " ", "a  b", "\n\n a\n", "don't 'tis 've it'S''s !'s 's'd'll", "x<|endoftext|> y <|endoftext|><|endoftext|>  ",
         "ñandú 12 ½ 3४ é́", "a\0b\0", "a" * 4000, "'", "'l", "x  y​z", "😀😀 a😀", "a\r\n\tb", "ſ's İ", "it's\n's \t't"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_texts_match_the_library(library):
    rng = random.Random(3)
    signs = ["'", "s", "re", " ", "  ", "\n", "a", "1", "!", "é", "<|endoftext|>", "ll", "th", "ing"]
    texts = CASES + ["".join(rng.choice(signs) for _ in range(40)) for _ in range(1500)]
    t = bpe.MergeTables(PATH)
    flat, offsets = bpe.encode_texts(t, texts)
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        ids = flat[offsets[i]:offsets[i + 1]]
        assert ids.tolist() == e.ids, texts[i]
        assert bpe.decode_bytes(t, ids).tobytes().decode("utf-8", "replace") == library.decode(e.ids, skip_special_tokens=False)


def test_columns_and_edges(spark, library):
    out = bpe.decode(bpe.encode(edge_docs(spark), PATH), PATH)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "_h", "_row", "_key", "_t1", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        assert r.decoded == (r.text or "")
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids


def test_broken_bytes_and_null_ids(spark, library):
    half = library.encode("é", add_special_tokens=False).ids + library.encode("😀", add_special_tokens=False).ids[:1]
    df = spark.createDataFrame([(half,), (None,), ([],)], "ids array<int>")
    got = [r.decoded for r in bpe.decode(df, PATH).collect()]
    assert got == [library.decode(half, skip_special_tokens=False), "", ""]


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(empty_docs(spark), PATH), PATH).where(F.lit(True)).count() == 0
