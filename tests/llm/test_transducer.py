"""Token counts against the tokenizers library, and the parts of the transducers."""

import random

import numpy as np
from helpers import edge_docs, edge_rows, empty_docs

import public_tokenizers
from lineflow.llm import transducer
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_texts_match_the_library():
    rng = random.Random(5)
    signs = ["'", "s", "re", " ", "  ", "\n", "a", "1", "!", "é", "<|endoftext|>", "ll", "th", "zz", "Ü", "<|startoftext|>", "aaa"]
    texts = ["", " ", "don't 'tis 've it'S''s", "ſ's İ ΑΣ 'ſ 'S", "e" * 3000, "\x1c\x85﻿ a", "é́ e\u0301", "東京 12"]
    texts += ["".join(rng.choice(signs) for _ in range(40)) for _ in range(1500)]
    got = transducer.count_tokens(transducer.Counter(transducer.Merges(PATH)), texts)
    want = [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert got.tolist() == want


def test_scan_does_not_depend_on_chunks(monkeypatch):
    kinds = np.random.default_rng(1).integers(0, 4, 5000).astype(np.uint8)
    whole = transducer.split_scan(kinds)
    monkeypatch.setattr(transducer, "CHUNK", 7)
    assert (transducer.split_scan(kinds) == whole).all()


def test_bounded_tables_change_nothing(monkeypatch):
    counter = transducer.Counter(transducer.Merges(PATH))
    texts = ["antidisestablishmentarianism and other words", "words other and more"] * 3
    want = transducer.count_tokens(counter, texts)
    monkeypatch.setattr(transducer, "MAX_TRANSITIONS", 5)
    for text, n in zip(texts, want, strict=True):
        assert transducer.count_tokens(counter, [text]).tolist() == [n]


def test_columns_and_edges(spark):
    out = transducer.token_counts(edge_docs(spark), PATH)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "_h", "_row", "_key", "_t1", "n_tokens"]
    library = Tokenizer.from_file(PATH)
    rows = out.collect()
    assert len(rows) == len(edge_rows())
    assert all(r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids) for r in rows)
    assert transducer.token_counts(empty_docs(spark), PATH).count() == 0
