"""Rows with every awkward case, and plain Python versions of shared pieces."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, n_tokens string, _h string, _row string, _key string, _t1 string"


def edge_rows():
    long_text = " ".join(f"word{i % 977} the" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", "b", 6), (4, "One two three.", None, "a", 14),
        (4, "One two three.", None, "a", 14), (None, "One two three.", "en", None, None), (None, None, None, None, None),
        (5, long_text, "en", "c", len(long_text)), (6, "Ünïcödé ñandú – 東京 😀 a\0b", "fr", "c", 25), (7, "12 345 !!", "de", "a", 9),
        (8, "one two three.", "en", "b", 14), (9, "a", "en", "b", 1)]
    return [(*r, "x", "y", "z", "r", "k", "t") for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def random_docs(seed: int, n: int, vocabulary: int = 400):
    """Texts with exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passage = [rng.choice(words) for _ in range(30)]
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.15:
            text = rng.choice(out)
        elif out and kind < 0.5:
            old = rng.choice(out).split()
            for _ in range(rng.choice([1, 1, 2, 3])):
                old[rng.randrange(len(old))] = rng.choice(words)
            text = " ".join(old)
        else:
            new = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
            if rng.random() < 0.3:
                at = rng.randrange(len(new))
                new[at:at] = passage
            text = " ".join(new)
        out.append(text)
    return out
