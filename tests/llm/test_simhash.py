"""SimHash against plain Python; search against all pairs; the order of documents."""

import hashlib
import random
from collections import Counter

import xxhash
from helpers import edge_docs, edge_rows, empty_docs, random_docs
from pyspark.sql import functions as F

from lineflow.llm import simhash
from lineflow.llm.queries import op8_fingerprints


def spark_hash(values, seed=42):
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def plain(text, width=simhash.WORDS):
    words = [spark_hash([w]) for w in (text or "").lower().split()]
    terms = [spark_hash(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(t >> b & 1 for t in terms) > len(terms))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(spark):
    texts = [*random_docs(1, 60), "", None, "one", "a b c d", "Upper UPPER ümlaut  \n two", " ".join(["x"] * 5000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "i int, text string, _h string")
    got = {r.i: r.fingerprint for r in simhash.fingerprints(df, ["i"], "text").collect()}
    assert got == {i: signed(plain(t)) for i, t in enumerate(texts)}


def test_search_finds_all_within_the_radius(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = base + [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for b in base for _ in range(8)]
    prints = [p % (1 << 64) for p in prints]
    df = spark.createDataFrame([(signed(p),) for p in [*prints, prints[0]]] + [(None,)], "fingerprint long")
    asked = df.limit(60)
    wanted = {r[0] for r in asked.collect()}
    got = {(r.query, r.fingerprint): r.distance for r in simhash.within(asked, df).collect()}
    want = {(a, signed(b)): (a % (1 << 64) ^ b).bit_count() for a in wanted for b in set(prints) if (a % (1 << 64) ^ b).bit_count() <= simhash.RADIUS}
    assert got == want


def test_search_at_the_edge_of_the_radius(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = [b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (0, 1, 12, 15, 16, 17)]
    asked = spark.createDataFrame([(signed(b),) for b in base], "fingerprint long")
    df = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    for radius, blocks in ((16, 5), (8, 2), (8, 3), (8, 4), (3, 6), (0, 4)):
        got = [(r.query, r.fingerprint) for r in simhash.within(asked, df, radius, blocks).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(signed(a), signed(p)) for a in base for p in prints if (a ^ p).bit_count() <= radius}


def test_query_returns_near_copies(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for i in range(40):  # 100 words and a copy with two words changed: Jaccard at least 0.8
        words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        copy = [*words[:30], f"x{i}", *words[31:70], f"y{i}", *words[71:]]
        rows += [(i * 50, " ".join(words)), (i * 50 + 1, " ".join(copy))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op8_fingerprints(spark, str(tmp_path)).collect()}
    found = [bin(int(got[i * 50 + 1].fingerprint, 16) ^ int(got[i * 50].fingerprint, 16)).count("1") <= simhash.RADIUS for i in range(40)]
    assert sum(found) >= 36  # 0.9 of them; votes of unrelated bits put a few farther than the radius
    for i in range(40):
        assert got[i * 50 + 1].near_docs is None and got[i * 50 + 1].near_least is None
        assert got[i * 50].near_docs >= found[i] and got[i * 50].near_least <= i * 50


def test_recall_of_near_copies(spark):
    """Pairs of 0.8 and more over shingles of five words, by brute force: at least 0.9 are within the radius."""
    texts = sorted({t for t in (r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()) if t})
    rng = random.Random(3)
    for t in texts[::4]:  # more of them: copies with every twentieth to fiftieth word changed
        words = t.split()
        texts.append(" ".join(f"x{k}" if rng.random() < 0.02 else w for k, w in enumerate(words)))
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in texts)]
    places = {}
    for i, s in enumerate(sets):
        for g in s:
            places.setdefault(g, []).append(i)
    common = Counter((a, b) for p in places.values() if len(p) <= 40 for a in p for b in p if a < b)
    near = [(a, b) for (a, b), c in common.items() if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    prints = {r.i: r.fingerprint % (1 << 64) for r in simhash.fingerprints(df, ["i"], "text").collect()}
    held = sum((prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS for a, b in near)
    assert len(near) > 60 and held >= 0.9 * len(near)


def test_blocks_follow_the_number_of_fingerprints():
    """Work per fingerprint, with a fiftieth of them asked: it grows much more slowly than they do."""
    chosen = [simhash.block_count(simhash.RADIUS, n) for n in (10_000, 250_000, 15_000_000, 10**9, 10**11)]
    assert chosen == sorted(chosen, reverse=True) and chosen[-1] == 2
    met = {b: sum(len(simhash._flips(m, r)) / 2 ** m.bit_count() for m, r in simhash.block_radii(simhash.RADIUS, b)) for b in (3, 4)}
    assert met[3] < 0.0004 and met[4] < 0.003  # of all fingerprints


def brute(rows):
    """The contract's columns in plain Python, by doc_id."""
    rows = sorted(rows)
    out = {}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(text) // 4
        new = text[:len(text) - q] + after[:q]
        a, b, c = plain(text), plain(new), plain(after)
        near = sum((a ^ plain(t)).bit_count() <= simhash.RADIUS for _, t in rows) - 1
        least = min(j for j, t in rows if (a ^ plain(t)).bit_count() <= simhash.RADIUS)
        asked = (near, least) if i % 50 == 0 else (None, None)
        out[i] = (len(text), hashlib.sha256(new.encode()).hexdigest(), f"{a:016x}", f"{b:016x}",
                  1 - (a ^ b).bit_count() / 64, 1 - (a ^ c).bit_count() / 64, *asked)
    return out


def run(spark, tmp_path, rows):
    d = tmp_path / f"t{len(rows)}"
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next, r.near_docs, r.near_least)
            for r in op8_fingerprints(spark, str(d)).collect()}


def test_query_matches_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS_PER_BUCKET", 20)
    rows = [(i * 10, t) for i, t in enumerate(random_docs(2, 230))]
    rows[5], rows[17], rows[40] = (50, None), (170, ""), (400, "ünï cödé 😀 " * 50)
    assert run(spark, tmp_path, rows) == brute(rows)
    assert run(spark, tmp_path, rows[:1]) == brute(rows[:1])


def test_nulls_repeats_and_empty(spark, tmp_path):
    d = tmp_path / "edge"
    edge_docs(spark).write.parquet(f"{d}/documents.parquet")
    rows = op8_fingerprints(spark, str(d)).collect()
    assert len(rows) == len(edge_rows())
    assert sorted(r.fingerprint for r in rows) == sorted(f"{plain(r[1]):016x}" for r in edge_rows())
    e = tmp_path / "empty"
    empty_docs(spark).write.parquet(f"{e}/documents.parquet")
    assert op8_fingerprints(spark, str(e)).count() == 0
    # no next text without an id: the likeness is to the empty one, the same for equal texts
    lone = [r.near_next for r in rows if r.doc_id is None]
    want = [1 - (plain(r[1]) ^ plain("")).bit_count() / 64 for r in edge_rows() if r[0] is None]
    assert sorted(lone) == sorted(want)
    n = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert simhash.with_next(n, "doc_id", "text").where(F.col("_next") == "").count() == 2
