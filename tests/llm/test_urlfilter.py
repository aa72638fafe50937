"""URL verdicts against plain Python, with and without broadcasts."""

import random

import pytest
from pyspark.sql import functions as F

from lineflow.llm import urlfilter
from lineflow.llm.queries import RULES


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule_of(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.host + r.path)) if fit else None


def urls():
    rng = random.Random(1)
    out = [None, "", "no scheme", "http://", "http://?a=1", "HTTP://WWW.Example.COM/en/x", "https://example.com/en", "ftp://a.net/es/b#c",
           "http://x.net/fr/?q", "http://notnet/es/", "http://a://b/c", "http://bücher.de/a\nb?c", "http://x.org/" + "a" * 100_000]
    hosts = ["a.org", "www.b.org", "b.org:80", "C.org", "deep.a.org"]
    for _ in range(600):
        out.append(f"http://{rng.choice(hosts)}/{rng.choice(['', 'x', 'y/', 'y/index.html'])}{rng.choice(['', '?utm_a=1', '?b=2&a=1', '?a=1&b=2#f'])}")
    return out


@pytest.mark.parametrize("limit", [urlfilter.BROADCAST_BYTES, 0])
def test_verdicts(spark, limit):
    pages = spark.createDataFrame([(i, u, "clash", 1, "v", "p") for i, u in enumerate(urls())],
                                  "page_id long, url string, host string, rule int, verdict string, _key string")
    listed = spark.createDataFrame([("http://www.b.org/y",), ("https://a.org/x?a=1&b=2",), (None,), ("https://b.org/y/",)], "url string")
    keys = {r[0] for r in listed.select(urlfilter.canonical(F.col("url"))).collect()} - {None}
    canon = dict(pages.select("page_id", urlfilter.canonical(F.col("url"))).collect())
    rows = urlfilter.judge(pages, listed, RULES, broadcast_bytes=limit).collect()
    assert len(rows) == len(urls())
    blocked = 0
    for r in rows:
        host, path = host_path(r.url)
        assert (r.host, r.path) == (host, path)
        rule = rule_of(host, path)
        assert r.rule == (rule.host + rule.path if rule else None)
        hit = canon[r.page_id] in keys
        assert r.verdict == (rule.verdict if rule else "block" if hit else "allow")
        blocked += hit
    assert blocked > 20


def test_canonical_forms(spark):
    same = ["http://www.B.org/y/?utm_x=1&b=2&a=1#z", "https://b.org:443/y?a=1&b=2", "https://b.org/y/index.html?b=2&a=1"]
    df = spark.createDataFrame([(u,) for u in same], "url string")
    assert {r[0] for r in df.select(urlfilter.canonical(F.col("url"))).collect()} == {"b.org/y?a=1&b=2"}


def test_bloom_passes_every_key_and_few_others(spark):
    names = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("_listed"))
    blocks = urlfilter.bloom_blocks(names, 5000 * 16 // 256)
    probe = spark.range(10000).select(F.concat(F.lit("h/"), "id").alias("_key"), "id")
    joined = probe.withColumn("_block", F.pmod(F.xxhash64("_key"), F.lit(5000 * 16 // 256))).join(blocks, "_block", "left")
    for j, w in enumerate(urlfilter._bits(F.col("_key"))):
        joined = joined.where(F.col(f"_w{j}").bitwiseAND(w) == w)
    passed = {r.id for r in joined.select("id").collect()}
    assert set(range(5000)) <= passed and len(passed) < 5200


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge(pages, pages, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert urlfilter.judge(one, pages, RULES).first().verdict == "allow"


def test_the_list_decides_what_hosts_cannot(spark, tmp_path):
    """Clean hosts with a listed word inside stay; a clean page of a listed canonical URL goes, by filter and exact join alone."""
    from lineflow.llm import queries, urlfilter

    junk, fine = "<title>De%%% ou###</title>", "<title>Fine</title>"
    rows = [(1, "http://downloads.org/a", fine), (2, "https://roads.net/b", fine), (3, "http://alphabets.net/c", fine),
            (4, "https://www.once-junk.org/x/?utm_a=1", junk), (5, "http://once-junk.org/x", fine), (6, "http://once-junk.org/y", fine),
            (7, "http://m.spam-farm.example.org/z", fine), (8, None, junk), (9, "http://spam-farmers.org/", fine)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.verdict for r in queries.op4_url_filter(spark, str(tmp_path)).collect()}
    assert {k for k, v in got.items() if v == "block"} == {4, 5, 7}
    pages = spark.createDataFrame([(i, f"http://h{i}.org/p") for i in range(3000)], "page_id long, url string")
    listed = pages.where("page_id % 3 = 0")
    real = urlfilter.bloom_blocks
    verdicts = []
    for blocks in (real, lambda names, n: real(names, n).where("false")):  # without the filter's bits nothing is found
        urlfilter.bloom_blocks = blocks
        try:
            out = urlfilter.judge(pages, listed, []).where("verdict = 'block'")
            verdicts.append({r.page_id for r in out.collect()})
        finally:
            urlfilter.bloom_blocks = real
    assert verdicts == [{i for i in range(3000) if i % 3 == 0}, set()]
