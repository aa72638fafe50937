"""URL filters (operator 4): a blocked Bloom filter in front of an exact join.

The listed canonical URLs become a table of 256-bit blocks, each a key's
eight bits wide and built by ``bit_or`` aggregation; the probe is a join on
the block number.  URLs that pass it, true or false positives, go to an
exact hash join with the list, which removes the false ones.  Every step is
a DataFrame expression.  The blocks and the list are broadcast only when
their counted size is within ``BROADCAST_BYTES``; larger ones are joined by
shuffles of the URL columns, whose skewed parts Spark splits.

Rows: a null URL, or one without ``://``, has an empty host and path, fits
no rule and is on no list.  Repeated rows each get their verdict.  An empty
list blocks nothing.  Input columns of the outputs' names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
BITS_PER_KEY = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0,
                  F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def canonical(url: Column) -> Column:
    """The URL without what doesn't name another page, or null without a host.

    Dropped: scheme, ``www.``, default ports, fragment, an end ``/`` or
    ``index.html``, and the parameters that only track; the others are sorted.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/(index[.]html?)?$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*[?]([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref|fbclid|gclid)=")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The rule that fits, the longest first, as text and as verdict; null without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.host + r.path).otherwise(text)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def _bits(key: Column) -> list[Column]:
    """A key's eight bits, one in each half of four longs."""
    h = F.xxhash64(key, F.lit("bits"))
    at = [F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(8)]
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, at[2 * j]).bitwiseOR(
        F.call_function("shiftleft", one, at[2 * j + 1] + F.lit(32))) for j in range(4)]


def _sized(df: DataFrame, n_bytes: int, limit: int) -> DataFrame:
    return F.broadcast(df) if n_bytes <= limit else df


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """``_block`` and its four longs, from the distinct column ``_listed``."""
    words = [F.bit_or(w).alias(f"_w{j}") for j, w in enumerate(_bits(F.col("_listed")))]
    return listed.groupBy(F.pmod(F.xxhash64("_listed"), F.lit(blocks)).alias("_block")).agg(*words)


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], url: str = "url", list_url: str = "url",
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (the rule's, else block for a listed URL)."""
    names = listed.select(canonical(F.col(list_url)).alias("_listed")).where("_listed is not null").distinct()
    n, size = names.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_listed") + 32), F.lit(0))).first()
    blocks = max(1, -(-n * BITS_PER_KEY // 256))
    bloom = _sized(bloom_blocks(names, blocks), blocks * 64, broadcast_bytes)
    u = F.col(url).cast("string")
    # the row travels as one column, so that no name of its own can clash
    columns = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*(f"`{c}`" for c in columns)).alias("_row"), F.coalesce(host_of(u), F.lit("")).alias("host"),
                        F.coalesce(path_of(u), F.lit("")).alias("path"), canonical(u).alias("_key"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_verdict": verdict})
    # a fixed verdict needs no look-up
    open_ = rows.where("_verdict is null and _key is not null")
    block = F.pmod(F.xxhash64("_key"), F.lit(blocks))
    passed = F.lit(True)
    for j, w in enumerate(_bits(F.col("_key"))):
        passed = passed & (F.col(f"_w{j}").bitwiseAND(w) == w)
    probed = open_.withColumn("_block", block).join(bloom, "_block", "left")
    probed = probed.withColumn("_hit", F.coalesce(passed, F.lit(False))).drop("_block", *(f"_w{j}" for j in range(4)))
    exact = _sized(names, int(size), broadcast_bytes)
    hits = (probed.where("_hit").join(exact, F.col("_key") == F.col("_listed"), "left")
            .withColumn("_verdict", F.when(F.col("_listed").isNotNull(), "block").otherwise("allow")))
    out = [F.col("_row")[c].alias(c) for c in columns]
    out += [F.col("host"), F.col("path"), F.col("rule"), F.coalesce("_verdict", F.lit("allow")).alias("verdict")]
    rest = rows.where("_verdict is not null or _key is null").select(out)
    return rest.unionAll(probed.where("not _hit").select(out)).unionAll(hits.select(out))
