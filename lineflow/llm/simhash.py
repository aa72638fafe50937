"""Document fingerprints (operator 8): SimHash, and search by block tables.

A text's terms are its pairs of neighbouring words (a text of one word has that
one).  Each term's 64-bit hash votes on every bit with the term's weight, the
number of its occurrences: one row per occurrence is made inside the scan and
summed at once.  The sums keep two bits to a long, 32 counts to a row, and are
partial before the shuffle.

The search cuts a fingerprint into blocks, each with a radius of its own.  The
block radii plus one each add up to the radius plus one, so two fingerprints
within the radius are within the block radius in at least one block.  Each
block is a table keyed by its bits; a query looks up its own bits and all
within the block radius, which finds all pairs.  A pair is tested in the first
block in which it is near, hence found once.  Both sides are distinct
fingerprints: copies are counted, not joined.  Fewer blocks are wider keys, met
by fewer fingerprints but looked up more often: the number of blocks follows
the number of fingerprints (``block_count``), so that look-ups and
fingerprints met, together, grow more slowly than the table.

``RADIUS`` covers near copies, which are those of a Jaccard similarity of 0.8
over shingles of five words.  It is no bound: of 962 such pairs of different
texts (found by brute force among 22,000 texts, from shingles in up to 60
texts) 96.5 % are within 8 bits, and 91.7 % within 7; shingles of five words as
terms would need 12 bits for that.  Unrelated texts are 32 bits apart on average.

Rows: null texts count as empty; all texts without words share one
fingerprint.  Texts of any length are read whole.  A bit whose votes tie is 0.
All steps are DataFrame expressions.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 2
RADIUS = 8
MOST_BLOCKS = 3  # keys of 21 bits; tables above some 100 million fingerprints take two blocks
ROWS_PER_BUCKET = 2000
MAX_BUCKETS = 4096
_LANES = 0x0000000100000001


def _long(v: int) -> Column:
    return F.lit(v - (1 << 64) if v >> 63 else v).cast("long")


def fingerprints(df: DataFrame, keys: list[str], text: str, words: int = WORDS) -> DataFrame:
    """One row per distinct ``keys`` (which identify a text) with its ``fingerprint`` as a long; other columns go."""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    hashed = df.select(*keys, F.transform(tokens, lambda w: F.xxhash64(w)).alias("_h"))
    at = F.sequence(F.lit(0), F.greatest(F.size("_h") - words, F.lit(0)))
    rows = hashed.select(*keys, "_h", F.explode(at).alias("_i"))
    term = F.xxhash64(*[F.get("_h", F.col("_i") + k) for k in range(words)])
    rows = rows.select(*keys, term.alias("_term"))
    votes = rows.groupBy(*keys).agg(F.count("*").alias("_n"), *[
        F.sum(F.shiftrightunsigned("_term", b).bitwiseAND(_long(_LANES))).alias(f"_v{b}") for b in range(32)])
    bits = F.lit(0).cast("long")
    for b in range(32):
        low = F.col(f"_v{b}").bitwiseAND(_long(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_v{b}", 32)
        bits = bits.bitwiseOR(F.when(low * 2 > F.col("_n"), _long(1 << b)).otherwise(_long(0)))
        bits = bits.bitwiseOR(F.when(high * 2 > F.col("_n"), _long(1 << (b + 32))).otherwise(_long(0)))
    return votes.select(*keys, bits.alias("fingerprint"))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def block_radii(radius: int, blocks: int) -> list[tuple[int, int]]:
    """The bits of each block and the radius it is searched with; blocks that need no search are left out."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    each, more = divmod(radius + 1, blocks)
    radii = [each - (i < blocks - more) for i in range(blocks)]
    return [(m, r) for m, r in zip(parts, radii, strict=True) if r >= 0]


def block_count(radius: int, fingerprints: int) -> int:
    """How many blocks make the look-ups of a query, and the fingerprints they meet, fewest."""
    def work(blocks: int) -> float:
        looked, met = 0, 0.0
        for mask, r in block_radii(radius, blocks):
            bits = mask.bit_count()
            keys = sum(comb(bits, k) for k in range(r + 1))
            looked, met = looked + keys, met + keys / 2.0 ** bits
        return looked + met * fingerprints

    return min(range(2, MOST_BLOCKS + 1), key=work)


def _flips(mask: int, radius: int) -> list[int]:
    """All choices of up to ``radius`` bits of the mask."""
    bits = [1 << b for b in range(64) if mask >> b & 1]
    return [sum(c) for n in range(radius + 1) for c in combinations(bits, n)]


def within(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """All pairs ``query, fingerprint, distance`` within the radius, of the distinct values of the two ``fingerprint`` columns.

    The table's rows are counted for the number of blocks, unless it is given.
    """
    parts = block_radii(radius, blocks or block_count(radius, fingerprints.count()))

    def signed(v: int) -> int:
        return v - (1 << 64) if v >> 63 else v

    def distinct(df: DataFrame, name: str) -> DataFrame:
        return df.where("fingerprint is not null").select(F.col("fingerprint").alias(name)).distinct()

    flips = queries.sparkSession.createDataFrame(
        [(t, signed(m), signed(f)) for t, (m, r) in enumerate(parts) for f in _flips(m, r)], "_t int, _m long, _f long")
    asked = distinct(queries, "query").crossJoin(F.broadcast(flips)).select(
        "query", "_t", F.col("query").bitwiseAND(F.col("_m")).bitwiseXOR(F.col("_f")).alias("_k"))
    f = F.col("fingerprint")
    keyed = F.array(*[F.struct(F.lit(t).alias("t"), f.bitwiseAND(_long(m)).alias("k")) for t, (m, _) in enumerate(parts)])
    table = distinct(fingerprints, "fingerprint").select(f, F.explode(keyed).alias("_b")).select(
        f, F.col("_b.t").alias("_t"), F.col("_b.k").alias("_k"))

    differ = F.col("query").bitwiseXOR(f)
    first = F.lit(None).cast("int")
    for t, (m, r) in reversed(list(enumerate(parts))):
        first = F.when(F.bit_count(differ.bitwiseAND(_long(m))) <= r, t).otherwise(first)
    pairs = asked.join(table, ["_t", "_k"])
    return (pairs.where((F.bit_count(differ) <= radius) & (first == F.col("_t")))
            .select("query", "fingerprint", F.bit_count(differ).alias("distance")))


def with_next(docs: DataFrame, order: str, text: str) -> DataFrame:
    """``_bucket, _place, _halo, order, text, _next``: every row with the text of the next one, by ``order``.

    After the last row comes the first.  Rows with a null ``order`` have no
    next text (the empty one).  Buckets are ranges of ``order`` with about
    ``ROWS_PER_BUCKET`` rows (at most ``MAX_BUCKETS`` buckets); the first row of
    each is also put at the end of the one before, as a ``_halo`` row.
    """
    rows = docs.select(F.col(order), F.coalesce(F.col(text), F.lit("")).alias(text))
    n, least = docs.agg(F.count(order), F.min(order)).first()
    if not n:
        return rows.select(F.lit(-1).alias("_bucket"), F.monotonically_increasing_id().alias("_place"), F.lit(False).alias("_halo"),
                           order, text, F.lit("").alias("_next"))
    buckets = min(MAX_BUCKETS, max(1, n // ROWS_PER_BUCKET))
    cuts = docs.agg(F.percentile_approx(order, [i / buckets for i in range(1, buckets)] or [0.5], 20 * MAX_BUCKETS)).first()[0]
    starts = sorted({least, *(cuts if buckets > 1 else [])})
    bounds = F.array(*[F.lit(s).cast("long") for s in starts])
    bucket = F.size(F.filter(bounds, lambda b: b <= F.col(order))) - 1
    last = len(starts) - 1

    def copy(b: Column, halo: bool) -> Column:
        return F.struct(b.alias("_bucket"), F.lit(halo).alias("_halo"))

    opens = F.array_contains(bounds, F.col(order))
    before = F.when(bucket == 0, F.lit(last)).otherwise(bucket - 1)
    copies = F.when(opens, F.array(copy(bucket, False), copy(before, True))).otherwise(F.array(copy(bucket, False)))
    placed = rows.where(F.col(order).isNotNull()).select(order, text, F.explode(copies).alias("_c")).select("_c.*", order, text)
    # the halo of the last bucket is the first row of all
    key = [F.col("_halo") & (F.col("_bucket") == last), F.col(order), F.xxhash64(text), F.xxhash64(F.col(text), F.lit(1)), F.col("_halo")]
    by = Window.partitionBy("_bucket").orderBy(*key)
    out = placed.withColumns({"_place": F.row_number().over(by).cast("long"), "_next": F.coalesce(F.lead(text).over(by), F.lit(""))})
    # of the halo rows only the first of a bucket is a next row; more than one comes from repeated order values
    lone = rows.where(F.col(order).isNull()).select(
        F.lit(-1).alias("_bucket"), F.monotonically_increasing_id().alias("_place"), F.lit(False).alias("_halo"),
        order, text, F.lit("").alias("_next"))
    return out.select("_bucket", "_place", "_halo", order, text, "_next").unionAll(lone)


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by the first as many characters of the following one."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))
