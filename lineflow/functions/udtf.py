"""User-defined table functions (MAP-12, UDF-1).

``prime_factors(n)`` yields the prime factors of ``n`` with multiplicity,
one row each: 12 gives 2, 2, 3 and a prime gives itself (the documented
example gives nothing for 19; standard factorisation is used here, D14).
``with_prime_factors`` runs it as an Arrow table function over whole record
batches: trial division, primality and the search for larger factors are array
operations over all numbers of a batch that still need them (``factor_batch``).
Each row is independent, so the work spreads over whatever partitions the
input has; no exchange is added.  Spark has no lateral join with Arrow table
functions, so the function that SQL calls as ``LATERAL prime_factors(n)`` once
registered works number by number (``factorize``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udtf, udtf
from pyspark.sql.types import LongType, StructField, StructType

UDTF_NAME = "prime_factors"


SMALL_PRIMES = 1000  # trial division goes up to here; larger factors are found by cycles
# These bases decide primality for every number below 2^64.
WITNESSES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that are exact for 64-bit numbers."""
    if n < 2:
        return False
    for p in WITNESSES:
        if n % p == 0:
            return n == p
    odd = n - 1
    twos = (odd & -odd).bit_length() - 1
    odd >>= twos
    for a in WITNESSES:
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def split_composite(n: int) -> int:
    """A proper factor of an odd composite: Pollard's cycle search, about the fourth root of ``n`` steps."""
    root = math.isqrt(n)
    if root * root == n:
        return root
    for c in range(1, n):
        slow = fast = 2
        found = 1
        while found == 1:
            slow = (slow * slow + c) % n
            fast = (fast * fast + c) % n
            fast = (fast * fast + c) % n
            found = math.gcd(abs(slow - fast), n)
        if found != n:
            return found
    raise ArithmeticError(f"no factor found for {n}")


def factorize(n: int | None) -> Iterator[int]:
    """Prime factors of a 64-bit ``n`` in ascending order; nothing for n < 2 or null."""
    if n is None or n < 2:
        return
    n = int(n)
    for p in (2, *range(3, SMALL_PRIMES, 2)):
        if p * p > n:
            break
        while n % p == 0:
            yield p
            n //= p
    rest, primes = [n] if n > 1 else [], []
    while rest:
        m = rest.pop()
        if m < SMALL_PRIMES * SMALL_PRIMES or is_prime(m):
            primes.append(m)
        else:
            part = split_composite(m)
            rest += [part, m // part]
    yield from sorted(primes)


# Quotients of 62-bit numbers are off by one at most where long doubles carry 64 bits.
EXACT_BELOW = np.uint64(1 << 62 if np.finfo(np.longdouble).nmant >= 63 else 0)


def times_mod(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``a * b % n`` for 0 <= a, b < n < 2^63."""
    if n.size and int(n.max()) < 1 << 31:
        return a * b % n
    if n.size and n.max() < EXACT_BELOW:
        quotient = (a.astype(np.longdouble) * b / n).astype(np.uint64)
        rest = (a * b - quotient * n).view(np.int64)  # wraps to the small difference
        m = n.view(np.int64)
        rest = np.where(rest < 0, rest + m, rest)
        return np.where(rest >= m, rest - m, rest).view(np.uint64)
    out = np.zeros(len(n), np.uint64)
    for bit in range(62, -1, -1):  # double and add; sums stay below 2^64
        out <<= np.uint64(1)
        out = np.where(out >= n, out - n, out)
        out += np.where(b >> np.uint64(bit) & np.uint64(1), a, np.uint64(0))
        out = np.where(out >= n, out - n, out)
    return out


def power_mod(base: np.ndarray, exponent: np.ndarray, n: np.ndarray) -> np.ndarray:
    out, base, left = np.ones(len(n), np.uint64), base % n, exponent.copy()
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        if odd.any():
            out[odd] = times_mod(out[odd], base[odd], n[odd])
        left >>= np.uint64(1)
        base = times_mod(base, base, n)
    return out


def are_prime(n: np.ndarray) -> np.ndarray:
    """Miller-Rabin over a whole array of odd numbers above ``SMALL_PRIMES``, with the bases that are exact below 2^64."""
    odd, twos = n - np.uint64(1), np.zeros(len(n), np.int64)
    while True:
        even = (odd & np.uint64(1)) == 0
        if not even.any():
            break
        odd[even] >>= np.uint64(1)
        twos[even] += 1
    prime = np.ones(len(n), bool)
    for w in WITNESSES:
        live = np.flatnonzero(prime)
        x = power_mod(np.full(len(live), w, np.uint64), odd[live], n[live])
        passed = (x == 1) | (x == n[live] - np.uint64(1))
        for step in range(1, int(twos[live].max(initial=0))):
            x = times_mod(x, x, n[live])
            passed |= (x == n[live] - np.uint64(1)) & (step < twos[live])
        prime[live[~passed]] = False
    return prime


def split_composites(n: np.ndarray) -> np.ndarray:
    """A proper factor of each odd composite, by cycle searches that run for all of them at once."""
    found = np.zeros(len(n), np.uint64)
    root = np.sqrt(n.astype(np.float64)).astype(np.uint64)
    for near in (root - np.uint64(1), root, root + np.uint64(1)):
        square = near * near == n
        found[square] = near[square]
    shift = 1
    while (left := np.flatnonzero(found == 0)).size:
        m, c = n[left], np.uint64(shift)
        slow, fast = np.full(len(left), 2, np.uint64), np.full(len(left), 2, np.uint64)
        while left.size:
            slow = (times_mod(slow, slow, m) + c) % m
            fast = (times_mod(fast, fast, m) + c) % m
            fast = (times_mod(fast, fast, m) + c) % m
            common = np.gcd(np.where(slow > fast, slow - fast, fast - slow), m)
            hit = common != 1
            proper = hit & (common != m)
            found[left[proper]] = common[proper]
            left, m, slow, fast = left[~hit], m[~hit], slow[~hit], fast[~hit]  # a whole cycle without one: the next shift
        shift += 1
    return found


def factor_batch(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and prime factors of an array of 64-bit numbers, by row and then by size; nothing for those under 2."""
    n = np.where(numbers > 1, numbers, 1).astype(np.uint64)
    rows: list[np.ndarray] = []
    factors: list[np.ndarray] = []

    def add(at: np.ndarray, p: np.ndarray | int) -> None:
        rows.append(at)
        factors.append(np.broadcast_to(np.asarray(p, np.uint64), at.shape))

    largest = int(n.max(initial=1))
    for p in (2, *range(3, SMALL_PRIMES, 2)):
        if p * p > largest:
            break
        at = np.flatnonzero(n % np.uint64(p) == 0)
        while at.size:
            add(at, p)
            n[at] //= np.uint64(p)
            at = at[n[at] % np.uint64(p) == 0]
    at = np.flatnonzero(n > 1)
    values = n[at]
    while at.size:
        sure = values < SMALL_PRIMES * SMALL_PRIMES
        unsure = np.flatnonzero(~sure)
        sure[unsure] = are_prime(values[unsure])
        add(at[sure], values[sure])
        at, values = at[~sure], values[~sure]
        if at.size:
            part = split_composites(values)
            at, values = np.concatenate([at, at]), np.concatenate([part, values // part])
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    row, factor = np.concatenate(rows), np.concatenate(factors).astype(np.int64)
    order = np.lexsort((factor, row))
    return row[order], factor[order]


@udtf(returnType="factor: bigint", useArrow=True)
class PrimeFactors:
    def eval(self, n: int | None):
        for p in factorize(n):
            yield (p,)


def register_udtfs(spark: SparkSession) -> None:
    """Make ``prime_factors`` callable from SQL (``LATERAL prime_factors(col)``)."""
    from lineflow.session import ship_package

    ship_package(spark)
    spark.udtf.register(UDTF_NAME, PrimeFactors)


def with_prime_factors(df: DataFrame, n: str | Column, keep: list[str]) -> DataFrame:
    """``keep`` columns plus one ``factor`` row per prime factor of ``n``."""
    from lineflow.session import ship_package

    ship_package(df.sparkSession)
    arg = F.col(n) if isinstance(n, str) else n
    rows = df.select(arg.cast("bigint").alias("__n"), F.struct(*keep).alias("__row"))
    kind = StructType([StructField("row", rows.schema["__row"].dataType), StructField("factor", LongType())])

    class FactorBatches:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            at, factor = factor_batch(batch.column("__n").fill_null(0).to_numpy())
            yield pa.table({"row": batch.column("__row").take(pa.array(at)), "factor": pa.array(factor)})

    found = arrow_udtf(returnType=kind)(FactorBatches)(rows.asTable())
    return found.select(*(F.col("row")[c].alias(c) for c in keep), "factor")
