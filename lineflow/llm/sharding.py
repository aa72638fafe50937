"""Sharding (operator 6): a consistent-hash ring with virtual nodes and bounded loads.

Keys and virtual nodes hash to the ``CELLS`` cells of a ring.  A key belongs
to the first node clockwise; a full shard passes what exceeds its bound on
to the next node clockwise, and so on, so no shard exceeds its bound and only
overflowing keys leave their own node.  The rows of a cell keep a fixed order
(a hash of all their keys), so "who overflows" is a cut in that order: the
driver sees only the row counts of the cells (at most ``CELLS`` numbers,
whatever the input), walks the ring once with them, and gets intervals of
places within each cell for each shard.  Rows then find their interval by
their place.

Places are counted by ranges of that order: a cell is cut into as many equal
ranges of the hash as it has ``RANGE_ROWS`` rows, each range's rows are placed in a
window of their own, and prefix sums of the ranges' counts make them places in
the cell.  So a hot id is many tasks' work.  Equal rows are counted before the
shuffle, and given out again in runs of ``RUN_ROWS`` that are dealt to tasks.
All row work is DataFrame expressions.

With ``load=1`` the bounds add up to the number of rows and differ by one, so
the shards' row counts do too.  A larger load moves fewer keys when the number
of shards changes, and lets counts differ up to that share.

Rows: rows are their key columns; repeated rows are placed one by one, null
keys as any other value.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineflow.session import scratch_root

CELLS = 1 << 14
NODES_PER_SHARD = 64
RANGE_ROWS = 50_000
RUN_ROWS = 10_000
BROADCAST_ROWS = 500_000  # of three numbers


def ring(shards: int, nodes: int = NODES_PER_SHARD) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes, clockwise."""
    places = [(zlib.crc32(f"{s}/{v}/shard".encode()), s) for s in range(shards) for v in range(nodes)]
    return [(p * CELLS >> 32, s) for p, s in sorted(places)]


def bounds(rows: int, shards: int, load: float) -> list[int]:
    if load <= 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [math.ceil(load * rows / shards)] * shards


def walk(counts: dict[int, int], shards: int, load: float = 1.0) -> list[tuple[int, int, int, int, int]]:
    """Intervals (cell, from, to, shard, first slot): places of a cell that a shard holds."""
    nodes = ring(shards)
    left = bounds(sum(counts.values()), shards, load)
    used = [0] * shards
    out: list[tuple[int, int, int, int, int]] = []
    carried: deque[tuple[int, int, int]] = deque()  # (cell, from, to) that found no room yet

    def settle(shard: int, arriving: list[tuple[int, int, int]]) -> None:
        for cell, a, b in arriving:
            take = min(left[shard], b - a)
            if take:
                out.append((cell, a, a + take, shard, used[shard]))
                left[shard] -= take
                used[shard] += take
            if a + take < b:
                carried.append((cell, a + take, b))

    cells = sorted(c for c, n in counts.items() if n)
    at = 0
    for cell, shard in nodes:
        own = []
        while at < len(cells) and cells[at] <= cell:
            own.append((cells[at], 0, counts[cells[at]]))
            at += 1
        queue = list(carried)
        carried.clear()
        settle(shard, own + queue)
    # past the last node the ring closes
    carried.extend((c, 0, counts[c]) for c in cells[at:])
    for _, shard in nodes:
        if not carried:
            break
        queue = list(carried)
        carried.clear()
        settle(shard, queue)
    return out


def assign(df: DataFrame, keys: list[str], shards: int, load: float = 1.0, hash_key: str | None = None) -> DataFrame:
    """The key columns of every row with its ``shard`` and its gapless ``slot`` in it.

    ``hash_key`` (else all keys) alone decides the ring cell where it isn't null.
    """
    place = F.xxhash64(*keys) if hash_key is None else F.when(
        F.col(hash_key).isNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(hash_key))
    rows = df.select(*keys).groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = rows.withColumn("_h", place).withColumn("_cell", F.shiftrightunsigned("_h", 50).cast("int"))
    rows = rows.withColumn("_o", F.shiftrightunsigned(F.xxhash64(*keys, F.lit("order")), 1))
    counts = {r["_cell"]: r["n"] for r in rows.groupBy("_cell").agg(F.sum("_n").alias("n")).collect()}
    spark = df.sparkSession
    plan = spark.createDataFrame(walk(counts, shards, load), "_at int, _from long, _to long, shard int, _slot long")
    large = [(c, math.ceil(math.log2(n / RANGE_ROWS))) for c, n in counts.items() if n > RANGE_ROWS]
    bits = spark.createDataFrame(large, "_cell int, _bits int")  # at most CELLS rows
    rows = rows.join(F.broadcast(bits), "_cell", "left").withColumn(
        "_range", F.expr("shiftrightunsigned(_o, 63 - coalesce(_bits, 0))"))
    ahead = Window.partitionBy("_cell").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("_cell", "_range").agg(F.sum("_n").alias("_rows")).select(
        "_cell", "_range", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_before"))
    ranges = ranges.where("_before > 0")  # the first range of a cell has none before it
    if large:
        scratch_root(spark)
        ranges = ranges.checkpoint()
        ranges = F.broadcast(ranges) if ranges.count() <= BROADCAST_ROWS else ranges
    order = Window.partitionBy("_cell", "_range").orderBy("_o", "_h", *keys)
    last = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("_place", last - F.col("_n"))
    if large:
        placed = placed.join(ranges, ["_cell", "_range"], "left").withColumn("_place", F.col("_place") + F.coalesce("_before", F.lit(0)))
    placed = placed.select(*keys, "_cell", "_place", "_n")
    many = placed.where(F.col("_n") > RUN_ROWS).withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / RUN_ROWS))))
    many = many.repartition("_cell", "_place", "_run").select(
        *keys, "_cell", (F.col("_place") + F.col("_run") * RUN_ROWS).alias("_place"),
        F.least(F.lit(RUN_ROWS), F.col("_n") - F.col("_run") * RUN_ROWS).alias("_n"))
    placed = placed.where(F.col("_n") <= RUN_ROWS).unionByName(many)
    placed = placed.withColumn("_place", F.explode(F.sequence("_place", F.col("_place") + F.col("_n") - 1)))
    # at most CELLS rows and one more for each time a shard fills up or a node is passed
    hit = (F.col("_cell") == F.col("_at")) & (F.col("_place") >= F.col("_from")) & (F.col("_place") < F.col("_to"))
    return placed.join(F.broadcast(plan), hit).select(
        *keys, "shard", (F.col("_slot") + F.col("_place") - F.col("_from")).alias("slot"))
