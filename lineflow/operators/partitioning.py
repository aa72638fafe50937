"""Parallelism of the flow (PAR-1, PAR-3).

The reference spreads records evenly only when the flow is wider than the
source.  In Spark that is a round-robin ``repartition(n)`` under the same
condition, tested against the partitions that the plan really has;
otherwise the flow runs in the source's partitions and no exchange is added
(flows are narrow, so nothing else would shuffle).

Equal numbers of records are equal work only while records are of like size.
``spread_by_bytes`` deals them by size: a histogram of the sizes (at most
``64 * STEPS`` rows, whatever the input) lays the size classes one after the
other on a line of all bytes, each record takes a place in its class's part of
that line, and a partition is an equal piece of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A scan split holds at most spark.sql.files.maxPartitionBytes (128 MB by default); cutting it
# into more than this many pieces gives tasks of under 2 MB, whose scheduling costs more than
# they save.  Raise it (``max_pieces``) for unsplittable files much larger than a split.
MAX_PIECES_PER_SPLIT = 64
STEPS = 8  # size classes for each doubling
RECORD_COST = 64  # bytes that a record counts besides its own


def scan_partitions(df: DataFrame) -> int | None:
    """The partitions of a batch plan without an exchange, counted without a job; None for other plans."""
    if df.isStreaming:
        return None
    from lineflow.session import spark_context

    if spark_context(df.sparkSession) is None:  # Spark Connect: not known before execution
        return None
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return None
    return max(1, df.rdd.getNumPartitions())


def spread(df: DataFrame, flow_parallelism: int, input_parallelism: int = 1) -> DataFrame:
    """``repartition(flow_parallelism)`` when the input is narrower than that; never fewer partitions than it has.

    The width of a scan is counted; ``input_parallelism`` is a lower bound on
    it, and stands for it where it can't be counted before the run (a stream).
    A plan that already shuffles is left to the shuffle's own width.
    """
    if flow_parallelism < 1 or input_parallelism < 1:
        raise ValueError("parallelism must be positive")
    if flow_parallelism <= input_parallelism:
        return df
    width = scan_partitions(df)
    if width is None and not df.isStreaming:
        return df
    return df.repartition(flow_parallelism) if flow_parallelism > (width or input_parallelism) else df


def spread_to_cluster(df: DataFrame, spark: SparkSession | None = None,
                      max_pieces: int = MAX_PIECES_PER_SPLIT) -> DataFrame:
    """PAR-1 with live numbers: spread when the scan is narrower than the cluster.

    The flow's parallelism is the session's default parallelism (total
    executor cores), at most ``max_pieces`` pieces per scan split.  A big
    input has far more splits than cores, so this adds no exchange at scale;
    a small or unsplittable input (one row group, one gzip file) gets spread
    so the cores share the work.
    """
    from lineflow.session import spark_context

    width = scan_partitions(df)
    sc = spark_context(spark or df.sparkSession)
    if width is None or sc is None:
        return df
    return spread(df, min(sc.defaultParallelism, width * max_pieces), 1)


def spread_by_bytes(df: DataFrame, parallelism: int, size: str | Column) -> DataFrame:
    """Deal rows to ``parallelism`` partitions of about equal bytes, ``size`` being a row's (null: none).

    One extra scan reads what ``size`` needs.  Rows of one class go to
    neighbouring partitions by a hash of their place in the scan, so repeated
    rows spread too, and a retried task deals its rows alike.
    """
    if parallelism < 1:
        raise ValueError("parallelism must be positive")
    cost = F.coalesce(F.col(size) if isinstance(size, str) else size, F.lit(0)).cast("double") + RECORD_COST
    kind = F.floor(F.log2(cost) * STEPS).cast("int")
    rows = df.select(kind.alias("kind"), cost.alias("cost")).groupBy("kind").agg(F.sum("cost").alias("cost")).orderBy("kind").collect()
    total = sum(r["cost"] for r in rows)
    if not total:
        return df
    starts, widths, at = {}, {}, 0.0
    for r in rows:
        starts[r["kind"]], widths[r["kind"]] = at / total, r["cost"] / total
        at += r["cost"]
    last = max(starts)

    def known(values: dict[int, float]) -> Column:
        return F.element_at(F.array(*(F.lit(values.get(k, 0.0)) for k in range(last + 1))), kind + 1)

    # 53 bits of a hash of the row's place, as a number from 0 to 1
    place = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 11).cast("double") / float(1 << 53)
    piece = F.least(F.floor((known(starts) + place * known(widths)) * parallelism), F.lit(parallelism - 1)).cast("int")
    return df.withColumn("__piece", piece).repartitionById(parallelism, "__piece").drop("__piece")
