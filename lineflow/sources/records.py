"""Blobs to line records with provenance (SRC-4) and their combined form (MAP-2).

A line record is ``content STRING, metadata STRING, linenumber INT``:
the line, the name of the blob it came from, and its 1-based position in
that blob.  Two ways produce it:

* ``recordize``: a blob is one row (a ``wholetext`` file, or a table of
  documents); ``posexplode`` of its lines.  Narrow, works on streams, but
  one row holds a whole blob, so only for blobs well under 2 GB.
* ``read_numbered_lines``: large text files, split by Spark into blocks.
  Each line is tagged with its file, its block start and a
  ``monotonically_increasing_id``; a tiny per-block table (first id,
  count, lines before the block) is checkpointed to the shared folder,
  and joined back (broadcast only when its row count is below a checked
  bound; beyond it, by a shuffle join on the block key, which moves the
  text once and whose groups are bounded by the block size).  Both scans
  read the same splits whatever executors are live: the split layout is
  fixed in a session of its own (``fixed_layout``), and a line whose block
  is unknown or shorter than its place raises an error.  The result is a
  frame of the caller's session (``in_session``).  ``in_order`` deals it so
  that writers keep the order of blobs and lines.

Line semantics follow Spark's line reader: ``\\n``, ``\\r\\n`` and ``\\r``
end lines, a final terminator does not open an empty last line, and an
empty blob has no lines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineflow.operators.partitioning import scan_partitions
from lineflow.session import scratch_root, spark_context

LINE_BREAK = r"\r\n|\r|\n"
# One row per block of maxPartitionBytes; 1M rows of (path, 3 longs) stay
# around 100 MB, the most a broadcast should carry to every executor.
BLOCK_BROADCAST_LIMIT = 1_000_000


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(content: str | Column) -> Column:
    """The lines of a blob as ``ARRAY<STRING>``, with line-reader semantics."""
    text = _c(content)
    # A blob without CR takes Java's single-character split instead of the regex engine.
    parts = F.when(text.contains("\r"), F.split(text, LINE_BREAK)).otherwise(F.split(text, "\n"))
    ends_with_break = F.substring(text, -1, 1).isin("\n", "\r")
    return (
        F.when(text.isNull() | (F.length(text) == 0), F.array().cast("array<string>"))
        .when(ends_with_break, F.slice(parts, 1, F.size(parts) - 1))
        .otherwise(parts)
    )


def recordize(df: DataFrame, content: str | Column, name: str | Column,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of each blob row: ``keep..., metadata, content, linenumber``."""
    return df.select(*keep, _c(name).alias("metadata"),
                     F.posexplode(split_lines(content)).alias("__pos", "content")).select(
        *keep, "metadata", "content", (F.col("__pos") + 1).cast("bigint").alias("linenumber"))


def combine_metadata(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``str`` = metadata, content, linenumber joined by tabs; null shows as ``null`` (MAP-2)."""
    return df.select(*keep, F.format_string("%s\t%s\t%s", "metadata", "content", "linenumber").alias("str"))


def read_wholetext(spark: SparkSession, path: str, recursive: bool = True,
                   glob: str | None = None, streaming: bool = False, schema_options: dict | None = None) -> DataFrame:
    """Blob rows ``value, path`` from a directory, one row per file."""
    reader = spark.readStream if streaming else spark.read
    r = reader.format("text").option("wholetext", "true").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in (schema_options or {}).items():
        r = r.option(k, v)
    return r.load(path).select("value", F.col("_metadata.file_path").alias("path"))


def tag_lines(raw: DataFrame) -> DataFrame:
    """Line-mode text rows tagged for numbering: ``content, metadata, __block``."""
    return raw.select(
        F.col("value").alias("content"),
        F.col("_metadata.file_path").alias("metadata"),
        F.col("_metadata.file_block_start").alias("__block"),
    )


def fixed_layout(spark: SparkSession, min_splits: int = 1) -> SparkSession:
    """A session like ``spark`` whose file scans are cut the same way however many cores are live.

    Spark sizes and packs splits by the live cores unless the number is set.
    It is set here, to what it is now and at least ``min_splits`` (PAR-2).
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            child.conf.set(key, value)
    live = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.conf.get(
        "spark.sql.leafNodeDefaultParallelism", None)
    sc = spark_context(spark)
    if live is None:
        live = sc.defaultParallelism if sc is not None else 1
    child.conf.set("spark.sql.files.minPartitionNum", str(max(int(live), min_splits)))
    return child


def block_table(tagged: DataFrame, plan_only: bool = False) -> DataFrame:
    """``metadata, __block, __first, __n, __before``: the blocks of a scan, the ids of their lines and the lines before them.

    The text is scanned for it, and only partial counts move; the table is
    checkpointed in the shared folder, which recomputes no more than the small
    stage after the counts' shuffle.
    """
    blocks = tagged.withColumn("__id", F.monotonically_increasing_id()).groupBy("metadata", "__block").agg(
        F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("metadata").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("metadata", "__block", "__first", "__n",
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    if plan_only:
        return blocks
    scratch_root(tagged.sparkSession)
    return blocks.checkpoint(eager=True)


def in_session(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A frame of another session as one of ``spark``: its settings, views and functions apply from here on.

    A scan keeps the layout of the session it was read in.  The global view
    that hands the plan over is dropped at once.
    """
    name = f"lineflow_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}").select("*")
    finally:
        spark.catalog.dropGlobalTempView(name)


def in_order(lines: DataFrame) -> DataFrame:
    """Line records dealt to partitions by blob name and line number: partition after partition they read in that order."""
    key = ["metadata", "linenumber"]
    return lines.repartitionByRange(*key).sortWithinPartitions(*key)


def number_lines(tagged: DataFrame, broadcast_limit: int = BLOCK_BROADCAST_LIMIT, plan_only: bool = False,
                 blocks: DataFrame | None = None, leave_out: DataFrame | None = None) -> DataFrame:
    """Add 1-based ``linenumber`` to ``content, metadata, __block`` rows read straight from a scan.

    ``tagged`` must be a scan of a ``fixed_layout`` session (or a micro-batch
    of one) whose every file is whole in it: the ids of both passes come from
    re-reading the same splits.  A line that has no place in the block table
    (``blocks``, made here unless given) is an error, never dropped; lines of
    the files in ``leave_out`` (``path``) go.  ``plan_only`` leaves the table
    lazy, for a plan that is only shown: no job runs.
    """
    blocks = block_table(tagged, plan_only) if blocks is None else blocks
    if leave_out is not None:
        gone = leave_out.select(F.col("path").alias("metadata")).distinct().withColumn("__gone", F.lit(True))
        blocks = blocks.join(gone, "metadata", "left")
    else:
        blocks = blocks.withColumn("__gone", F.lit(None).cast("boolean"))
    if not plan_only and blocks.count() <= broadcast_limit:
        blocks = F.broadcast(blocks)
    place = F.col("__id") - F.col("__first")
    known = F.coalesce((place >= 0) & (place < F.col("__n")), F.lit(False))
    lost = F.raise_error(F.concat(F.lit("the split layout changed between the two scans of "), "metadata"))
    lines = tagged.withColumn("__id", F.monotonically_increasing_id()).join(blocks, ["metadata", "__block"], "left")
    return lines.where("__gone is null").select(
        "content", "metadata",
        F.when(known, place + F.col("__before") + 1).otherwise(lost.cast("bigint")).alias("linenumber"))


def read_numbered_lines(
    spark: SparkSession,
    path: str,
    recursive: bool = True,
    glob: str | None = None,
    after_marker: str | None = None,
    broadcast_limit: int = BLOCK_BROADCAST_LIMIT,
    options: dict | None = None,
    min_splits: int = 1,
    plan_only: bool = False,
    spread_to: int = 1,
) -> DataFrame:
    """Line records of every text file below ``path`` (batch), without moving the text.

    ``after_marker`` keeps files whose path sorts after the marker (POS-7);
    the predicate is on ``_metadata.file_path`` so whole files are skipped
    at listing time.  ``min_splits`` is a lower bound on the splits (PAR-2),
    as far as files can be split; numbered lines are dealt to ``spread_to``
    partitions when the scan has fewer (PAR-1).
    """
    r = fixed_layout(spark, min_splits).read.format("text").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    raw = r.load(path)
    if after_marker is not None:
        raw = raw.where(F.col("_metadata.file_path") > F.lit(after_marker))
    tagged = tag_lines(raw)
    lines = number_lines(tagged, broadcast_limit, plan_only)
    if spread_to > max(min_splits, scan_partitions(tagged) or spread_to):
        lines = lines.repartition(spread_to)
    return in_session(spark, lines)
