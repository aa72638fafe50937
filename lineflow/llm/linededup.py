"""Line dedup (operator 5): removal of lines that are spread over many sites.

Every line hash gets a HyperLogLog sketch of the sites it occurs on; sketches
merge in the aggregation.  A line whose estimate is clear of ``min_sites`` by
the sketch's error is decided by it, the others get exact distinct counts.
Texts then lose their boilerplate lines, whatever their share of the text.  A
text that is copied as a whole counts for one site only, the first it is on:
syndication alone makes no line boilerplate, and document deduplication finds
its copies whole.  The work is DataFrame expressions: lines are joined by their
128-bit hash, distinct pairs of line and site are made before they meet the
near-threshold lines, and one row per distinct text and boilerplate line meets
the text again, so a hot line or a group of copies is aggregated before it is
joined.

A line is compared without the blanks, tabs and returns around it; lines that
are empty then are never boilerplate.

Rows: null texts stay null and have no lines; a null site counts as a site of
its own.  Texts of any length and repeated rows are treated alike (every row
of a text loses the same lines).  Input columns of the outputs' names
(``n_lines``, ``n_removed``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.session import scratch_root

MIN_SITES = 8
BROADCAST_ROWS = 1_000_000  # of hashes, some 40 bytes each
LOG_REGISTERS = 10
ERROR = 5 * 1.04 / 2 ** (LOG_REGISTERS / 2)  # five standard errors


def _hashes(c: Column, name: str) -> list[Column]:
    return [F.xxhash64(c).alias(f"{name}1"), F.xxhash64(c, F.lit(name)).alias(f"{name}2")]


def _lines(docs: DataFrame, text: str, *more: Column) -> DataFrame:
    """One row per non-empty line: its hash ``_l1, _l2`` and place, and the columns ``more``."""
    split = F.posexplode(F.split(F.col(text), "\n")).alias("_pos", "_line")
    key = F.btrim(F.col("_line"), F.lit(" \t\r"))
    return (docs.select(*more, split).where(key != "")
            .select("*", *_hashes(key, "_l")).drop("_line"))


def _site(site: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("_site")


def _few(df: DataFrame) -> DataFrame:
    """A checkpointed frame, broadcast in joins while it is small."""
    df = df.checkpoint()
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def boilerplate_lines(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The hashes ``_l1, _l2`` of lines on at least ``min_sites`` distinct sites, each text counting for its first one."""
    scratch_root(docs.sparkSession)
    own = _hashes(F.col(text), "_t")
    copied = docs.where(F.col(text) != "").select(*own, _site(site)).groupBy("_t1", "_t2").agg(
        F.min("_site").alias("_one"), F.max("_site").alias("_last")).where("_one != _last").drop("_last")
    lines = _lines(docs, text, *own, _site(site)).join(_few(copied), ["_t1", "_t2"], "left")
    lines = lines.select("_l1", "_l2", F.coalesce("_one", "_site").alias("_site"))
    spread = lines.groupBy("_l1", "_l2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LOG_REGISTERS))).alias("_n"))
    sure = spread.where(F.col("_n") > min_sites * (1 + ERROR)).select("_l1", "_l2")
    near = spread.where(F.col("_n").between(min_sites * (1 - ERROR), min_sites * (1 + ERROR))).select("_l1", "_l2")
    exact = (lines.distinct().join(_few(near), ["_l1", "_l2"], "left_semi").groupBy("_l1", "_l2")
             .agg(F.count("*").alias("_n")).where(F.col("_n") >= min_sites).select("_l1", "_l2"))
    return sure.unionAll(exact)


def _without(lines: Column, places: Column) -> Column:
    """The array without its elements at the sorted 0-based ``places``: the pieces between them, in order."""
    before = F.concat(F.array(F.lit(-1)), places)
    until = F.concat(places, F.array(F.size(lines)))
    pieces = F.zip_with(before, until, lambda a, b: F.slice(lines, a + 2, b - a - 1))
    return F.flatten(pieces)


def remove_boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and ``n_lines`` and ``n_removed`` added."""
    listed = _few(boilerplate_lines(docs, text, site, min_sites))  # broadcast, so that no task gathers a common line
    own = _hashes(F.col(text), "_t")
    found = _lines(docs, text, *own).join(listed, ["_l1", "_l2"], "left_semi")
    cut = found.groupBy("_t1", "_t2").agg(F.array_sort(F.collect_set("_pos")).alias("_places"))
    # the row travels as one column, so that no name of its own can clash
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(F.struct(*(f"`{c}`" for c in names)).alias("_row"), *own).join(cut, ["_t1", "_t2"], "left")
    old = F.col("_row")[text]
    lines = F.split(old, "\n")
    goes = F.col("_places").isNotNull()
    n_lines = F.when(F.coalesce(old, F.lit("")) == "", 0).otherwise(F.size(lines))
    new = F.when(goes, F.array_join(_without(lines, F.col("_places")), "\n")).otherwise(old)
    return rows.select(*(new.alias(c) if c == text else F.col("_row")[c].alias(c) for c in names),
                       n_lines.cast("long").alias("n_lines"),
                       F.when(goes, F.size("_places")).otherwise(0).cast("long").alias("n_removed"))
