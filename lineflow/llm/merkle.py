"""Merkle dataset manifest (operator 11): ternary hash trees, and proofs by octopus multiproof.

The rows of a group are the leaves of a tree in a fixed order; the roots of
all groups are the leaves of one more tree, whose root names the dataset.  A
node is the SHA-256 (lower-case hex) of its children's digests one after the
other; every 3 consecutive nodes share a parent, a last run of fewer too.

* ``build`` writes the leaves, deals them to ranges of (group, order), and
  numbers them within their group by the ranges' counts.  A leaf partition is
  an aligned run of ``3 ** span`` leaves of one group; its task derives its
  top node, and the nodes above are derived from those the same way, ``span``
  levels a round.  Only nodes at the partitions' tops and above are stored.
* ``prove`` lets every leaf partition compute the least set of coordinates
  that the proofs of all its leaves need and it can't derive itself
  (``missing``), fetches those digests by one join, derives the interiors that
  its proofs share, and expands each leaf's own proof in the partition.
* ``fold`` recomputes the root from a leaf and its proof, as an expression.

No group is gathered anywhere: a hot group is many leaf partitions, and rows
that agree in group, order and leaf are told apart by their place in the scan.

Rows: null groups form a group of their own, sorted first; null orders sort
first in theirs; equal orders sort by leaf; rows equal in all take any of
their places, as their leaves are the same.  Null fields hash as ``-``, empty
texts as ``0:``, texts of any length whole.  An empty table has no leaves and
no root.  The rows' own columns travel as one, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineflow.session import new_run_dir

ARITY = 3
SPAN = 8  # levels below a leaf partition's top: 6,561 leaves
BROADCAST_ROWS = 200_000  # of about 100 bytes
NODE = "_tree string, _level int, _at long, _digest binary"
SIBLINGS = pa.struct([("left", pa.string()), ("right", pa.string())])


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``_row, _leaf, _tree, _at, _size, _rank, _trees``; ``nodes`` of the groups' trees and ``top`` of the last tree."""

    leaves: DataFrame
    nodes: DataFrame
    top: DataFrame
    span: int

    @property
    def root(self) -> DataFrame:
        """``root``: the dataset's digest; no row for an empty table."""
        return self.top.orderBy(F.desc("_level")).limit(1).select(F.lower(F.hex("_digest")).alias("root"))


def field(value: Column) -> Column:
    """A field's text in a leaf: ``-`` for null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(field(v) for v in values)), 256))


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def parents(level: list[str]) -> list[str]:
    return [_h("".join(level[i:i + ARITY])) for i in range(0, len(level), ARITY)]


def height(size: int) -> int:
    """Levels above ``size`` nodes."""
    up = 0
    while size > 1:
        size, up = -(-size // ARITY), up + 1
    return up


def missing(known: list[int], size: int, level: int = 0) -> list[tuple[int, int]]:
    """The octopus: coordinates (level, place) that the proofs of the nodes ``known`` need besides what these derive."""
    out = []
    while size > 1:
        have, runs = set(known), sorted({i // ARITY for i in known})
        out += [(level, j) for r in runs for j in range(r * ARITY, min((r + 1) * ARITY, size)) if j not in have]
        known, size, level = runs, -(-size // ARITY), level + 1
    return out


def climb(digest: str, at: int, size: int, fetched: dict[tuple[int, int], str], level: int = 0) -> tuple[list[tuple[str, str]], str]:
    """The siblings left and right of every node from ``at`` up, and the digest on top."""
    path = []
    while size > 1:
        run = at - at % ARITY
        left = "".join(fetched[level, j] for j in range(run, at))
        right = "".join(fetched[level, j] for j in range(at + 1, min(run + ARITY, size)))
        digest = _h(left + digest + right)
        path.append((left, right))
        at, size, level = at // ARITY, -(-size // ARITY), level + 1
    return path, digest


def _store(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    folder = f"{new_run_dir(spark, label)}/rows"
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their place ``_at`` in their ``_tree`` by ``order``; and the ranges' counts with ``_before`` and ``_size``.

    The order must tell rows apart: one task gets what is equal in it.
    """
    dealt = rows.repartitionByRange("_tree", *order).sortWithinPartitions("_tree", *order)
    dealt = _store(dealt.withColumn("_id", F.monotonically_increasing_id()), "merkle_rows")
    dealt = dealt.withColumn("_range", F.shiftright("_id", 33))  # the partition's number
    counts = dealt.groupBy("_tree", "_range").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("_tree")
    ahead = tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = _store(counts.select("_tree", "_range", "_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"),
                                  F.sum("_n").over(tree).alias("_size")), "merkle_counts")
    at = (F.col("_id") - F.col("_first") + F.col("_before")).alias("_at")
    keep = [c for c in rows.columns if c != "_tree"]
    return dealt.join(_bounded(counts), ["_tree", "_range"]).select("_tree", at, "_size", *keep), counts


def _tops(span: int, level: int, whole: bool):
    """Nodes that a leaf partition of ``_tree, _at, _size, _digest`` at ``level`` derives: its top, or all with ``whole``."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        first, tree = table["_at"][0].as_py(), table["_tree"][0].as_py()
        nodes = [d.hex() for d in table["_digest"].to_pylist()]
        out: list[tuple[int, int, bytes]] = []
        up = min(span, height(table["_size"][0].as_py()))
        for k in range(1, up + 1):
            nodes, first = parents(nodes), first // ARITY
            if whole or k == up:
                out += [(level + k, first + i, bytes.fromhex(d)) for i, d in enumerate(nodes)]
        if up == 0 and not whole:
            out = [(level, first, bytes.fromhex(nodes[0]))]
        levels, places, digests = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"_tree": pa.array([tree] * len(out), pa.string()), "_level": pa.array(levels, pa.int32()),
                         "_at": pa.array(places, pa.int64()), "_digest": pa.array(digests, pa.binary())})

    return run


def grow(leaves: DataFrame, largest: int, span: int, whole: bool) -> DataFrame:
    """All stored nodes over ``_tree, _at, _size, _digest``; ``largest`` is the greatest ``_size``."""
    level, items, found = 0, leaves.select("_tree", "_at", "_size", "_digest"), []
    step = ARITY ** span
    if whole:
        found.append(leaves.select("_tree", F.lit(0).alias("_level"), "_at", "_digest"))
    sizes = leaves.select("_tree", "_size").distinct() if largest > step else None
    while True:
        nodes = _store(items.groupBy("_tree", F.expr(f"_at div {step}")).applyInArrow(_tops(span, level, whole or level > 0), NODE),
                       "merkle_nodes")
        found.append(nodes)
        level, largest = level + span, -(-largest // step)
        if largest <= 1:
            break
        above = sizes.select("_tree", F.expr(f"(_size + {ARITY ** level - 1}) div {ARITY ** level}").alias("_size")).where("_size > 1")
        items = nodes.where(F.col("_level") == level).join(above, "_tree").select("_tree", "_at", "_size", "_digest")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def build(rows: DataFrame, group: str, order: str, leaf: Column, keep: dict[str, Column], span: int = SPAN) -> Manifest:
    """The manifest of ``rows``: trees of ``leaf`` (binary digests) by ``group``, ordered by ``order``; ``keep`` rides along."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("_tree")
    narrow = rows.select(tree, F.col(order).alias("_order"), leaf.alias("_leaf"),
                         F.struct(*(c.alias(k) for k, c in keep.items())).alias("_row"),
                         F.monotonically_increasing_id().alias("_tie"))
    leaves, counts = numbered(_store(narrow, "merkle_leaves"), "_order", "_leaf", "_tie")
    largest = counts.agg(F.max("_size")).first()[0] or 0
    nodes = grow(leaves.withColumnRenamed("_leaf", "_digest"), largest, span, False)
    # the root of a group is its node on its last level
    subroots = nodes.where("_at = 0").groupBy("_tree").agg(F.max(F.struct("_level", "_digest")).alias("_last"))
    subroots = subroots.select(F.lit("").alias("_tree"), F.col("_tree").alias("_name"), F.col("_last._digest").alias("_digest"))
    ranked, rank_counts = numbered(subroots, "_name")
    ranked = _store(ranked, "merkle_groups")
    trees = rank_counts.agg(F.max("_size")).first()[0] or 0
    top = grow(ranked, trees, span, True)
    names = ranked.select(F.col("_name").alias("_tree"), F.col("_at").alias("_rank"), F.col("_size").alias("_trees"))
    return Manifest(leaves.join(_bounded(names), "_tree"), nodes, top, span)


def _requests(span: int):
    """Coordinates that each leaf partition ``_tree, _part, _size, _rank, _trees`` misses; ``_top`` marks those of the last tree."""
    step = ARITY ** span

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                above = -(-p["_size"] // step)
                need = [(False, *c) for c in missing([p["_part"]], above, span)] if above > 1 else []
                need += [(True, *c) for c in missing([p["_rank"]], p["_trees"])]
                out += [{"_tree": p["_tree"], "_part": p["_part"], "_top": t, "_level": lv, "_at": at} for t, lv, at in need]
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("_tree", pa.string()), ("_part", pa.int64()), ("_top", pa.bool_()), ("_level", pa.int32()), ("_at", pa.int64())]))

    return run


def _siblings(level: list[str]) -> tuple[list[str], list[str]]:
    left, right = [], []
    for p in range(len(level)):
        run = p - p % ARITY
        left.append("".join(level[run:p]))
        right.append("".join(level[p + 1:run + ARITY]))
    return left, right


def _expand(span: int):
    """Rows of a leaf partition with the proofs of its leaves, from the nodes it fetched."""
    step = ARITY ** span

    def run(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        if leaves.num_rows == 0:
            raise RuntimeError("nodes were fetched for a leaf partition that isn't there")
        leaves = leaves.sort_by("_at")
        size, rank, trees = (leaves[c][0].as_py() for c in ("_size", "_rank", "_trees"))
        part = leaves["_at"][0].as_py() // step
        own: dict[bool, dict[tuple[int, int], str]] = {False: {}, True: {}}
        for f in fetched.to_pylist():
            own[f["_top"]][f["_level"], f["_at"]] = f["_digest"].hex()
        nodes = [d.hex() for d in leaves["_leaf"].to_pylist()]
        n, up = len(nodes), min(span, height(size))
        lefts, rights, index, at = [], [], [], 0
        places = np.arange(n)
        for _ in range(up):
            left, right = _siblings(nodes)
            lefts += left
            rights += right
            index.append(at + places)
            at, places, nodes = at + len(left), places // ARITY, parents(nodes)
        path, subroot = climb(nodes[0], part, -(-size // ARITY ** up), own[False], up)
        more, root = climb(subroot, rank, trees, own[True])
        for left, right in path + more:  # shared by all leaves of the partition
            lefts.append(left)
            rights.append(right)
            index.append(np.full(n, at))
            at += 1
        flat = pa.array(np.stack(index, axis=1).ravel() if index else np.empty(0, np.int64))
        pairs = pa.StructArray.from_arrays([pa.array(lefts, pa.string()).take(flat), pa.array(rights, pa.string()).take(flat)],
                                           fields=list(SIBLINGS))
        proof = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(index)), pairs)
        return pa.table({"_row": leaves["_row"], "_leaf": leaves["_leaf"], "_subroot": pa.array([bytes.fromhex(subroot)] * n),
                         "_root": pa.array([bytes.fromhex(root)] * n), "_proof": proof})

    return run


def prove(manifest: Manifest) -> DataFrame:
    """``_row, _leaf, _subroot, _root, _proof``: of every leaf its siblings left and right, from its own level up to the root."""
    step = ARITY ** manifest.span
    leaves = manifest.leaves.withColumn("_part", F.expr(f"_at div {step}"))
    parts = leaves.where(f"_at % {step} = 0").select("_tree", "_part", "_size", "_rank", "_trees")
    asked = parts.mapInArrow(_requests(manifest.span), "_tree string, _part long, _top boolean, _level int, _at long")
    nodes = manifest.nodes.select(F.lit(False).alias("_top"), F.col("_tree").alias("_of"), "_level", "_at", "_digest").unionAll(
        manifest.top.select(F.lit(True).alias("_top"), F.col("_tree").alias("_of"), "_level", "_at", "_digest"))
    of = F.when(F.col("_top"), F.lit("")).otherwise(F.col("_tree")).alias("_of")
    fetched = asked.select("_tree", "_part", "_top", of, "_level", "_at").join(nodes, ["_top", "_of", "_level", "_at"])
    fetched = fetched.select("_tree", "_part", "_top", "_level", "_at", "_digest")
    out = "_row " + leaves.schema["_row"].dataType.simpleString()
    out += ", _leaf binary, _subroot binary, _root binary, _proof array<struct<left: string, right: string>>"
    return leaves.groupBy("_tree", "_part").cogroup(fetched.groupBy("_tree", "_part")).applyInArrow(_expand(manifest.span), out)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (binary) and its proof lead to."""
    return F.aggregate(proof, F.lower(F.hex(leaf)), lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)
