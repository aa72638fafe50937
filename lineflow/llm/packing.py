"""Best-fit packing (operator 12): whole documents into sequences by the sum-of-squares rule.

``cut`` encodes documents, adds the end id and cuts only those longer than a
sequence, from their end: the first piece may be shorter, the others are full.
``pack`` gives every piece a sequence and its place in it:

* A task takes its rows in windows of ``WINDOW``, longest pieces first.  Each
  goes to that open sequence which makes the sum, over all gaps, of the
  squared numbers of sequences with that gap smallest (of equal ones the
  smallest gap).  A sequence is opened when no open one has room.
* What tasks leave open is packed again as if it were pieces: the open
  sequences that could take any other are dealt to windows until one window
  holds them all, or merging no longer helps.  Rows then take their
  sequence's new number and shift by a join.

No text or id moves between tasks, only numbers of open sequences.  A window
bounds a task's memory whatever the size or skew of its input; a hot document
id or a group of copies is rows like others.

Rows: null and empty texts are the end id alone; texts of any length are
encoded whole; repeated rows are packed one by one; an empty table has no
pieces.  Other columns ride along; input columns of the outputs' names are
replaced (``piece``, ``start``, ``length``, ``ids_crc32``, ``ids``;
``sequence_id``, ``offset``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lineflow.llm import bpe
from lineflow.llm.textops import text_slices
from lineflow.session import new_run_dir

WINDOW = 1 << 17  # pieces, some 40 bytes each
BROADCAST_ROWS = 500_000  # of 32 bytes
LEAST_GAIN = 0.1  # share of open sequences that a round must save for another one


def cut_ids(flat: np.ndarray, offsets: np.ndarray, end_id: int, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All ids with the end ids; and of every piece its document, number, start and length."""
    ids = np.insert(flat, offsets[1:], end_id).astype("<i4")
    sizes = np.diff(offsets) + 1
    n = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = sizes - (n - 1) * capacity
    start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
    length = np.where(piece == 0, first[doc], capacity)
    return ids, doc, piece, start, length


def cut(df: DataFrame, path: str, end_id: int, capacity: int, text: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per piece: the document's other columns, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    tables = bpe._tables(df.sparkSession, path)
    new = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = {"piece": IntegerType(), "ids": ArrayType(IntegerType())}
    names = [c for c in df.columns if c not in (text, *new)]
    schema = StructType([df.schema[c] for c in names] + [StructField(c, kinds.get(c, LongType())) for c in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables.value
        for batch in batches:
            for part in text_slices(batch, text):
                flat, offsets = bpe.encode_texts(t, ["" if x is None else x for x in part.column(text).to_pylist()])
                ids, doc, piece, start, length = cut_ids(flat, offsets, end_id, capacity)
                ends = np.cumsum(length)
                raw = memoryview(ids).cast("B")
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist(), strict=True)]
                out = [part.column(c).take(pa.array(doc)) for c in names]
                out += [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(out, names=[*names, *new])

    return df.mapInArrow(run, schema)


def place(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of every item, longest placed first; and what each sequence holds in the end."""
    n = len(sizes)
    bins, offsets = np.empty(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    full = order[sizes[order] >= capacity]
    bins[full] = np.arange(len(full))
    used = len(full)
    gaps = [capacity - int(s) for s in sizes[full]]
    # sequences by gap; a filled one counts for nothing, which -0.5 does in the difference below
    count = np.zeros(capacity + 1)
    count[0] = -0.5
    having: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in order[len(full):].tolist():
        size = int(sizes[i])
        here = count[size:capacity]
        # half of the change of the sum of squares, less one: gap g loses a sequence, g - size gains one
        change = np.where(here > 0, count[:capacity - size] - here, np.inf)
        at = int(change.argmin()) if len(change) else 0
        if len(change) and change[at] < np.inf:
            gap = at + size
            own = having[gap].pop()
            count[gap] -= 1
        else:
            gap, own, used = capacity, used, used + 1
            gaps.append(capacity)
        bins[i], offsets[i] = own, capacity - gap
        gaps[own] = gap - size
        if gap > size:
            having[gap - size].append(own)
            count[gap - size] += 1
    return bins, offsets, capacity - np.array(gaps, np.int64)


def _windows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        while n + batch.num_rows >= rows:
            held.append(batch.slice(0, rows - n))
            yield pa.Table.from_batches(held)
            batch, held, n = batch.slice(rows - n), [], 0
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _placed(size: str, capacity: int, window: int, level: int):
    """Rows of each window with ``_seq`` (unique in this level), ``_off`` and ``_fill`` of their sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (TaskContext.get().partitionId() << 36) + (level << 60)
        for table in _windows(batches, window):
            bins, offsets, fill = place(table[size].to_numpy(), capacity)
            out = table.append_column("_seq", pa.array(bins + base)).append_column("_off", pa.array(offsets))
            yield from out.append_column("_fill", pa.array(fill[bins])).to_batches(max_chunksize=1 << 14)
            base += len(fill)

    return run


def _stored(df: DataFrame, label: str) -> DataFrame:
    folder = f"{new_run_dir(df.sparkSession, label)}/rows"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def pack(pieces: DataFrame, capacity: int, size: str = "length", window: int = WINDOW) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sizes are 1 to ``capacity``."""
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    added = "_seq long, _off long, _fill long"
    rows = _stored(pieces.select(F.struct(*(f"`{c}`" for c in names)).alias("_row"), F.col(size).cast("long").alias("_size"))
                   .mapInArrow(_placed("_size", capacity, window, 0), f"_row {pieces.select(*names).schema.simpleString()}, _size long, {added}"),
                   "packed")
    # each sequence has one row at offset 0
    opened = rows.where("_off = 0").select(F.col("_seq").alias("_bin"), F.col("_fill").alias("_size"))
    least = opened.agg(F.min("_size")).first()[0]
    moves, level = None, 0
    while least is not None:
        opened = opened.where(F.col("_size") <= capacity - least)
        n = opened.count()
        if n < 2:
            break
        level += 1
        parts = -(-n // window)
        dealt = opened.coalesce(1) if parts == 1 else opened.repartition(parts, F.xxhash64("_bin", F.lit(level)))
        moved = _stored(dealt.mapInArrow(_placed("_size", capacity, window, level), f"_bin long, _size long, {added}"), "merged")
        step = moved.select(F.col("_bin").alias("_was"), "_seq", "_off")
        if moves is None:
            moves = step.select(F.col("_was").alias("_bin"), F.col("_seq").alias("_to"), F.col("_off").alias("_shift"))
        else:
            later = step.select(F.col("_was").alias("_to"), F.col("_seq").alias("_then"), F.col("_off").alias("_more"))
            moves = moves.join(later, "_to", "left").select(
                "_bin", F.coalesce("_then", "_to").alias("_to"), (F.col("_shift") + F.coalesce("_more", F.lit(0))).alias("_shift"))
        opened = moved.where("_off = 0").select(F.col("_seq").alias("_bin"), F.col("_fill").alias("_size"))
        if parts == 1 or opened.count() > n * (1 - LEAST_GAIN):
            break
    out = [F.col("_row")[c].alias(c) for c in names]
    if moves is None:
        return rows.select(*out, F.col("_seq").alias("sequence_id"), F.col("_off").alias("offset"))
    moves = _stored(moves, "moves")
    moves = F.broadcast(moves) if moves.count() <= BROADCAST_ROWS else moves
    rows = rows.join(moves, rows["_seq"] == moves["_bin"], "left")
    return rows.select(*out, F.coalesce("_to", "_seq").alias("sequence_id"), (F.col("_off") + F.coalesce("_shift", F.lit(0))).alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of packed pieces that carry their ``ids``: the training sequences."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most one piece an id: bounded by the capacity
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
