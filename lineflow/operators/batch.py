"""Python record functions as a table step over Arrow batches (UDF-1, MAP-14).

For per-record code that Catalyst cannot express.  The function sees one
record and returns None, one output, or an iterable of outputs.  A record
that the flow has parsed (``from_json``: a variant or a struct) reaches it as
a dict (or list, number, ...); a dict or list that it returns is one output,
written as a JSON line.  It runs through ``mapInArrow``: Spark partitions the
data, ships Arrow batches to the Python worker, and the per-input array of
records comes back in the same row, so provenance columns ride along
untouched.  Batches are Arrow's; the function itself is called once a record.

An exception fails the task.  With ``suppress_errors`` a record that raises
gives no output (any partial output is discarded) and the flow goes on
(MAP-14).  Where the flow is run for its dead letters (``operators.failures``)
the record, the step and the reason go into the array column ``FAILED`` of
its row; each task prints its first few failures to standard error anyway.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lineflow.plans.flow import Step

RecordFn = Callable[[Any], Any]
LOGGED_ERRORS = 3
FAILED = "__failed"
FAILED_TYPE = "array<struct<step: string, record: string, reason: string>>"


def frame_schema(schema: StructType, frame: str) -> StructType:
    """The input schema with ``frame`` as ``ARRAY<STRING>``."""
    return StructType([
        StructField(f.name, ArrayType(StringType(), True), True) if f.name == frame else f for f in schema.fields
    ])


def text_frames(df: DataFrame, frame: str) -> tuple[DataFrame, bool]:
    """The frame as ``ARRAY<STRING>``; True when its records were parsed ones, now as JSON."""
    element = df.schema[frame].dataType
    element = element.elementType if isinstance(element, ArrayType) else None
    if element is None or isinstance(element, StringType):
        return df, False

    def as_json(x: Column) -> Column:
        return F.to_json(x)

    # a number, date or the like is text already as Spark prints it; parsed records are JSON
    parsed = element.typeName() in ("struct", "map", "array", "variant")
    make = as_json if parsed else lambda x: x.cast("string")
    return df.withColumn(frame, F.transform(frame, make)), parsed


def map_frames(df: DataFrame, frame: str, per_input: Callable[[list], tuple[list[str], list[dict]]]) -> DataFrame:
    """Rewrite the per-input array ``frame`` with ``per_input`` over Arrow batches; what it says failed joins ``FAILED``, if there."""
    from lineflow.session import ship_package

    ship_package(df.sparkSession)
    df, parsed = text_frames(df, frame)
    out_schema = frame_schema(df.schema, frame)
    idx = df.columns.index(frame)
    failed = df.columns.index(FAILED) if FAILED in df.columns else None
    list_type = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frames = batch.column(idx).to_pylist()
            if parsed:
                frames = [[json.loads(r) if r is not None else None for r in recs or []] for recs in frames]
            found = [per_input(recs or []) for recs in frames]
            cols = list(batch.columns)
            cols[idx] = pa.array([out for out, _ in found], type=list_type)
            if failed is not None and any(bad for _, bad in found):
                old = cols[failed]
                cols[failed] = pa.array([a + b for a, (_, b) in zip(old.to_pylist(), found, strict=True)], type=old.type)
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.mapInArrow(run, out_schema)


def _output(value) -> str:
    if isinstance(value, bytes):
        return value.decode()
    if isinstance(value, (dict, list)):
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return str(value)


def _outputs(result) -> list[str]:
    """None, one output (text, a dict, a number), or an iterable of outputs (a generator included)."""
    if result is None:
        return []
    if isinstance(result, (str, bytes, dict, int, float, bool)):
        return [_output(result)]
    return [_output(v) for v in result if v is not None]


def python_step(fn: RecordFn, name: str | None = None, suppress_errors: bool = False) -> Step:
    """A table step running ``fn`` on every record of every input."""
    name = name or getattr(fn, "__name__", "python")

    def apply(df: DataFrame, frame: str) -> DataFrame:
        logged: list[int] = []

        def per_input(records: list) -> tuple[list[str], list[dict]]:
            out: list[str] = []
            failed: list[dict] = []
            for rec in records:
                if rec is None:
                    continue
                try:
                    out.extend(_outputs(fn(rec)))
                except Exception as exc:  # noqa: BLE001 - suppression is the feature
                    if not suppress_errors:
                        raise
                    failed.append({"step": name, "record": _output(rec), "reason": f"{type(exc).__name__}: {exc}"})
                    if len(logged) < LOGGED_ERRORS:
                        logged.append(1)
                        print(f"{name}: no output for {str(rec)[:200]!r}: {exc!r}", file=sys.stderr)
            return out, failed

        return map_frames(df, frame, per_input)

    return Step(name, "table", apply)


def pandas_step(fn: Callable, name: str | None = None) -> Step:
    """A vectorized record function: ``fn(pandas.Series[str]) -> pandas.Series``.

    The result has one value per record: a string (one output), None or NaN
    (no output), or a list of strings (0..n outputs).  All records of an
    Arrow batch go to ``fn`` at once; Arrow flattens the per-input arrays and
    regroups the outputs, so no per-record Python loop runs outside ``fn``.
    Errors are not suppressed per record; use ``python_step`` for that.
    """
    import numpy as np
    import pyarrow.compute as pc

    def per_batch(frames: pa.ListArray) -> pa.ListArray:
        n = len(frames)
        flat = pc.list_flatten(frames)
        parents = pc.list_parent_indices(frames).to_numpy(zero_copy_only=False)
        if len(flat) == 0:
            return pa.array([[] for _ in range(n)], type=pa.list_(pa.string()))
        result = fn(flat.to_pandas())
        values = pa.array(list(result), from_pandas=True)
        if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
            inner = pc.list_flatten(values)  # null lists contribute nothing
            inner_parent = pc.list_parent_indices(values).to_numpy(zero_copy_only=False)
            valid = inner.is_valid().to_numpy(zero_copy_only=False)
            counts_per_record = np.bincount(inner_parent[valid], minlength=len(values))
            outputs = inner.filter(inner.is_valid()).cast(pa.string())
        else:
            counts_per_record = values.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            outputs = values.cast(pa.string()).drop_null()
        counts = np.bincount(parents, weights=counts_per_record, minlength=n).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), outputs)

    def apply(df: DataFrame, frame: str) -> DataFrame:
        from lineflow.session import ship_package

        ship_package(df.sparkSession)
        df, _ = text_frames(df, frame)
        out_schema = frame_schema(df.schema, frame)
        idx = df.columns.index(frame)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cols = list(batch.columns)
                cols[idx] = per_batch(batch.column(idx))
                yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

        return df.mapInArrow(run, out_schema)

    return Step(name or getattr(fn, "__name__", "pandas"), "table", apply)
