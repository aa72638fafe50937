"""Record steps, their composition, and how a flow becomes a DataFrame plan.

A *step* turns one record into zero or more records.  Four kinds exist:

``map``     one record in, one out; a null result means "no output"
``filter``  keep the record when the predicate is true
``flat``    one record in, an array of records out (0..n); an optional
            ``keep`` predicate filters the outputs (applied after
            ``explode`` in record mode, so it costs no lambda there)
``table``   a DataFrame-level step (Python code or an external command run
            through ``mapInArrow``) that rewrites the per-input array of
            records; see ``lineflow.operators``
``dataframe`` any ``DataFrame -> DataFrame`` function over the carried
            columns and the record column ``record`` (Spark's own joins,
            aggregates or windows inside a flow); record mode only, since
            it may regroup rows and so has no per-input frame

Steps compose with ``|`` into a ``Flow`` (MAP-13, UDF-2).  A flow is
compiled into ordinary Catalyst expressions in one of two shapes:

* ``run_records`` (MAP-1): one output row per output record, appended as
  ``record``.  Expression steps become ``select`` / ``where`` /
  ``explode``, so filters stay visible to the optimizer and nothing leaves
  whole-stage codegen.
* ``run_frames`` (EXT-2, EXT-3): one row per input with an
  ``ARRAY<STRING>`` of its outputs (empty = "no output").  Expression
  steps become higher-order functions over that array, so output counts
  per input need no shuffle and no regrouping.

Both shapes are narrow: no exchange is ever added by a flow (a
``dataframe`` step adds whatever its own DataFrame code adds).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

STEP_KINDS = ("map", "filter", "flat", "table", "dataframe")
RECORD = "record"
_FRAME = "__lineflow_frame"


@dataclass(frozen=True)
class Step:
    name: str
    kind: str
    fn: Callable
    typed: bool = False
    keep: Callable[[Column], Column] | None = None
    nonnull: bool = False  # map/flat: a non-null record never yields a null output

    def __post_init__(self) -> None:
        if self.kind not in STEP_KINDS:
            raise ValueError(f"unknown step kind {self.kind!r}; use one of {STEP_KINDS}")

    def __or__(self, other: Step | Flow) -> Flow:
        return Flow((self,)) | other

    def call(self, x: Column, dtype: DataType | None) -> Column:
        return self.fn(x, dtype) if self.typed else self.fn(x)


@dataclass(frozen=True)
class Flow:
    steps: tuple[Step, ...]
    name: str | None = None

    def __or__(self, other: Step | Flow) -> Flow:
        if isinstance(other, Step):
            return Flow((*self.steps, other), self.name)
        if isinstance(other, Flow):
            return Flow((*self.steps, *other.steps), self.name)
        raise TypeError(f"cannot compose a flow with {type(other).__name__}")

    def named(self, name: str) -> Flow:
        return Flow(self.steps, name)

    @property
    def has_table_steps(self) -> bool:
        return any(s.kind == "table" for s in self.steps)

    def describe(self) -> str:
        return " | ".join(s.name for s in self.steps) or "(empty)"


def as_flow(flow: Step | Flow | Iterable[Step]) -> Flow:
    if isinstance(flow, Flow):
        return flow
    if isinstance(flow, Step):
        return Flow((flow,))
    return Flow(tuple(flow))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _names(keep: Sequence[str | Column]) -> list[Column]:
    return [_col(k) for k in keep]


def _keep_names(df: DataFrame, n_keep: int) -> list[str]:
    return df.columns[:n_keep]


def _array_of(c: Column) -> Column:
    """``[c]``, or an empty array of the same type when ``c`` is null (no lambda needed)."""
    one = F.array(c)
    return F.when(c.isNull(), F.slice(one, 1, 0)).otherwise(one)


def _lambda1(fn: Callable[[Column], Column]) -> Callable[[Column], Column]:
    # Higher-order functions inspect the arity of the Python callable.
    def f(x):
        return fn(x)

    return f


# --------------------------------------------------------------------------- records
def _drop_nulls(df: DataFrame, keep_cols: list[str]) -> DataFrame:
    """Drop rows whose record is null.

    Through a generator and a filter on its output: Catalyst pushes a
    filter below a projection by inlining the projection, which would
    evaluate an expensive step (JSON parsing, regexes) twice, but it
    cannot push a predicate on a generated column below the generator.
    """
    df = df.select(*keep_cols, F.explode(F.array(RECORD)).alias(RECORD))
    return df.where(F.col(RECORD).isNotNull())


def run_records(
    df: DataFrame,
    flow: Step | Flow | Iterable[Step],
    record: str | Column = "str",
    keep: Sequence[str | Column] = (),
    output: str = RECORD,
) -> DataFrame:
    """Apply ``flow`` to ``record``; one row per output record (MAP-1).

    ``keep`` columns are carried beside each output (provenance); every
    other column is pruned before the flow runs (MAP-3), which also keeps
    the scan narrow.  A record with no output disappears.

    Filters ahead of the first transforming step stay filters, so a
    predicate on a source column reaches the scan.  Later filters and null
    results become null records inside projections (each step evaluated
    once) and are dropped in one place, only when one may be null.
    """
    flow = as_flow(flow)
    df = df.select(*_names(keep), _col(record).alias(RECORD))
    keep_cols = _keep_names(df, len(keep))
    df = df.where(F.col(RECORD).isNotNull())
    in_arrays = False
    leading = True  # no step has transformed the record yet
    maybe_null = False  # whether the record column may hold nulls now
    for step in flow.steps:
        if step.kind == "table":
            if not in_arrays:
                arr = _array_of(F.col(RECORD)) if maybe_null else F.array(RECORD)
                df = df.select(*keep_cols, arr.alias(_FRAME))
                in_arrays = True
            df = step.fn(df, _FRAME)
            leading = maybe_null = False
            continue
        if in_arrays:
            df = df.select(*keep_cols, F.explode(_FRAME).alias(RECORD))
            in_arrays = False
        if step.kind == "dataframe":
            if maybe_null:
                df = _drop_nulls(df, keep_cols)
            df = step.fn(df)
            if RECORD not in df.columns:
                raise ValueError(f"DataFrame step {step.name!r} must keep the record column {RECORD!r}")
            df = df.select(*keep_cols, RECORD)
            leading, maybe_null = False, True
            continue
        dtype = df.schema[RECORD].dataType if step.typed else None
        x = F.col(RECORD)
        if step.kind == "filter" and leading:
            df = df.where(step.call(x, dtype))
            continue
        leading = False
        if step.kind == "map":
            value = step.call(x, dtype)
            df = df.select(*keep_cols, (F.when(x.isNotNull(), value) if maybe_null else value).alias(RECORD))
            maybe_null = maybe_null or not step.nonnull
        elif step.kind == "filter":
            df = df.select(*keep_cols, F.when(step.call(x, dtype), x).alias(RECORD))
            maybe_null = True
        else:  # flat: explode skips null arrays; null elements are removed
            arr = step.call(x, dtype)
            if maybe_null:  # a null record has no outputs, whatever the step makes of it
                arr = F.when(x.isNotNull(), arr)
            df = df.select(*keep_cols, F.explode(arr if step.nonnull else F.array_compact(arr)).alias(RECORD))
            if step.keep is not None:
                df = df.where(step.keep(F.col(RECORD)))
            maybe_null = False
    if in_arrays:
        df = df.select(*keep_cols, F.explode(_FRAME).alias(RECORD))
    elif maybe_null:
        df = _drop_nulls(df, keep_cols)
    return df.withColumnRenamed(RECORD, output) if output != RECORD else df


# --------------------------------------------------------------------------- frames
def _not_null(x: Column) -> Column:
    return x.isNotNull()


def frame_expr(df: DataFrame, frame: str, step: Step) -> Column:
    """The new value of the per-input record array after an expression step."""
    dtype = None
    if step.typed:
        at = df.schema[frame].dataType
        dtype = at.elementType if isinstance(at, ArrayType) else None
    fn = _lambda1(lambda x: step.call(x, dtype))
    # The frame holds no nulls between steps, so a step promising non-null
    # outputs for non-null records needs no null-filtering pass.
    if step.kind == "map":
        mapped = F.transform(frame, fn)
        return mapped if step.nonnull else F.filter(mapped, _not_null)
    if step.kind == "filter":
        return F.filter(frame, fn)
    if step.nonnull:
        flat = F.flatten(F.transform(frame, fn))
        return F.filter(flat, step.keep) if step.keep is not None else flat
    # flat: drop null inner arrays first, because flatten of a null is null
    flat = F.flatten(F.filter(F.transform(frame, fn), _not_null))
    if step.keep is not None:
        keep = step.keep
        return F.filter(flat, lambda y: y.isNotNull() & keep(y))
    return F.filter(flat, _not_null)


def run_frames(
    df: DataFrame,
    flow: Step | Flow | Iterable[Step],
    record: str | Column = "str",
    keep: Sequence[str | Column] = (),
    output: str = "out",
) -> DataFrame:
    """Apply ``flow``; one row per input with the array of its outputs.

    The array is empty when the input gave no output, which is what
    distinguishes "no output" from "no output yet" (EXT-3).
    """
    flow = as_flow(flow)
    df = df.select(*_names(keep), _array_of(_col(record)).alias(_FRAME))
    keep_cols = _keep_names(df, len(keep))
    for step in flow.steps:
        if step.kind == "dataframe":
            raise ValueError(f"DataFrame step {step.name!r} may regroup rows, so it has no per-input frame; "
                             "run the flow with run_records")
        if step.kind == "table":
            df = step.fn(df, _FRAME)
        else:
            df = df.select(*keep_cols, frame_expr(df, _FRAME, step).alias(_FRAME))
    return df.withColumnRenamed(_FRAME, output)
