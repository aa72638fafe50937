"""Built-in record steps, all plain Catalyst expressions (MAP-4 .. MAP-11).

Each constructor returns a ``Step``; compose them with ``|``.  None of
them leaves the JVM, so they run inside whole-stage codegen in record
mode and as higher-order functions in framed mode.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, VariantType

from lineflow.plans.flow import Step

_CORRUPT = "__lineflow_corrupt"


def map_step(fn: Callable[[Column], Column], name: str = "map", typed: bool = False,
             nonnull: bool = False) -> Step:
    """A one-to-one step; ``nonnull=True`` promises a non-null record never maps to null."""
    return Step(name, "map", fn, typed, nonnull=nonnull)


def filter_step(pred: Callable[[Column], Column], name: str = "filter", typed: bool = False) -> Step:
    return Step(name, "filter", pred, typed)


def flat_step(fn: Callable[[Column], Column], name: str = "flat", typed: bool = False,
              keep: Callable[[Column], Column] | None = None, nonnull: bool = False) -> Step:
    """A one-to-many step; ``nonnull=True`` promises no null elements in the arrays."""
    return Step(name, "flat", fn, typed, keep, nonnull)


def dataframe_step(fn: Callable, name: str = "dataframe") -> Step:
    """Any ``DataFrame -> DataFrame`` function as a step (MAP-13).

    ``fn`` sees the carried columns and the record column ``record`` and
    must return them; it may use any DataFrame operation.
    """
    return Step(name, "dataframe", fn)


def identity() -> Step:
    """Pass the record through (MAP-4)."""
    return map_step(lambda x: x, "identity", nonnull=True)


def skip() -> Step:
    """Drop every record (MAP-5, the ``skipped`` processor)."""
    return filter_step(lambda x: F.lit(False), "skipped")


def keep_if(pred: Callable[[Column], Column], name: str = "keep_if") -> Step:
    """Keep records where ``pred`` is true (MAP-5)."""
    return filter_step(pred, name)


def drop_if(pred: Callable[[Column], Column], name: str = "drop_if") -> Step:
    """Drop records where ``pred`` is true; a null predicate keeps the record."""
    return filter_step(lambda x: ~F.coalesce(pred(x), F.lit(False)), name)


def repeat(n: int = 3) -> Step:
    """Emit each record ``n`` times (MAP-6, the ``multi`` processor)."""
    if n < 0:
        raise ValueError("repeat count must not be negative")
    return flat_step(lambda x: F.array_repeat(x, n), "multi", nonnull=True)


def upcase() -> Step:
    """Upper-case a line (MAP-7, the ``upcaser`` processor)."""
    return map_step(F.upper, "upcaser", nonnull=True)


def tokenize(pattern: str = r"\s+") -> Step:
    """One record per word; an empty line gives none (MAP-8)."""
    return flat_step(lambda x: F.split(x, pattern), "tokenizer", keep=lambda t: t != "", nonnull=True)


def from_json(schema: str | StructType | None = None) -> Step:
    """Parse a JSON line (MAP-9); a line that does not parse gives no output.

    With no schema the record becomes a ``VARIANT`` (open schema, like a
    hash); with a schema it becomes a typed struct.  A malformed line is
    null either way, so the flow drops it (MAP-14).
    """
    if schema is None:
        return map_step(F.try_parse_json, "from_json")
    with_corrupt = (StructType([*schema.fields, StructField(_CORRUPT, StringType())]) if isinstance(schema, StructType)
                    else f"{schema}, {_CORRUPT} STRING")

    def parse(x: Column) -> Column:
        j = F.from_json(x, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
        return F.when(j[_CORRUPT].isNull(), j.dropFields(_CORRUPT))

    return map_step(parse, "from_json")


def to_json() -> Step:
    """Serialise a struct or variant record to a JSON line, nulls kept (MAP-10).

    A string record is taken as an already serialised JSON line and passed
    through, so ``to_json`` can end any flow.
    """

    def ser(x: Column, dtype: DataType | None) -> Column:
        if isinstance(dtype, StringType):
            return x
        if isinstance(dtype, VariantType):
            return F.to_json(x)
        return F.to_json(x, {"ignoreNullFields": "false"})

    return map_step(ser, "to_json", typed=True, nonnull=True)


def field(x: Column, dtype: DataType | None, name: str) -> Column:
    """Field ``name`` (``a.b`` for nested) of a record as text: struct field, variant path or JSON path."""
    if isinstance(dtype, StructType):
        col, t = x, dtype
        for part in name.split("."):
            if not isinstance(t, StructType) or part not in t.fieldNames():
                return F.lit(None).cast("string")  # a missing field interpolates as ''
            col, t = col[part], t[part].dataType
        return col.cast("string")
    if isinstance(dtype, VariantType):
        return F.try_variant_get(x, f"$.{name}", "string")
    return F.get_json_object(x, f"$.{name}")


def interpolate(template: str, name: str = "interpolate") -> Step:
    """Fill ``{field}`` placeholders from the record; a missing field is '' (MAP-11).

    ``interpolate("I raised the {foo}")`` works on a JSON line, a parsed
    struct or a variant alike.
    """
    parts = list(string.Formatter().parse(template))

    def fill(x: Column, dtype: DataType | None) -> Column:
        pieces: list[Column] = []
        for literal, fname, _spec, _conv in parts:
            if literal:
                pieces.append(F.lit(literal))
            if fname is not None:
                pieces.append(F.coalesce(field(x, dtype, fname), F.lit("")))
        return F.concat(*pieces) if pieces else F.lit("")

    return map_step(fill, name, typed=True, nonnull=True)


def route(topic: Callable[[Column], Column], name: str = "route") -> Step:
    """Choose an output topic per record (SNK-2); a null topic keeps the default.

    The record becomes ``struct(topic, value)``; sinks write ``value`` to
    ``coalesce(topic, default)``.  Put it last, after ``to_json`` when the
    record is structured.
    """
    return map_step(lambda x: F.struct(topic(x).cast("string").alias("topic"), x.cast("string").alias("value")),
                    name)
