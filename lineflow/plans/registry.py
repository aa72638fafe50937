"""Named processors and dataflows (UDF-1, UDF-2, UDF-3).

``processor`` defines a record step from a Column function, ``dataflow``
names a composition of steps, ``lookup`` finds either by name with a clear
error when it is missing.  The registry is a plain dict per process; the
functions it holds are Catalyst expressions or picklable Python, so they
ship to executors with the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from lineflow.plans.flow import Flow, Step, as_flow

_REGISTRY: dict[str, Flow] = {}


class UnknownFlowError(KeyError):
    """No processor or dataflow of that name."""

    def __str__(self) -> str:  # KeyError quotes its message otherwise
        return str(self.args[0])


def register(name: str, flow: Step | Flow | Iterable[Step], replace: bool = True) -> Flow:
    if not name:
        raise ValueError("a flow needs a name")
    if not replace and name in _REGISTRY:
        raise ValueError(f"a flow named {name!r} is already registered")
    f = as_flow(flow).named(name)
    _REGISTRY[name] = f
    return f


def processor(name: str, kind: str = "map", typed: bool = False,
              suppress_errors: bool = False) -> Callable[[Callable], Step]:
    """Decorator: register a record function as a named step.

    With ``kind`` ``map`` (one output, null = none), ``filter`` (predicate)
    or ``flat`` (array of outputs), ``fn(record: Column) -> Column`` is a
    Catalyst expression; ``typed=True`` also passes the record's Spark
    type, for steps that read fields of JSON, structs or variants alike.
    With ``kind="python"``, ``fn(record)`` returns or yields its outputs (a
    generator works, like a processor that yields); the record is a line, or
    what ``from_json`` made of it (a dict).  An error fails the flow; with
    ``suppress_errors`` it is counted and the record gives no output.  With ``kind="pandas"``,
    ``fn(pandas.Series) -> pandas.Series`` is vectorized.
    """

    def wrap(fn: Callable) -> Step:
        if kind == "python":
            from lineflow.operators.batch import python_step

            step = python_step(fn, name, suppress_errors=suppress_errors)
        elif kind == "pandas":
            from lineflow.operators.batch import pandas_step

            step = pandas_step(fn, name)
        else:
            step = Step(name, kind, fn, typed)
        register(name, step)
        return step

    return wrap


def dataflow(name: str, *parts: Step | Flow | str) -> Flow:
    """Register a named chain of steps; parts may be names of registered flows."""
    flow = Flow(())
    for p in parts:
        flow = flow | (lookup(p) if isinstance(p, str) else p)
    return register(name, flow)


def _load_builtins() -> None:
    """Register the documentation processors (identity, upcaser, tokenizer, ...) once."""
    import lineflow.functions.examples  # noqa: F401  (registers on import)


def lookup(name: str | None) -> Flow:
    if not name:
        raise UnknownFlowError("provide a dataflow to run (a flow name or --run)")
    if name not in _REGISTRY:
        _load_builtins()
    try:
        return _REGISTRY[name]
    except KeyError:
        raise UnknownFlowError(
            f"no processor or dataflow named {name!r}; known: {', '.join(sorted(_REGISTRY)) or 'none'}"
        ) from None


def registered() -> list[str]:
    _load_builtins()
    return sorted(_REGISTRY)
