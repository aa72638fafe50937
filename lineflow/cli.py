"""Command line: launch a flow as a streaming query, or frame a folder of lines.

    python -m lineflow run FLOW --flows=my_flows.py --input=TOPIC|file:///dir|s3://b/p
                               --output=TOPIC [--sink=kafka|parquet|text|memory --path=DIR]
                               [--checkpoint=DIR] [--trigger=available|"10 seconds"]
                               [--max_per_trigger=N] [--max_bytes_per_trigger=N] [--whole_files]
                               [--command_timeout=SECONDS] [--command_session_bytes=N]
                               [--batch] [--dead_letters] [launch options]
    python -m lineflow bolt FLOW --flows=my_flows.py --input=PATH --output=DIR [--delimiter=X]

``run`` keeps running until it is stopped and picks up what arrives;
``--trigger=available`` ends it after what the input holds now, and
``--batch`` runs once over that as a static DataFrame instead of a stream.
``--max_per_trigger`` caps the files (or Kafka offsets) of one micro-batch;
``--whole_files`` reads each file as one row, ``--dead_letters`` keeps failed
records beside a file sink (see ``start_flow``).
``--command_timeout`` bounds a command's silence, ``--command_session_bytes``
the input that one child of it gets.  ``--flows`` names Python files or modules that register processors and
dataflows (``lineflow.processor``, ``lineflow.dataflow``); give it more
than once for several.  ``--bolt_command='cmd args'`` runs an external
command instead of a named flow.  Meant to run under ``spark-submit``,
which supplies the cluster configuration.  Exit status: 0 done, 1 bad
options or unknown flow, 2 a flow of that name is already running.
"""

from __future__ import annotations

import importlib
import os
import runpy
import sys

from lineflow.options import FlowOptions, OptionError
from lineflow.plans.registry import UnknownFlowError

_OWN = ("flows", "sink", "path", "checkpoint", "trigger", "max_per_trigger", "max_bytes_per_trigger", "whole_files",
        "batch", "dead_letters")
_FLAGS = ("whole_files", "batch", "dead_letters")


def _split(argv: list[str]) -> tuple[dict[str, list[str]], list[str]]:
    own: dict[str, list[str]] = {k: [] for k in _OWN}
    rest = []
    for a in argv:
        key, eq, val = a[2:].partition("=") if a.startswith("--") else ("", "", "")
        if key in own and (eq or key in _FLAGS):
            own[key].append(val if eq else "true")
        else:
            rest.append(a)
    return own, rest


def load_flows(specs: list[str]) -> None:
    for spec in specs:
        if spec.endswith(".py") or os.path.sep in spec:
            runpy.run_path(spec, run_name="lineflow_flows")
        else:
            importlib.import_module(spec)


def _trigger(value: str | None) -> dict | None:
    """None (the default): run on, batch after batch."""
    if not value or value == "continuous":
        return None
    if value in ("available", "availableNow"):
        return {"availableNow": True}
    return {"processingTime": value}


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in ("run", "bolt"):
        print(__doc__, file=sys.stderr)
        return 1
    cmd, (own, rest) = argv[0], _split(argv[1:])
    try:
        load_flows(own["flows"])
        opts = FlowOptions.from_args(rest)
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName(f"lineflow {cmd}").getOrCreate()
        if cmd == "bolt":
            return _bolt(spark, opts)
        return _run(spark, opts, own)
    except (ValueError, UnknownFlowError) as exc:  # OptionError is a ValueError
        print(f"error: {exc}", file=sys.stderr)
        return 1


def _bolt(spark, opts: FlowOptions) -> int:
    """Framed text of every line below ``--input`` (the bolt's output, as files): read by name, they hold the frames in input order."""
    from lineflow.operators.framing import ordered_frames, write_framed_text
    from lineflow.plans.topology import resolve_flow

    if not (opts.flow or opts.bolt_command):
        raise OptionError("provide a dataflow to run (a flow name, --run or --bolt_command)")
    if not opts.input or not opts.output:
        raise OptionError("--input and --output are required")
    frames = ordered_frames(spark, opts.input, resolve_flow(opts))
    write_framed_text(frames, "out", opts.output, opts.delimiter)
    return 0


def _flag(own: dict[str, list[str]], key: str) -> bool:
    return (own[key] or ["false"])[-1].lower() not in ("false", "0", "no")


def _int(own: dict[str, list[str]], key: str) -> int | None:
    raw = (own[key] or [None])[-1]
    if not raw:
        return None
    try:
        return int(raw)
    except ValueError:
        raise OptionError(f"--{key} needs an integer, got {raw!r}") from None


def _run(spark, opts: FlowOptions, own: dict[str, list[str]]) -> int:
    from lineflow.streaming.runner import FlowAlreadyRunning, start_flow

    sink = (own["sink"] or ["kafka"])[-1]
    if _flag(own, "batch"):
        return _run_batch(spark, opts, sink, (own["path"] or [None])[-1])
    try:
        q = start_flow(spark, opts, checkpoint=(own["checkpoint"] or [None])[-1], sink=sink,
                       path=(own["path"] or [None])[-1], trigger=_trigger((own["trigger"] or [None])[-1]),
                       max_per_trigger=_int(own, "max_per_trigger"), whole_files=_flag(own, "whole_files"),
                       max_bytes_per_trigger=_int(own, "max_bytes_per_trigger"), dead_letters=_flag(own, "dead_letters"))
    except FlowAlreadyRunning as exc:
        print(f"error: {exc}", file=sys.stderr)
        return 2
    if isinstance(q, str):
        print(q)
        return 0
    q.awaitTermination()
    return 0


def _run_batch(spark, opts: FlowOptions, sink: str, path: str | None) -> int:
    """A bounded run over what the input holds now (a static table, not a stream)."""
    from lineflow.plans.topology import build_flow, dry_run
    from lineflow.sinks import write_flow

    df = build_flow(spark, opts, streaming=False)
    if opts.dry_run:
        print(dry_run(opts, df))
        return 0
    write_flow(df, opts, sink, path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
