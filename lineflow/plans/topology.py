"""The whole launch plan: source, optional spread, combine, flow, sink frame.

Mirrors the reference's chain (source, shuffle when the flow is wider,
provenance joined into the record for blobs, the flow, the sink) with
DataFrame calls; Catalyst plans each batch or micro-batch.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.operators.external import SESSION_BYTES, command_step
from lineflow.operators.failures import Outcome, run_with_failures
from lineflow.operators.partitioning import scan_partitions, spread, spread_by_bytes
from lineflow.options import FlowOptions
from lineflow.plans.flow import Flow, Step, as_flow, run_records
from lineflow.plans.registry import lookup
from lineflow.sources import read_lines
from lineflow.sources.records import combine_metadata, number_lines


def resolve_flow(opts: FlowOptions, flow: Step | Flow | None = None) -> Flow:
    """The given flow, else the external command, else the registered flow by name."""
    if flow is not None:
        return as_flow(flow)
    argv = opts.command_argv()
    if argv:
        return as_flow(command_step(argv, delimiter=opts.delimiter, cwd=opts.directory,
                                    environment=opts.environment, name=opts.dataflow_name,
                                    timeout=opts.command_timeout,
                                    session_bytes=opts.command_session_bytes or SESSION_BYTES))
    return lookup(opts.flow)


def source_width(opts: FlowOptions) -> int:
    """The least number of partitions the source is known to have (PAR-2)."""
    return max(opts.input_parallelism, opts.kafka_partitions if opts.input_kind == "kafka" else 1)


def build_flow(spark: SparkSession, opts: FlowOptions, flow: Step | Flow | None = None,
               streaming: bool = False, checkpoint: str | None = None, glob: str | None = None,
               max_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
               resumable: bool = True) -> DataFrame:
    """DataFrame of ``record`` (one row per output record) for the launch options.

    A stream of files is read whole here; ``per_batch_flow`` serves line mode.
    """
    opts.validate(sink="none")
    f = resolve_flow(opts, flow)
    lines = read_lines(spark, opts, streaming, checkpoint, glob, max_per_trigger, combine=False, whole_files=True,
                       store_marker=not opts.dry_run, max_bytes_per_trigger=max_bytes_per_trigger,
                       plan_only=opts.dry_run, resumable=resumable)
    if streaming or not opts.is_blob_input:  # a batch of files is spread as it is numbered
        lines = spread(lines, opts.flow_parallelism, source_width(opts))
    if opts.is_blob_input:
        lines = combine_metadata(lines)
    return run_records(lines, f, "str")


def per_batch_flow(opts: FlowOptions, flow: Step | Flow | None = None):
    """For streams of files in line mode: number a micro-batch's lines, spread, combine, run the flow.

    Numbering needs the rows straight from the scan, so PAR-1 comes after it.
    """
    f = resolve_flow(opts, flow)

    def apply(tagged_batch: DataFrame, blocks: DataFrame | None = None, leave_out: DataFrame | None = None,
              dead_letters: bool = False) -> DataFrame | Outcome:
        width = scan_partitions(tagged_batch) or source_width(opts)
        lines = number_lines(tagged_batch, blocks=blocks, leave_out=leave_out)
        if opts.flow_parallelism > width and opts.spread == "bytes":
            lines = spread_by_bytes(lines, opts.flow_parallelism, F.octet_length("content"))
        elif opts.flow_parallelism > width:
            lines = lines.repartition(opts.flow_parallelism)
        if dead_letters:
            return run_with_failures(combine_metadata(lines), f, "str")
        return run_records(combine_metadata(lines), f, "str")

    return apply


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def dry_run(opts: FlowOptions, df: DataFrame) -> str:
    """What would run, without running it (STR-7): resolved options and the plan."""
    head = [
        f"query name : {opts.query_name}",
        f"flow       : {opts.dataflow_name}",
        f"input      : {opts.input} ({opts.input_kind}, start {opts.start_position()})",
        f"output     : {opts.output}",
        f"parallelism: source {opts.input_parallelism}, flow {opts.flow_parallelism}",
    ]
    if opts.engine:
        head.append("ignored engine options (use Spark configuration): "
                    + ", ".join(f"--{k}={v}" for k, v in sorted(opts.engine.items())))
    return "\n".join(head) + "\n" + explain_text(df)
