"""lineflow: record dataflows over lines and messages, on Spark.

A flow is a chain of record steps (``identity() | from_json() | ...``)
compiled into Catalyst expressions; Python code and external commands run
as Arrow-batched table steps.  Sources are Kafka topics, folders and S3
prefixes; sinks are Kafka topics chosen per record, files, or replay-safe
batches; the same flow runs on a static table or as a named streaming
query.
"""

from lineflow.functions import (
    dataframe_step,
    drop_if,
    filter_step,
    flat_step,
    from_json,
    identity,
    interpolate,
    keep_if,
    map_step,
    repeat,
    route,
    skip,
    to_json,
    tokenize,
    upcase,
)
from lineflow.operators import (
    command_step,
    frame_count,
    frame_text,
    pandas_step,
    python_step,
    spread,
    write_framed_text,
)
from lineflow.operators.failures import run_with_failures
from lineflow.options import FlowOptions, OptionError, StartPosition
from lineflow.plans import Flow, Step, dataflow, lookup, processor, register, run_frames, run_records
from lineflow.sinks.manifest import read_sink

__version__ = "0.1.0"

__all__ = [
    "dataframe_step", "drop_if", "filter_step", "flat_step", "from_json", "identity", "interpolate", "keep_if", "map_step", "repeat", "route",
    "skip", "to_json", "tokenize", "upcase", "command_step", "frame_count", "frame_text", "pandas_step", "python_step", "spread",
    "write_framed_text", "FlowOptions", "OptionError", "StartPosition", "Flow", "Step", "dataflow", "lookup",
    "processor", "read_sink", "register", "run_frames", "run_records", "run_with_failures",
]
