"""Operators beyond single expressions: Python and command steps, framing, spread."""

from lineflow.operators.batch import pandas_step, python_step
from lineflow.operators.external import FrameProtocolError, command_step
from lineflow.operators.framing import frame_count, frame_text, write_framed_text
from lineflow.operators.partitioning import spread, spread_by_bytes, spread_to_cluster

__all__ = ["pandas_step", "python_step", "FrameProtocolError", "command_step", "frame_count", "frame_text", "write_framed_text",
           "spread", "spread_by_bytes", "spread_to_cluster"]
