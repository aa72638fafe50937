"""Framed output (EXT-2, EXT-3, EXT-4, SNK-3).

A frame is the outputs of one input followed by a terminator line.  Here a
frame is the ``ARRAY<STRING>`` made by ``run_frames``; these helpers turn
it into the protocol's text and count it, all as Catalyst expressions.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.options import DEFAULT_BOLT_DELIMITER

if TYPE_CHECKING:
    from lineflow.plans.flow import Flow, Step


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def frame_text(out: str | Column, delimiter: str = DEFAULT_BOLT_DELIMITER) -> Column:
    """``out[0]\\n out[1]\\n ... delimiter\\n`` (EXT-2); an empty frame is ``delimiter\\n``."""
    return F.concat(F.array_join(F.concat(_c(out), F.array(F.lit(delimiter))), "\n"), F.lit("\n"))


def frame_count(out: str | Column) -> Column:
    """Number of outputs of the input, 0 included (EXT-3); never inferred after explode."""
    return F.size(_c(out))


def ordered_frames(spark: SparkSession, path: str, flow: Step | Flow, out: str = "out") -> DataFrame:
    """A frame for every line below ``path``, in the order of files and lines (SRC-6, EXT-2): ``metadata, linenumber, out``.

    Lines are dealt to partitions by ranges of (file, line number) before the
    flow runs, so it runs once a line; a flow keeps its partition's order.
    """
    from lineflow.plans.flow import run_frames
    from lineflow.sources.records import in_order, read_numbered_lines

    lines = in_order(read_numbered_lines(spark, path))
    return run_frames(lines, flow, "content", keep=["metadata", "linenumber"], output=out)


def write_framed_text(df: DataFrame, out: str, path: str, delimiter: str = DEFAULT_BOLT_DELIMITER,
                      mode: str = "overwrite") -> None:
    """Write frames as text (SNK-3).

    The text writer ends every row with a newline, so the frame's own last
    newline is dropped; the file then reads byte for byte like the bolt's
    standard output.  Partitions are written in order: the files of
    ``ordered_frames``, one after the other by name, hold the frames in order.
    """
    text = F.concat(F.array_join(F.concat(F.col(out), F.array(F.lit(delimiter))), "\n"))
    df.select(text.alias("value")).write.mode(mode).text(path)
