"""Sources: Kafka topics, folders and S3 prefixes as records (SRC-1..7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lineflow.options import FlowOptions
from lineflow.sources.files import read_blob_lines
from lineflow.sources.kafka import read_kafka
from lineflow.sources.records import combine_metadata


def read_lines(spark: SparkSession, opts: FlowOptions, streaming: bool = False,
               checkpoint: str | None = None, glob: str | None = None,
               max_per_trigger: int | None = None, combine: bool = True, whole_files: bool = False,
               store_marker: bool = True, max_bytes_per_trigger: int | None = None,
               plan_only: bool = False, resumable: bool = True) -> DataFrame:
    """Records of the input chosen by its URI scheme (SRC-7).

    Kafka gives ``str``; files and S3 give ``content, metadata, linenumber``
    and, with ``combine`` (the default), the tab-joined ``str`` of MAP-2.  A
    stream of them in line mode (not ``whole_files``) gives the unnumbered
    lines of ``records.tag_lines``; micro-batches number and combine them.
    """
    if opts.input_kind == "kafka":
        return read_kafka(spark, opts, streaming, max_offsets_per_trigger=max_per_trigger)
    lines = read_blob_lines(spark, opts, streaming, checkpoint, glob, max_files_per_trigger=max_per_trigger,
                            whole_files=whole_files, store_marker=store_marker,
                            max_bytes_per_trigger=max_bytes_per_trigger, plan_only=plan_only, resumable=resumable)
    if streaming and not whole_files:
        return lines  # numbered and combined per micro-batch
    return combine_metadata(lines) if combine else lines


__all__ = ["read_lines", "combine_metadata"]
