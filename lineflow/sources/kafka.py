"""Kafka input (SRC-1, SRC-5, POS-1..4, PAR-2, STR-2).

Spark's own Kafka source does the reading; this module only turns launch
options into its options and decodes messages into the record column
``str``.  ``as_kafka_log`` and ``apply_start_offsets`` give the same
semantics over a Kafka-shaped table (an archived topic, or a table used
as one), which is also how they are tested where no broker exists.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.options import KAFKA_EARLIEST, KAFKA_LATEST, FlowOptions, OptionError, StartPosition


def starting_offsets(position: StartPosition, topic: str, partitions: int) -> str:
    """The ``startingOffsets`` value: earliest, latest, or per-partition JSON (POS-1..4).

    RESUME maps to ``latest``: with an existing checkpoint Spark ignores the
    option and resumes, so it only decides the first run.
    """
    if position.policy == "EARLIEST":  # POS-1
        return "earliest"
    if position.policy in ("LATEST", "RESUME"):  # POS-2, POS-4
        return "latest"
    # POS-3: the same explicit offset on every partition
    return json.dumps({topic: {str(p): int(position.offset) for p in range(partitions)}})


def kafka_reader_options(opts: FlowOptions, streaming: bool = True) -> dict[str, str]:
    """Options for ``format("kafka")`` from the launch options."""
    pos = opts.start_position()
    o = {
        "kafka.bootstrap.servers": opts.kafka_servers,
        "subscribe": opts.kafka_topic,
        # --kafka_batch is a fetch size in bytes; the consumer's per-partition cap is its match
        "kafka.max.partition.fetch.bytes": str(opts.kafka_batch),
    }
    if streaming:
        o["startingOffsets"] = starting_offsets(pos, opts.kafka_topic, opts.kafka_partitions)
    else:
        if pos.policy == "LATEST":
            raise OptionError("--from_end reads nothing from a bounded topic; use a stream")
        o["startingOffsets"] = "earliest" if pos.policy in ("EARLIEST", "RESUME") else starting_offsets(
            pos, opts.kafka_topic, opts.kafka_partitions)
        o["endingOffsets"] = "latest"
    if opts.input_parallelism > opts.kafka_partitions:
        # more Spark tasks than topic partitions: split offset ranges
        o["minPartitions"] = str(opts.input_parallelism)
    return o


def read_kafka(spark: SparkSession, opts: FlowOptions, streaming: bool = True,
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    r = reader.format("kafka").options(**kafka_reader_options(opts, streaming))
    if streaming and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return decode_messages(r.load())


def decode_messages(frame: DataFrame, provenance: bool = False) -> DataFrame:
    """Message bytes as the string record ``str`` (SRC-5)."""
    cols: list[Column] = [F.col("value").cast("string").alias("str")]
    if provenance:
        cols = [F.col("topic"), F.col("partition"), F.col("offset"), *cols]
    return frame.select(*cols)


def as_kafka_log(df: DataFrame, topic: str, value: str | Column, partition: str | Column,
                 offset: str | Column, key: str | Column | None = None,
                 timestamp: str | Column | None = None) -> DataFrame:
    """A table in the Kafka source schema: key, value, topic, partition, offset, timestamp, timestampType."""

    def c(x):
        return F.col(x) if isinstance(x, str) else x

    return df.select(
        (c(key).cast("string").cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        c(value).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        c(partition).cast("int").alias("partition"),
        c(offset).cast("bigint").alias("offset"),
        (c(timestamp).cast("timestamp") if timestamp is not None else F.lit(None).cast("timestamp")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def apply_start_offsets(log: DataFrame, position: StartPosition | dict[int, int] | str) -> DataFrame:
    """Keep the part of a Kafka-shaped table a reader starting at ``position`` would see.

    A dict gives a start offset per partition (-2 earliest, -1 latest);
    a StartPosition applies one offset to every partition; text is a
    ``startingOffsets`` value as ``starting_offsets`` makes it.
    """
    if isinstance(position, str):
        if position in ("earliest", "latest"):
            return log if position == "earliest" else log.where(F.lit(False))
        parts = [apply_start_offsets(log.where(F.col("topic") == topic), {int(p): o for p, o in offsets.items()})
                 for topic, offsets in json.loads(position).items()]
        return reduce(DataFrame.unionAll, parts, log.where(F.lit(False))) if len(parts) != 1 else parts[0]
    if isinstance(position, StartPosition):
        if position.policy in ("EARLIEST", "RESUME"):
            return log
        if position.policy == "LATEST":
            return log.where(F.lit(False))
        return log.where(F.col("offset") >= F.lit(int(position.offset)))
    conds = []
    for p, off in position.items():
        if off == KAFKA_EARLIEST:
            conds.append(F.col("partition") == p)
        elif off != KAFKA_LATEST:
            conds.append((F.col("partition") == p) & (F.col("offset") >= off))
    if not conds:
        return log.where(F.lit(False))
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    return log.where(cond)
