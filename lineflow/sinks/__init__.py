"""Sinks (SNK-1, SNK-2, SNK-3, STR-4).

Kafka gets a frame of ``topic, value``: the record's own topic when it has
one, else the default (per-record override).  ``option("topic")`` is never
set, because it would override the column.  Flows over files write theirs by
manifest (``sinks.manifest``).  For other ``foreachBatch`` sinks ``replay_safe`` writes each
micro-batch to its own ``batch_id=N`` folder with overwrite, so a replayed
batch replaces its earlier attempt instead of doubling it.  The folder
belongs to one query (the id its checkpoint keeps): batch numbers of another
checkpoint mean other records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lineflow.operators.framing import write_framed_text
from lineflow.options import FlowOptions
from lineflow.session import remove_folder
from lineflow.sinks.manifest import ForeignSink, ManifestSink, compact, failure_count, read_failures, read_sink


def kafka_frame(df: DataFrame, default_topic: str, value: str = "record",
                topic: str | Column | None = "topic", keep: tuple[str, ...] = ()) -> DataFrame:
    """``topic, value`` with ``topic = coalesce(record topic, default)`` (SNK-1, SNK-2).

    ``keep`` columns ride along for inspection; drop them before a Kafka
    write, which accepts only key, value, topic, partition and headers.
    """
    t = F.lit(default_topic)
    v = F.col(value)
    vtype = df.schema[value].dataType
    if isinstance(vtype, StructType) and {"topic", "value"} <= set(vtype.fieldNames()):
        # a record routed by the flow itself (functions.route)
        t = F.coalesce(v["topic"], t)
        v = v["value"]
    elif isinstance(topic, Column) or (topic is not None and topic in df.columns):
        t = F.coalesce(F.col(topic) if isinstance(topic, str) else topic, t)
    return df.select(*keep, t.alias("topic"), v.cast("string").alias("value"))


def kafka_writer_options(opts: FlowOptions) -> dict[str, str]:
    return {"kafka.bootstrap.servers": opts.kafka_servers}


def write_kafka(frame: DataFrame, opts: FlowOptions) -> None:
    frame.write.format("kafka").options(**kafka_writer_options(opts)).save()


def write_flow(df: DataFrame, opts: FlowOptions, sink: str = "kafka", path: str | None = None,
               mode: str = "append") -> None:
    """Write a bounded flow's records: Kafka (topic per record, default ``--output``) or files."""
    if sink == "kafka":
        write_kafka(kafka_frame(df, opts.output), opts)
        return
    if path is None:
        raise ValueError(f"sink {sink!r} needs a path")
    df.write.mode(mode).format(sink).save(path)


OWNER_FILE = "_lineflow_owner"


def _owner(spark: SparkSession, path: str) -> str | None:
    try:
        row = spark.read.text(f"{path}/{OWNER_FILE}").first()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return row["value"] if row else None


def replay_safe(path: str, fmt: str = "parquet", replace: bool = False) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing batch N to ``path/batch_id=N``, overwriting (STR-4).

    The first batch records the query's id in the folder.  A query of another
    checkpoint is refused (its batch N holds other records, which would double
    or overwrite what is there); with ``replace`` it starts the folder anew,
    for a flow that is run again from its start.
    """
    checked: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        if query not in checked:
            owner = _owner(spark, path)
            if owner is not None and owner != query:
                if not replace:
                    raise ForeignSink(f"{path} holds the batches of query {owner}, not of {query}; "
                                      "use another folder, or replace=True to start it anew")
                remove_folder(spark, path)
            if owner != query:
                spark.createDataFrame([(query,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{OWNER_FILE}")
            checked.append(query)
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return write


__all__ = ["kafka_frame", "kafka_writer_options", "write_kafka", "write_flow", "replay_safe", "ForeignSink", "ManifestSink", "compact",
           "failure_count", "read_failures", "read_sink", "write_framed_text"]
