"""Running a flow as a named Structured Streaming query (STR-1, STR-3, STR-5..7).

``start_flow`` validates the options, builds the plan, and starts it under
the flow's name with a checkpoint in the shared folder: a restart on the
same checkpoint resumes from the last committed position (STR-3).  A
second active query of the same name is an error unless ``rm`` asks to
stop the running one first, waiting up to ``wait`` seconds (STR-5, STR-6).
``dry_run`` returns the plan instead of starting (STR-7).
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lineflow.options import FlowOptions, StartPosition
from lineflow.plans.flow import Flow, Step
from lineflow.plans.topology import build_flow, dry_run, per_batch_flow
from lineflow.session import query_checkpoint, spark_context
from lineflow.sinks import kafka_frame, kafka_writer_options, write_kafka
from lineflow.sinks.manifest import ManifestSink, bounded
from lineflow.sources import read_lines
from lineflow.sources.files import normalize_path, resolve_cut
from lineflow.sources.records import block_table
from lineflow.streaming.lease import NameLease, NameTaken


class FlowAlreadyRunning(RuntimeError):
    """A query of that name is active, in this session or another application."""


def active_query(spark: SparkSession, name: str | None) -> StreamingQuery | None:
    for q in spark.streams.active:
        if q.name == name:
            return q
    return None


def stop_flow(spark: SparkSession, name: str, wait: float) -> bool:
    """Stop the active query ``name``; True when one was running."""
    q = active_query(spark, name)
    if q is None:
        return False
    q.stop()
    if wait > 0 and not q.awaitTermination(wait):
        raise TimeoutError(f"the flow {name!r} did not stop within {wait} seconds")
    return True


def claim_checkpoint(spark: SparkSession, opts: FlowOptions, checkpoint: str) -> None:
    """Record the topic of a Kafka input with its checkpoint; refuse a checkpoint of another input.

    Folders record theirs with their start cut.
    """
    if opts.input_kind == "kafka":
        resolve_cut(spark, StartPosition("EARLIEST"), f"kafka://{opts.kafka_topic}", checkpoint)


def start_flow(
    spark: SparkSession,
    opts: FlowOptions,
    flow: Step | Flow | None = None,
    checkpoint: str | None = None,
    sink: str | Callable[[DataFrame, int], None] = "kafka",
    path: str | None = None,
    trigger: dict | None = None,
    glob: str | None = None,
    max_per_trigger: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    whole_files: bool = False,
    max_bytes_per_trigger: int | None = None,
    dead_letters: bool = False,
) -> StreamingQuery | str:
    """Start the flow; returns the query, or the plan text on ``dry_run``.

    ``sink`` is ``kafka`` (topic per record, default ``--output``), a file
    format name written to ``path`` (exactly-once file sink), ``memory``,
    or a ``foreachBatch`` function (see ``lineflow.sinks.replay_safe``).
    The query runs until it is stopped, a micro-batch after the other as
    records arrive (STR-1).  ``trigger`` is passed to
    ``DataStreamWriter.trigger``: ``{"availableNow": True}`` ends the query
    after what the input holds now, ``{"processingTime": ...}`` spaces the
    batches.

    Without ``checkpoint`` the query's own folder below the shared scratch
    root is used (``session.query_checkpoint``), so a flow started again by
    name resumes (STR-3) and a replaced flow continues (STR-6).  The name is
    leased below that root (``streaming.lease``): other applications are
    refused it, or take it over with ``rm``, waiting ``wait`` seconds.

    ``max_per_trigger`` caps the files (or Kafka offsets) of a micro-batch and
    ``max_bytes_per_trigger`` its bytes, for file and S3 inputs (STR-2).

    File and S3 inputs are read in line mode, so a file of any size is split
    over tasks; lines are numbered, combined and run through the flow per
    micro-batch inside ``foreachBatch``.  File sinks are then written by manifest
    (``sinks.manifest``): read them with ``read_sink``; they belong to this flow.
    With ``dead_letters`` the records that error-suppressing steps fail on are
    published with each batch (``read_failures``, ``failure_count``).
    ``whole_files`` reads each file (under 2 GB) as one row instead, and
    writes through Spark's own sinks, ``memory`` included.
    """
    opts.validate(sink="kafka" if sink == "kafka" else "other")
    if not (callable(sink) or sink in ("kafka", "memory") or path is not None):
        raise ValueError(f"sink {sink!r} needs a path")  # checked before anything is written
    if dead_letters and (not opts.is_blob_input or whole_files or callable(sink) or sink in ("kafka", "memory")):
        raise ValueError("dead letters need a file or S3 input in line mode and a file sink")
    name = opts.query_name
    checkpoint = checkpoint or query_checkpoint(spark, name)
    if not opts.dry_run:
        running = active_query(spark, name)
        if running is not None:
            if not opts.rm:
                raise FlowAlreadyRunning(f"a flow named {name!r} is already running; use rm=True to replace it")
            stop_flow(spark, name, opts.wait)
    if opts.dry_run:
        return _start(spark, opts, flow, checkpoint, sink, path, trigger, glob, max_per_trigger, transform, whole_files,
                      max_bytes_per_trigger, lambda: None, dead_letters)
    lease = NameLease(spark, name)
    try:
        lease.acquire(opts.rm, opts.wait)
    except NameTaken as exc:
        raise FlowAlreadyRunning(str(exc)) from None
    try:
        claim_checkpoint(spark, opts, checkpoint)
        query = _start(spark, opts, flow, checkpoint, sink, path, trigger, glob, max_per_trigger, transform, whole_files,
                       max_bytes_per_trigger, lease.check, dead_letters)
    except BaseException:
        lease.release()
        raise
    lease.keep(query)
    return query


def _start(spark, opts, flow, checkpoint, sink, path, trigger, glob, max_per_trigger, transform, whole_files,
           max_bytes_per_trigger, fence, dead_letters):
    name = opts.query_name
    if opts.is_blob_input and not whole_files and sink != "memory":
        return _start_lines(spark, opts, flow, checkpoint, sink, path, trigger, glob, max_per_trigger, transform,
                            max_bytes_per_trigger, fence, dead_letters)
    df = build_flow(spark, opts, flow, streaming=True, checkpoint=checkpoint, glob=glob,
                    max_per_trigger=max_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger, resumable=sink != "memory")
    if transform is not None:
        df = transform(df)
    if sink == "kafka":
        df = kafka_frame(df, opts.output)
    if opts.dry_run:
        return dry_run(opts, df)
    w = df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    w = w.trigger(**trigger) if trigger else w
    if callable(sink):
        return w.foreachBatch(sink).start()
    if sink == "kafka":
        return w.format("kafka").options(**kafka_writer_options(opts)).start()
    if sink == "memory":
        return w.format("memory").outputMode("append").start()
    return w.format(sink).outputMode("append").start(path)


@contextlib.contextmanager
def _scan_layout(spark: SparkSession, min_splits: int):
    """Micro-batch scans of a query started here are cut alike whatever cores are live, in at least ``min_splits``."""
    key = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(key, None)
    sc = spark_context(spark)
    live = int(old) if old else sc.defaultParallelism if sc is not None else 1
    spark.conf.set(key, str(max(live, min_splits)))  # the query keeps its own copy of the session
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def sink_owner(opts: FlowOptions) -> str:
    """Whose records a file sink holds: the flow's name, its steps' name and its input."""
    return f"flow {opts.query_name!r} ({opts.dataflow_name}) over {normalize_path(opts.blob_path)}"


def _start_lines(spark, opts, flow, checkpoint, sink, path, trigger, glob, max_per_trigger, transform,
                 max_bytes_per_trigger, fence, dead_letters):
    if opts.dry_run:  # the plan of a micro-batch, over what the input holds now
        now = replace(opts, from_end=False, from_beginning=True)
        df = build_flow(spark, now, flow, glob=glob)
        df = transform(df) if transform is not None else df
        return dry_run(opts, kafka_frame(df, opts.output) if sink == "kafka" else df)
    raw = read_lines(spark, opts, True, checkpoint, glob, max_per_trigger,
                     max_bytes_per_trigger=max_bytes_per_trigger)
    apply = per_batch_flow(opts, flow)

    def shaped(out: DataFrame) -> DataFrame:
        return transform(out) if transform is not None else out

    if callable(sink):
        def each(batch: DataFrame, batch_id: int) -> None:
            sink(shaped(apply(batch)), batch_id)
    elif sink == "kafka":
        def each(batch: DataFrame, batch_id: int) -> None:
            write_kafka(kafka_frame(shaped(apply(batch)), opts.output), opts)
    else:
        files = ManifestSink(path, sink, sink_owner(opts), fence)

        def each(batch: DataFrame, batch_id: int) -> None:
            session = batch.sparkSession
            query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
            if files.published(session, query, batch_id):  # lost after it was published, and replayed
                return
            blocks = block_table(batch)
            inputs = blocks.select(F.col("metadata").alias("path")).distinct()
            done = files.known_inputs(session, query)
            if done is not None:  # another checkpoint of this flow read some of these files
                done = done.join(bounded(inputs), "path", "left_semi").distinct().checkpoint()
                inputs = inputs.join(bounded(done), "path", "left_anti")
            if dead_letters:
                outcome = apply(batch, blocks, done, dead_letters=True)
                files.write(shaped(outcome.records), inputs, query, batch_id, outcome.failures, outcome.counts["failures"])
            else:
                files.write(shaped(apply(batch, blocks, done)), inputs, query, batch_id)

    w = raw.writeStream.queryName(opts.query_name).option("checkpointLocation", checkpoint)
    w = (w.trigger(**trigger) if trigger else w).foreachBatch(each)
    with _scan_layout(spark, opts.input_parallelism):
        return w.start()
