"""The query catalogue: every operator of the survey run on the given tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; ``ORACLES``
holds the equivalent DuckDB SQL over the same parquet tables, with the
same column names.  Stream queries write their drops as text files, launch
a flow on them as the command line does, and read its sink; drops,
checkpoints and sinks go into a fresh folder below ``spark.checkpoint.dir``
per call, which is removed when the driver ends.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineflow.functions.steps import (
    flat_step,
    from_json,
    identity,
    interpolate,
    keep_if,
    map_step,
    repeat,
    to_json,
    tokenize,
    upcase,
)
from lineflow.functions.udtf import with_prime_factors
from lineflow.operators.batch import python_step
from lineflow.operators.external import command_step
from lineflow.operators.failures import run_with_failures
from lineflow.operators.framing import frame_count, frame_text, ordered_frames, write_framed_text
from lineflow.operators.partitioning import spread, spread_by_bytes, spread_to_cluster
from lineflow.options import FlowOptions
from lineflow.plans.flow import run_frames, run_records
from lineflow.session import move_folder, new_run_dir
from lineflow.sinks import kafka_frame
from lineflow.sinks.manifest import read_sink
from lineflow.sources.files import after_marker
from lineflow.sources.kafka import apply_start_offsets, as_kafka_log, decode_messages, kafka_reader_options
from lineflow.sources.records import combine_metadata, read_numbered_lines, recordize
from lineflow.streaming import start_flow

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the catalogue.
BOLT_TERMINATOR = "X"
COMMAND_TERMINATOR = "---"
# A child that splits each line on blanks and ends every frame with ---.
AWK_SPLIT = '{ for (i = 1; i <= NF; i++) print $i; print "---"; fflush() }'
# Event-time cuts of the three drops of the stream queries (events span January 2024).
# Given as text and cast straight to TIMESTAMP_NTZ, so no time zone takes part.
DROP_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """``cols`` of a table, spread over the cluster when its scan is narrower (PAR-1).

    For flows with real per-record work (regex splits, JSON, Python,
    commands).  Columns are pruned before the exchange, so only they move.
    """
    return spread_to_cluster(table(spark, sf_dir, name).select(*cols))


# ----------------------------------------------------------------- record steps
def flow_identity(spark, sf):
    return run_records(table(spark, sf, "events"), identity(), "props", keep=["event_id"])


def flow_skip(spark, sf):
    return run_records(table(spark, sf, "events"), keep_if(lambda x: x != "error", "not_error"), "event_type",
                       keep=["event_id"], output="event_type")


def flow_multi(spark, sf):
    return run_records(table(spark, sf, "events"), repeat(3), "event_type", keep=["event_id"])


def flow_upcase(spark, sf):
    return run_records(table(spark, sf, "part"), upcase(), "p_name", keep=["p_partkey"])


def flow_tokenize(spark, sf):
    return run_records(wide_table(spark, sf, "documents", "doc_id", "text"), tokenize(), "text", keep=["doc_id"])


def flow_interpolate(spark, sf):
    return run_records(table(spark, sf, "events"), interpolate("I raised the {k}", "test_example"), "props",
                       keep=["event_id"])


def flow_to_json(spark, sf):
    return run_records(table(spark, sf, "events"), to_json(), F.struct("event_id", "event_type"), keep=["event_id"])


def _tens(k):
    """Tens of a number of 0 and more, without a floating division."""
    return F.call_function("div", k, F.lit(10).cast("bigint"))


def k_buckets_flow():
    """Parse ``k`` from the props JSON, keep k >= 50, bucket by tens, print JSON."""
    parse = map_step(lambda x: F.struct(x["event_type"].alias("event_type"),
                                        F.from_json(x["props"], "k BIGINT")["k"].alias("k")), "parse_props")
    bucket = map_step(lambda x: F.struct(x["event_type"].alias("event_type"),
                                         _tens(x["k"]).alias("bucket")), "bucket")
    return parse | keep_if(lambda x: x["k"] >= 50, "k_at_least_50") | bucket | to_json()


def flow_dataflow(spark, sf):
    return run_records(wide_table(spark, sf, "events", "event_id", "event_type", "props"), k_buckets_flow(),
                       F.struct("event_type", "props"), keep=["event_id"])


# ----------------------------------------------------------------- provenance
def _doc_lines(spark, sf):
    return recordize(wide_table(spark, sf, "documents", "doc_id", "source", "text"), "text", "source",
                     keep=("doc_id",))


def source_recordize(spark, sf):
    return _doc_lines(spark, sf)


def combine_metadata_query(spark, sf):
    return combine_metadata(_doc_lines(spark, sf), keep=("doc_id",))


# Documents per text file in file_lines: bounds a file (and the task writing it) whatever a
# source's share of the table.  It shapes the output (the bucket, and where numbers start again).
DOCS_PER_FILE = 5000


def file_lines(spark, sf):
    """Line records of real text files, numbered by the two-pass way (SRC-2, SRC-4).

    Spark writes the documents' lines into one file per source and block of
    DOCS_PER_FILE documents, in document and line order; the files are then
    read back as a folder of blobs.
    """
    run = new_run_dir(spark, "file_lines")
    lines = _doc_lines(spark, sf).select(
        "doc_id", F.col("metadata").alias("source"), F.expr(f"doc_id div {DOCS_PER_FILE}").alias("bucket"),
        "linenumber", "content")
    (lines.repartition("source", "bucket").sortWithinPartitions("source", "bucket", "doc_id", "linenumber")
     .select("source", "bucket", "content").write.partitionBy("source", "bucket").text(f"{run}/text"))
    numbered = read_numbered_lines(spark, f"{run}/text")
    return numbered.select(
        F.regexp_extract("metadata", r"/source=([^/]+)/", 1).alias("source"),
        F.regexp_extract("metadata", r"/bucket=([0-9]+)/", 1).cast("bigint").alias("bucket"),
        "linenumber", "content")


# ----------------------------------------------------------------- frames
def framed_counts(spark, sf):
    frames = run_frames(wide_table(spark, sf, "conversations", "conv_id", "turn", "text"), tokenize(), "text",
                        keep=["conv_id", "turn"])
    return frames.select("conv_id", "turn", frame_count("out").alias("n_out"))


def framed_flow():
    """error: no output; click: three; anything else: one."""
    return keep_if(lambda x: x != "error", "not_error") | flat_step(
        lambda x: F.when(x == "click", F.array_repeat(x, 3)).otherwise(F.array(x)), "clicks_thrice")


def framed_text(spark, sf):
    frames = run_frames(table(spark, sf, "events"), framed_flow(), "event_type", keep=["event_id"])
    return frames.select("event_id", frame_text("out", BOLT_TERMINATOR).alias("frame"))


def bolt_frames(spark, sf):
    """Text lines in (written by Spark from the events' JSON), frames out, as the bolt prints them."""
    run = new_run_dir(spark, "bolt_frames")
    table(spark, sf, "events").select("props").write.text(f"{run}/lines")
    flow = from_json() | interpolate("I raised the {k}", "test_example")
    frames = run_frames(spark.read.text(f"{run}/lines"), flow, "value")
    return frames.select(frame_text("out", BOLT_TERMINATOR).alias("frame"))


def bolt_order(spark, sf):
    """The bolt's output files, read one after the other by name: every line with its place.

    The input is the events' JSON in several files whose names and lines follow the event ids.
    """
    run = new_run_dir(spark, "bolt_order")
    events = table(spark, sf, "events").select("event_id", "props").repartitionByRange("event_id").sortWithinPartitions("event_id")
    events.select("props").write.text(f"{run}/lines")
    frames = ordered_frames(spark, f"{run}/lines", from_json() | interpolate("I raised the {k}", "test_example"))
    write_framed_text(frames, "out", f"{run}/frames", BOLT_TERMINATOR)
    lines = read_numbered_lines(spark, f"{run}/frames")
    ahead = Window.orderBy("metadata").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = lines.groupBy("metadata").agg(F.count("*").alias("n")).select("metadata", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    return lines.join(files, "metadata").select((F.col("before") + F.col("linenumber")).alias("place"), F.col("content").alias("line"))


def external_command(spark, sf):
    step = command_step(["awk", AWK_SPLIT], delimiter=COMMAND_TERMINATOR, name="split_words")
    return run_records(wide_table(spark, sf, "part", "p_partkey", "p_name"), step, "p_name", keep=["p_partkey"])


def thousand_over_last_digit(line: str) -> str:
    """Fails (ZeroDivisionError) when k ends in 0; the flow suppresses that."""
    k = json.loads(line)["k"]
    return str(1000 // (k % 10))


def suppress_errors(spark, sf):
    step = python_step(thousand_over_last_digit, "thousand_over_last_digit", suppress_errors=True)
    return run_records(wide_table(spark, sf, "events", "event_id", "props"), step, "props", keep=["event_id"])


def dead_letters(spark, sf):
    """The records that the step fails on, with step and reason, staged in the same run as its output."""
    step = python_step(thousand_over_last_digit, "thousand_over_last_digit", suppress_errors=True)
    return run_with_failures(wide_table(spark, sf, "events", "event_id", "props"), step, "props", keep=["event_id"]).failures


def halve_even(record: dict) -> dict | None:
    """A new record for an even k, none for an odd one."""
    return {"k": record["k"], "half": record["k"] // 2} if record["k"] % 2 == 0 else None


def flow_python_json(spark, sf):
    flow = from_json() | python_step(halve_even, "halve_even") | to_json()
    return run_records(wide_table(spark, sf, "events", "event_id", "props"), flow, "props", keep=["event_id"])


def udtf_prime(spark, sf):
    return with_prime_factors(wide_table(spark, sf, "part", "p_partkey", "p_size"), "p_size", ["p_partkey"])


# ----------------------------------------------------------------- positions, sinks, partitioning
def topic_route(spark, sf):
    ev = table(spark, sf, "events")
    override = F.when(F.col("event_type") == "error", F.lit("errors")).alias("topic")
    out = run_records(ev, identity(), "props", keep=["event_id", override])
    return kafka_frame(out, "clean", topic="topic", keep=("event_id",))


def start_explicit(spark, sf):
    ev = table(spark, sf, "events")
    log = as_kafka_log(ev, "events", value="props", partition=F.col("user_id") % 4, offset="event_id",
                       key="user_id", timestamp="ts")
    starts = kafka_reader_options(FlowOptions(input="events", offset="500", kafka_partitions=4))["startingOffsets"]
    msgs = decode_messages(apply_start_offsets(log, starts), provenance=True)
    return msgs.select("partition", "offset", F.col("str").alias("value"))


def blob_marker(spark, sf):
    return after_marker(table(spark, sf, "documents"), "src2", "source").select("doc_id", "source")


def shuffle(spark, sf):
    """Spread evenly when the scan is narrower than the cluster, as the launcher does."""
    events = table(spark, sf, "events").select("event_id", "props")
    return spread(events, flow_parallelism=max(1, spark.sparkContext.defaultParallelism))


def shuffle_bytes(spark, sf):
    """Documents, some of them very long, in partitions of about equal bytes."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return spread_by_bytes(docs, max(1, spark.sparkContext.defaultParallelism), F.octet_length("text"))


# ----------------------------------------------------------------- streams
# Folder of each drop; the last one sorts before the others, so only its arrival makes it new.
DROP_FOLDERS = ("m0", "m1", "a2")


def _write_drops(spark, sf, base: str, column: str, which: tuple[int, ...] = (0, 1, 2)) -> None:
    """Write ``event_id column`` lines of the events into drops by event time, as files arriving over a month."""
    lo, hi = (F.lit(c).cast("timestamp_ntz") for c in DROP_CUTS)
    ev = table(spark, sf, "events")
    for i, own in enumerate((F.col("ts") < lo, (F.col("ts") >= lo) & (F.col("ts") < hi),
                             F.coalesce(F.col("ts") >= hi, F.lit(True)))):
        if i in which:
            ev.where(own).select(F.concat_ws(" ", "event_id", column)).write.text(f"{base}/{DROP_FOLDERS[i]}")


def _launch(spark, run: str, flow, **kw) -> None:
    """Start a flow on the text files of ``run/in`` as the command line does, and wait until it has read them."""
    path = run if ":" in run.split("/")[0] else f"file://{run}"
    opts = FlowOptions(flow="catalogue", name=run.rsplit("/", 1)[-1], input=f"{path}/in",
                       output="records", from_beginning=kw.pop("from_beginning", False))
    q = start_flow(spark, opts, flow, **{"checkpoint": f"{run}/ckpt", "sink": "parquet", "path": f"{run}/out",
                                         "trigger": {"availableNow": True}} | kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _read_sink(spark, run: str, column: str) -> DataFrame:
    """``event_id`` and ``column`` of the sink's records (file, line and line number joined by tabs)."""
    line = F.regexp_extract("record", r"(?s)^[^\t]*\t(.*)\t[0-9]+$", 1)
    return (read_sink(spark, f"{run}/out", "record string").select(F.split(line, " ", 2).alias("w"))
            .select(F.col("w")[0].cast("bigint").alias("event_id"), F.col("w")[1].alias(column)))


def stream_flow(spark, sf):
    run = new_run_dir(spark, "stream_flow")
    _write_drops(spark, sf, f"{run}/in", "event_type")
    _launch(spark, run, upcase(), from_beginning=True)
    return _read_sink(spark, run, "record")


def stream_resume(spark, sf):
    run = new_run_dir(spark, "stream_resume")
    for i in (0, 1, 2):
        _write_drops(spark, sf, f"{run}/in", "props", (i,))
        _launch(spark, run, identity(), from_beginning=True)
    return _read_sink(spark, run, "props")


def stream_start_marker(spark, sf):
    """The default start: what is there when the flow first starts is left out, what arrives later is read.

    The late drop is the oldest: written before the others, and renamed into the folder after the start.
    """
    run = new_run_dir(spark, "stream_start_marker")
    _write_drops(spark, sf, f"{run}/aside", "props", (2,))
    _write_drops(spark, sf, f"{run}/in", "props", (0, 1))
    _launch(spark, run, identity())
    move_folder(spark, f"{run}/aside/{DROP_FOLDERS[2]}", f"{run}/in/{DROP_FOLDERS[2]}")
    _launch(spark, run, identity())
    return _read_sink(spark, run, "props")


def stream_idempotent(spark, sf):
    """A flow run twice from its start on checkpoints of its own, with other batch borders, into one sink folder.

    Between the two a drop arrives; the second run adds it, and nothing that the first one published.
    """
    run = new_run_dir(spark, "stream_idempotent")
    _write_drops(spark, sf, f"{run}/in", "props", (0, 1))
    _launch(spark, run, identity(), from_beginning=True, checkpoint=f"{run}/ckpt-first", max_per_trigger=1)
    _write_drops(spark, sf, f"{run}/in", "props", (2,))
    _launch(spark, run, identity(), from_beginning=True, checkpoint=f"{run}/ckpt-replay", max_per_trigger=3)
    return _read_sink(spark, run, "props")


QUERIES: dict[str, Query] = {
    "flow_identity": flow_identity,
    "flow_skip": flow_skip,
    "flow_multi": flow_multi,
    "flow_upcase": flow_upcase,
    "flow_tokenize": flow_tokenize,
    "flow_interpolate": flow_interpolate,
    "flow_to_json": flow_to_json,
    "flow_dataflow": flow_dataflow,
    "source_recordize": source_recordize,
    "combine_metadata": combine_metadata_query,
    "file_lines": file_lines,
    "framed_counts": framed_counts,
    "framed_text": framed_text,
    "bolt_frames": bolt_frames,
    "bolt_order": bolt_order,
    "external_command": external_command,
    "suppress_errors": suppress_errors,
    "dead_letters": dead_letters,
    "flow_python_json": flow_python_json,
    "udtf_prime": udtf_prime,
    "topic_route": topic_route,
    "start_explicit": start_explicit,
    "blob_marker": blob_marker,
    "shuffle": shuffle,
    "shuffle_bytes": shuffle_bytes,
    "stream_flow": stream_flow,
    "stream_resume": stream_resume,
    "stream_start_marker": stream_start_marker,
    "stream_idempotent": stream_idempotent,
}

_SPLIT_DOC_LINES = (
    "select doc_id, source as metadata, unnest(string_split(text, chr(10))) as content, "
    "cast(generate_subscripts(string_split(text, chr(10)), 1) as bigint) as linenumber from documents"
)

ORACLES: dict[str, str] = {
    "flow_identity": "select event_id, props as record from events",
    "flow_skip": "select event_id, event_type from events where event_type <> 'error'",
    "flow_multi": "select event_id, event_type as record from events, range(3)",
    "flow_upcase": "select p_partkey, upper(p_name) as record from part",
    "flow_tokenize": (
        "select doc_id, tok as record from (select doc_id, unnest(regexp_split_to_array(text, '\\s+')) tok "
        "from documents) where tok <> ''"
    ),
    "flow_interpolate": "select event_id, 'I raised the ' || coalesce(props->>'$.k', '') as record from events",
    "flow_to_json": (
        "select event_id, cast(to_json({'event_id': event_id, 'event_type': event_type}) as varchar) as record "
        "from events"
    ),
    "flow_dataflow": (
        "select event_id, cast(to_json({'event_type': event_type, 'bucket': k // 10}) as varchar) as record "
        "from (select *, (props->>'$.k')::bigint k from events) where k >= 50"
    ),
    "source_recordize": _SPLIT_DOC_LINES,
    "combine_metadata": (
        "select doc_id, coalesce(metadata, 'null') || chr(9) || coalesce(content, 'null') || chr(9) || linenumber "
        f"as str from ({_SPLIT_DOC_LINES})"
    ),
    "file_lines": (
        f"select source, cast(doc_id // {DOCS_PER_FILE} as bigint) as bucket, cast(row_number() over "
        f"(partition by source, doc_id // {DOCS_PER_FILE} order by doc_id, pos) as bigint) as linenumber, content from "
        "(select doc_id, source, unnest(string_split(text, chr(10))) as content, "
        "generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)"
    ),
    "framed_counts": (
        "select conv_id, turn, cast(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) "
        "as integer) as n_out from conversations"
    ),
    "framed_text": (
        "select event_id, case when event_type = 'error' then '' when event_type = 'click' "
        "then repeat(event_type || chr(10), 3) else event_type || chr(10) end || 'X' || chr(10) as frame from events"
    ),
    "bolt_frames": "select 'I raised the ' || coalesce(props->>'$.k', '') || chr(10) || 'X' || chr(10) as frame from events",
    "bolt_order": (
        "select 2 * n - 1 + e as place, case when e = 0 then 'I raised the ' || k else 'X' end as line from "
        "(select row_number() over (order by event_id) as n, coalesce(props->>'$.k', '') as k from events), range(2) r(e)"
    ),
    "external_command": "select p_partkey, unnest(string_split(p_name, ' ')) as record from part",
    "suppress_errors": (
        "select event_id, cast(1000 // (k % 10) as varchar) as record from "
        "(select event_id, (props->>'$.k')::bigint k from events) where k % 10 <> 0"
    ),
    "dead_letters": (
        "select event_id, 'thousand_over_last_digit' as step, props as record, "
        "'ZeroDivisionError: integer division or modulo by zero' as reason from events "
        "where (props->>'$.k')::bigint % 10 = 0"
    ),
    "flow_python_json": (
        "select event_id, '{\"k\":' || k || ',\"half\":' || (k // 2) || '}' as record from "
        "(select event_id, (props->>'$.k')::bigint k from events) where k % 2 = 0"
    ),
    "udtf_prime": (
        "select p_partkey, cast(p as bigint) as factor from part, "
        "(select r.range p from range(2, 51) r where not exists "
        "(select 1 from range(2, 51) x where x.range < r.range and r.range % x.range = 0)), "
        "range(1, 7) e(e) where p_size % cast(pow(p, e) as bigint) = 0"
    ),
    "topic_route": (
        "select event_id, case when event_type = 'error' then 'errors' else 'clean' end as topic, "
        "props as value from events"
    ),
    "start_explicit": (
        "select cast(user_id % 4 as integer) as partition, event_id as offset, props as value "
        "from events where event_id >= 500"
    ),
    "blob_marker": "select doc_id, source from documents where source > 'src2'",
    "shuffle": "select event_id, props from events",
    "shuffle_bytes": "select doc_id, text from documents",
    "stream_flow": "select event_id, upper(event_type) as record from events",
    "stream_resume": "select event_id, props from events",
    "stream_start_marker": "select event_id, props from events where ts >= timestamp '2024-01-21 00:00:00'",
    "stream_idempotent": "select event_id, props from events",
}
