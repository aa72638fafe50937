"""File sinks by manifest: staged, then published at once (SNK-1, STR-4).

A micro-batch writes its records to a folder of its own that no reader looks
at, and then publishes one small manifest file that names the folder, the
query, the batch, and the input files it holds.  The manifest appears whole
or not at all, under the next number.  Readers (``read_sink``) take the
folders that manifests name, so a batch is in the sink exactly from the
moment of that one rename:

* a driver or executor lost before it leaves staged data that nobody reads;
* one lost after it replays the batch, finds it published, and skips it;
* a flow started again on a new checkpoint meets its input files in other
  batches: files that a manifest names are left out, whatever the borders.

A sink belongs to one flow (its name, its steps' name and its input).  Two
drivers can't both publish a number; a flow whose name another driver took
over (``streaming.lease``) is refused before it publishes.

Every ``compact_after`` batches the small folders are merged into one of
bounded files, published by one manifest that replaces those before it
(``compact``).  Folders of ``LARGE_BYTES`` and more stay as they are, so a
record is rewritten a few times, not each time.  What was merged is removed
at the next compaction: readers that listed it have that long.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lineflow import storage

HOME = "_lineflow"
BROADCAST_FILES = 100_000  # paths
COMPACT_AFTER = 100  # batches
FILE_BYTES = 128 << 20  # of a merged file, about
LARGE_BYTES = 1 << 30  # folders that aren't merged again


class ForeignSink(RuntimeError):
    """The sink folder holds the records of another flow."""


@dataclass(frozen=True)
class Entry:
    """A published manifest."""

    number: int
    owner: str
    query: str
    batch: int
    folders: list[str]
    inputs: list[str]
    format: str
    replaces: int | None = None  # manifests up to this number
    old: list[str] = field(default_factory=list)  # folders that it replaces, not removed yet
    failures: list[str] = field(default_factory=list)  # folders of dead letters
    failed: int = 0  # how many they hold


def _manifests(path: str) -> str:
    return f"{path}/{HOME}/manifests"


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """The manifests that count, in order: those after the last compaction, and that one."""
    found: list[Entry] = []
    for name in reversed([n for n in storage.names(spark, _manifests(path)) if n[0] != "."]):
        found.append(Entry(**json.loads(storage.read(spark, f"{_manifests(path)}/{name}"))))
        if found[-1].replaces is not None:
            break
    return found[::-1]


def read_sink(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The published records; an empty table of ``schema`` (``record STRING``) when there are none."""
    known = entries(spark, path)
    folders = [f"{path}/{f}" for e in known for f in e.folders]
    if not folders:
        return spark.createDataFrame([], schema or "record string")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(known[-1].format).load(folders)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters published with the records: ``step, record, reason`` (``start_flow(dead_letters=True)``)."""
    folders = [f"{path}/{f}" for e in entries(spark, path) for f in e.failures]
    schema = "step string, record string, reason string"
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def failure_count(spark: SparkSession, path: str) -> int:
    """How many records failed, by the manifests: exact whatever was retried or replayed."""
    return sum(e.failed for e in entries(spark, path))


class ManifestSink:
    """Writes the micro-batches of one flow."""

    def __init__(self, path: str, fmt: str, owner: str, fence: Callable[[], None] = lambda: None, compact_after: int = COMPACT_AFTER):
        self.path, self.format, self.owner, self.fence, self.compact_after = path, fmt, owner, fence, compact_after
        self.known: list[Entry] | None = None

    def _entries(self, spark: SparkSession) -> list[Entry]:
        if self.known is None:  # only this sink publishes while it runs
            self.known = entries(spark, self.path)
            foreign = {e.owner for e in self.known} - {self.owner}
            if foreign:
                raise ForeignSink(f"{self.path} holds the records of {sorted(foreign)[0]}, not of {self.owner}; use another folder")
        return self.known

    def published(self, spark: SparkSession, query: str, batch: int) -> bool:
        """Whether the batch is in the sink; a compacted one counts by its number."""
        return any(e.query == query and (e.batch == batch or e.replaces is not None and batch <= e.batch) for e in self._entries(spark))

    def known_inputs(self, spark: SparkSession, query: str) -> DataFrame | None:
        """``path`` of input files that other checkpoints of this flow published; None when there are none.

        A checkpoint never gives a file twice, so its own batches needn't be looked through.
        """
        folders = [f"{self.path}/{f}" for e in self._entries(spark) if e.query != query or e.replaces is not None for f in e.inputs]
        return spark.read.schema("path string").parquet(*folders) if folders else None

    def write(self, records: DataFrame, inputs: DataFrame | None, query: str, batch: int,
              failures: DataFrame | None = None, failed: int = 0) -> None:
        """Stage a batch's records, its input files and its dead letters, and publish them as one."""
        spark = records.sparkSession
        known = self._entries(spark)
        staged = f"{HOME}/data/{uuid.uuid4().hex}"
        records.write.format(self.format).save(f"{self.path}/{staged}")
        listed = []
        if inputs is not None:
            listed = [f"{HOME}/inputs/{uuid.uuid4().hex}"]
            inputs.select("path").write.parquet(f"{self.path}/{listed[0]}")
        letters = []
        if failures is not None and failed:
            letters = [f"{HOME}/failures/{uuid.uuid4().hex}"]
            failures.write.parquet(f"{self.path}/{letters[0]}")
        self.fence()
        entry = Entry(known[-1].number + 1 if known else 0, self.owner, query, batch, [staged], listed, self.format,
                      failures=letters, failed=failed)
        publish(spark, self.path, entry)
        known.append(entry)
        if len(known) > self.compact_after:
            compact(spark, self.path)
            self.known = None


def publish(spark: SparkSession, path: str, entry: Entry) -> None:
    try:
        storage.publish(spark, f"{_manifests(path)}/{entry.number:012d}", json.dumps(entry.__dict__))
    except storage.AlreadyThere:
        raise ForeignSink(f"another driver published to {path} meanwhile") from None


def compact(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES, large_bytes: int = LARGE_BYTES) -> int:
    """Merge the small folders of a sink into one; how many manifests became one.

    The flow's own driver does this between batches; otherwise run it while
    the flow stands still.
    """
    known = entries(spark, path)
    if len(known) < 2:
        return 0
    last = known[-1]
    sizes = {f: storage.size(spark, f"{path}/{f}") for e in known for f in e.folders}
    small = [f for f, n in sizes.items() if n < large_bytes]
    merged = f"{HOME}/data/{uuid.uuid4().hex}"
    files = max(1, sum(sizes[f] for f in small) // file_bytes)
    spark.read.format(last.format).load([f"{path}/{f}" for f in small]).repartition(files).write.format(last.format).save(f"{path}/{merged}")
    inputs, listed = [f for e in known for f in e.inputs], []
    if inputs:
        listed = [f"{HOME}/inputs/{uuid.uuid4().hex}"]
        old = spark.read.schema("path string").parquet(*[f"{path}/{f}" for f in inputs])
        old.repartition(max(1, len(inputs) // 1000)).write.parquet(f"{path}/{listed[0]}")
    failures, letters = [f for e in known for f in e.failures], []
    if failures:
        letters = [f"{HOME}/failures/{uuid.uuid4().hex}"]
        dead = spark.read.parquet(*[f"{path}/{f}" for f in failures])
        dead.repartition(max(1, len(failures) // 1000)).write.parquet(f"{path}/{letters[0]}")
    # replays are told by the batch numbers of the last checkpoint, and by input files for others
    top = max(e.batch for e in known if e.query == last.query)
    publish(spark, path, Entry(last.number + 1, last.owner, last.query, top, [f for f in sizes if f not in small] + [merged],
                               listed, last.format, last.number, small + inputs + failures, letters, sum(e.failed for e in known)))
    for e in known:
        for f in e.old:
            storage.remove(spark, f"{path}/{f}")
        storage.remove(spark, f"{_manifests(path)}/{e.number:012d}")
    return len(known)


def bounded(paths: DataFrame) -> DataFrame:
    """Paths for a join: broadcast while they are few."""
    return F.broadcast(paths) if paths.count() <= BROADCAST_FILES else paths
