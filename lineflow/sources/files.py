"""Directory and S3 input (SRC-2, SRC-3, SRC-6, POS-5..8).

Two kinds of start cut exist.

* An EXPLICIT start (``--offset``) names a blob: those whose path sorts
  after it are read.  Paths compare as Spark prints them in
  ``_metadata.file_path`` (``file:/a/b``, ``s3a://bucket/key``, special
  characters percent-encoded); ``normalize_marker`` brings a marker
  (absolute, or a name relative to the input folder) into that form.
* A LATEST start (``--from_end``) reads what arrives after the flow first
  starts, whatever its name or modification time: a file renamed into the
  folder is new however old it is.  The ledger of what was there is the
  stream's own list of files seen, kept with its checkpoint: ``pass_by`` lets a
  first micro-batch take in every file present without reading any.  Sinks
  that can't go on from a checkpoint (``memory``) get the listed paths
  anti-joined instead.  A RESUME start goes on from its checkpoint and behaves
  as LATEST without one.

The cut is stored with the checkpoint, so a restart applies the same one.
On a batch read the predicate skips whole files at listing time.  No file is
ever too old to be read (``NEVER_TOO_OLD``).
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.options import FlowOptions, OptionError, StartPosition

MARKER_FILE = "_lineflow_start_marker"
# Fixed value: what java.net.URI leaves as it is in a path, besides letters, digits and non-ASCII characters.
URI_PATH_SAFE = "/:@&=+$,;-_.!~*'()"
# A stream forgets, and skips, files older by this than the newest one it saw; its default is a week.
NEVER_TOO_OLD = "36500d"


@dataclass(frozen=True)
class StartCut:
    """Which blobs a start leaves out: none, names up to ``marker``, or (``arrival``) what was there at the first start."""

    kind: str = "none"
    marker: str | None = None
    present: DataFrame | None = None  # ``path`` of the blobs to leave out, where the checkpoint's own list can't tell


def s3_options(opts: FlowOptions) -> dict[str, str]:
    """Per-read Hadoop options for S3 (OPT-5 as re-aimed).

    Key and secret come together or not at all (a credential provider is
    the normal set-up); the region is handed to s3a unchecked.
    """
    o: dict[str, str] = {}
    if opts.aws_key and opts.aws_secret:
        o["fs.s3a.access.key"] = opts.aws_key
        o["fs.s3a.secret.key"] = opts.aws_secret
    if opts.aws_region:
        o["fs.s3a.endpoint.region"] = opts.aws_region
    return o


def encode_path(path: str) -> str:
    """The path as Spark's metadata prints it: percent-encoded, non-ASCII characters kept."""
    return "".join(c if ord(c) > 127 else quote(c, safe=URI_PATH_SAFE) for c in path)


def normalize_path(path: str) -> str:
    """A folder or file path, given as its plain name, in the form ``_metadata.file_path`` uses."""
    scheme, sep, rest = path.partition("://")
    if sep and scheme != "file":
        return f"{scheme}://{encode_path(rest)}"
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return "file:" + encode_path(os.path.abspath(path))


def normalize_marker(marker: str, root: str) -> str:
    """An absolute marker in Spark's form; a relative one is a name below ``root``."""
    if "://" in marker or marker.startswith("file:") or marker.startswith("/"):
        return normalize_path(marker)
    return normalize_path(root).rstrip("/") + "/" + encode_path(marker)


def _missing(exc: AnalysisException) -> bool:
    return exc.getCondition() == "PATH_NOT_FOUND"


def list_blobs(spark: SparkSession, path: str, recursive: bool = True, glob: str | None = None,
               options: dict[str, str] | None = None) -> DataFrame | None:
    """``path`` of the blobs below ``path`` now, listed without reading content; None for a missing folder."""
    r = spark.read.format("binaryFile").options(**(options or {})).option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    try:
        return r.load(path).select(F.col("_metadata.file_path").alias("path"))
    except AnalysisException as exc:
        if _missing(exc):
            return None
        raise


def stored_cut(spark: SparkSession, checkpoint: str, root: str | None = None) -> StartCut | None:
    """The cut stored with a checkpoint; None when there is none.

    With ``root``, a checkpoint that was made for another input is an
    error rather than a silently foreign cut.
    """
    schema = "root string, kind string, marker string, path string"
    try:
        rows = spark.read.schema(schema).json(f"{checkpoint}/{MARKER_FILE}")
        row = rows.where("kind is not null").first()
    except AnalysisException as exc:
        if _missing(exc):
            return None
        raise
    if row is None:
        return None
    if root is not None and row["root"] != normalize_path(root):
        raise OptionError(f"checkpoint {checkpoint} belongs to input {row['root']}, not {normalize_path(root)}; "
                          "use another --name or --checkpoint")
    present = rows.where("path is not null").select("path")
    return StartCut(row["kind"], row["marker"], None if present.isEmpty() else present)


def store_cut(spark: SparkSession, checkpoint: str, cut: StartCut, root: str) -> None:
    head = spark.createDataFrame([(normalize_path(root), cut.kind, cut.marker, None)],
                                 "root string, kind string, marker string, path string")
    if cut.present is not None:
        head = head.unionByName(cut.present, allowMissingColumns=True)
    head.write.mode("overwrite").json(f"{checkpoint}/{MARKER_FILE}")


def pass_by(spark: SparkSession, stream: DataFrame, checkpoint: str) -> None:
    """Take every file that ``stream`` holds now into the checkpoint's list of files seen, unread.

    One micro-batch lists them and ignores its rows; a query started on the
    checkpoint afterwards gets only files that weren't there.
    """
    query = (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .foreachBatch(lambda batch, batch_id: None).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def resolve_cut(spark: SparkSession, position: StartPosition, root: str, checkpoint: str | None,
                recursive: bool = True, glob: str | None = None, store: bool = True,
                options: dict[str, str] | None = None, unread: DataFrame | None = None) -> StartCut:
    """The cut of a blob source's start, stored with the checkpoint the first time.

    ``unread`` is the stream whose present files a LATEST start passes by;
    without it they are listed.  ``store=False`` (a dry run) computes the cut
    without recording it.
    """
    if checkpoint is not None:
        kept = stored_cut(spark, checkpoint, root)
        if kept is not None:
            return kept
    if position.policy == "EARLIEST":  # POS-5
        cut = StartCut()
    elif position.policy == "EXPLICIT":  # POS-7
        cut = StartCut("name", marker=normalize_marker(position.marker, root))
    elif unread is not None and checkpoint is not None:  # POS-6 LATEST, or POS-8 RESUME without a stored cut
        cut = StartCut("arrival")
        if store:  # a start that dies before the cut is stored passes by what is there at the next one
            pass_by(spark, unread, checkpoint)
    else:
        cut = StartCut("arrival", present=list_blobs(spark, root, recursive, glob, options))
    if checkpoint is not None and store:
        store_cut(spark, checkpoint, cut, root)
        return stored_cut(spark, checkpoint, root) or cut  # the stored list, not a later listing
    return cut


def apply_cut(df: DataFrame, cut: StartCut, path: str = "_metadata.file_path") -> DataFrame:
    """Rows of the blobs that the start leaves in."""
    if cut.kind == "name":
        return after_marker(df, cut.marker, path)
    if cut.present is not None:
        return df.join(cut.present.select(F.col("path").alias("__present")), F.col(path) == F.col("__present"), "left_anti")
    return df


def after_marker(df: DataFrame, marker: str | None, name_col: str = "_metadata.file_path") -> DataFrame:
    """Rows of blobs whose name sorts after ``marker`` (exclusive); all when None."""
    if marker is None:
        return df
    return df.where(F.col(name_col) > F.lit(marker))


def read_blob_lines(spark: SparkSession, opts: FlowOptions, streaming: bool,
                    checkpoint: str | None = None, glob: str | None = None,
                    max_files_per_trigger: int | None = None, whole_files: bool = False,
                    store_marker: bool = True, max_bytes_per_trigger: int | None = None,
                    plan_only: bool = False, resumable: bool = True) -> DataFrame:
    """Line records ``content, metadata, linenumber`` of a file or S3 input.

    A stream is read in line mode, so that a file of any size is split, and
    the result is ``content, metadata, __block`` without numbers: number
    each micro-batch with ``records.number_lines`` inside ``foreachBatch``
    (``streaming.start_flow`` does that).  With ``whole_files`` a stream reads
    each file as one row instead and numbers its lines at once, which limits
    a file to 2 GB.  ``plan_only`` builds a batch plan without running a job;
    ``resumable`` says that the sink can go on from a checkpoint.
    """
    from lineflow.sources.records import read_numbered_lines, recordize, tag_lines

    root = opts.blob_path
    extra = s3_options(opts) if opts.input_kind == "s3" else {}
    pos = opts.start_position()
    if not streaming:
        if pos.policy == "LATEST":
            raise OptionError("--from_end reads nothing from a bounded folder; use a stream")
        marker = normalize_marker(pos.marker, root) if pos.policy == "EXPLICIT" else None
        return read_numbered_lines(spark, root, glob=glob, after_marker=marker, options=extra,
                                   min_splits=opts.input_parallelism, plan_only=plan_only,
                                   spread_to=opts.flow_parallelism)
    if checkpoint is None:
        raise OptionError("a streaming blob source needs a checkpoint location")
    r = spark.readStream.format("text").option("recursiveFileLookup", "true").option("maxFileAge", NEVER_TOO_OLD)
    if whole_files:
        r = r.option("wholetext", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in extra.items():
        r = r.option(k, v)
    cut = resolve_cut(spark, pos, root, checkpoint, glob=glob, store=store_marker, options=extra,
                      unread=r.load(root) if resumable else None)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:  # STR-2 as a byte cap, like the reference's fetch size
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    raw = r.load(root).select("value", "_metadata")
    raw = apply_cut(raw, cut)
    if not whole_files:
        return tag_lines(raw)
    return recordize(raw.select("value", F.col("_metadata.file_path").alias("path")), "value", "path")
