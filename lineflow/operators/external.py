"""External commands as record functions (EXT-1, EXT-4, EXT-5, EXT-6, UDF-4).

The command speaks the line protocol: for every input line it writes its
output lines and then a terminator line.  Each Spark task starts one child
(only when its partition has records), feeds it Arrow batches through
``mapInArrow`` and splits the answer back into one frame per input, so
provenance stays exact.  Input is written by a separate thread while the
task reads, which overlaps the two directions without ever deadlocking on full
pipes and also serves commands that buffer their input or output by
block; frames still pair with inputs by order.

A task's input is cut into sessions of at most ``session_bytes``, by the sizes
of its batches alone, with one child each: the child gets the session's
input, its input is closed, and its frames are read to the end before the
next child starts.  A command that reads everything before it answers (a sort,
any filter that buffers) therefore answers whatever the size of the
partition, however long it takes, and a task never holds more than one
session's input.

Failures raise ``FrameProtocolError`` naming the input concerned: a child
that ends early, omits a terminator, prints past its last frame (an output
equal to the terminator looks like that), prints bytes that are not UTF-8,
exits non-zero, or is silent for longer than the timeout (each piece of
output starts it anew; by default there is none).  A record holding a newline cannot be sent on a line
protocol and is rejected.  Spark may retry a failed task, so a command's
side effects are at-least-once.
"""

from __future__ import annotations

import os
import queue
import select
import subprocess
import threading
from collections import deque
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from lineflow.operators.batch import frame_schema, text_frames
from lineflow.options import DEFAULT_ENVIRONMENT
from lineflow.plans.flow import Step

SPARK_FILE_PREFIX = "sparkfile:"
ENVIRONMENT_VARIABLE = "LINEFLOW_ENVIRONMENT"


# Input of one child, in bytes of Arrow data: what a task holds while frames are outstanding.
SESSION_BYTES = 256 << 20


class FrameProtocolError(RuntimeError):
    """The command broke the framing protocol."""


class _Session:
    """One child and what it was given."""

    def __init__(self, child: _Child):
        self.child = child
        self.sent = 0  # bytes of its batches
        self.over = threading.Event()  # its frames are read, or the task has ended


def _resolve(argv: Sequence[str]) -> list[str]:
    """Map ``sparkfile:NAME`` arguments to files shipped with ``SparkContext.addFile``."""
    if not any(a.startswith(SPARK_FILE_PREFIX) for a in argv):
        return list(argv)
    from pyspark import SparkFiles

    return [SparkFiles.get(a[len(SPARK_FILE_PREFIX):]) if a.startswith(SPARK_FILE_PREFIX) else a for a in argv]


class _Child:
    """One child process per task: a writer thread feeds it, the task reads frames."""

    def __init__(self, argv: list[str], delimiter: str, cwd: str | None, env: Mapping[str, str],
                 timeout: float | None):
        self.argv = argv
        self.delimiter = delimiter
        self.timeout = timeout
        self.timed_out = False
        self.stderr_tail: deque[str] = deque(maxlen=20)
        self.proc = subprocess.Popen(argv, stdin=subprocess.PIPE, stdout=subprocess.PIPE,
                                     stderr=subprocess.PIPE, cwd=cwd, env=dict(env))
        self._err_thread = threading.Thread(target=self._drain_stderr, daemon=True)
        self._err_thread.start()
        self._out_fd = self.proc.stdout.fileno()
        self._lines: list[str] = []  # decoded output lines read ahead
        self._pos = 0  # next unread line
        self._partial = b""  # bytes after the last newline
        self._eof = False

    def _more(self) -> bool:
        """Read one more chunk of output; False at end of output.

        A chunk is decoded once and split in C; a line ending in CR (a CRLF
        child) loses the CR, as a line reader would.
        """
        if self._eof:
            return False
        if self.timeout and not select.select([self._out_fd], [], [], self.timeout)[0]:
            self._kill()
        chunk = os.read(self._out_fd, 1 << 16)
        if not chunk:
            self._eof = True
            if not self._partial:
                return False
            data, self._partial = self._partial, b""
            lines = [self._text(data)]
        else:
            data = self._partial + chunk
            cut = data.rfind(b"\n")
            if cut < 0:
                self._partial = data
                return True
            self._partial = data[cut + 1:]
            lines = self._text(data[:cut]).split("\n")
        if any(line.endswith("\r") for line in lines):
            lines = [line[:-1] if line.endswith("\r") else line for line in lines]
        self._lines.extend(lines)
        return True

    def _text(self, data: bytes) -> str:
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError as exc:
            raise self.fail(f"output is not UTF-8: {data[max(0, exc.start - 20):exc.end + 20]!r}") from None

    def _drain_stderr(self) -> None:
        for line in self.proc.stderr:
            self.stderr_tail.append(line.decode("utf-8", "replace").rstrip("\n"))

    def _kill(self) -> None:
        self.timed_out = True
        self.proc.kill()

    def fail(self, msg: str) -> FrameProtocolError:
        self.proc.kill()
        self._err_thread.join(timeout=1)
        tail = " | ".join(self.stderr_tail)
        why = " (read timeout)" if self.timed_out else ""
        return FrameProtocolError(f"command {self.argv!r}: {msg}{why}; stderr: {tail or '(empty)'}")

    def write(self, records: list[str]) -> None:
        self.proc.stdin.write("".join(f"{r}\n" for r in records).encode("utf-8"))

    def close_input(self) -> None:
        try:
            self.proc.stdin.close()
        except OSError:
            pass

    def read_frames(self, records: list[str]) -> list[list[str]]:
        """One list of output lines per record, read in order."""
        if self._pos:  # drop the lines of earlier batches; no index into them is held
            del self._lines[:self._pos]
            self._pos = 0
        frames: list[list[str]] = []
        delim = self.delimiter
        search_from = 0
        while len(frames) < len(records):
            try:
                end = self._lines.index(delim, search_from)
            except ValueError:
                search_from = len(self._lines)
                if not self._more():
                    raise self.fail(
                        f"output ended after {len(frames)} of {len(records)} frames of a batch "
                        f"(early exit or missing terminator); input was {records[len(frames)]!r}"
                    ) from None
                continue
            frames.append(self._lines[self._pos:end])
            self._pos = search_from = end + 1
        return frames

    def finish(self) -> None:
        """After the last frame: no further output and a zero exit."""
        while not self._lines[self._pos:] and self._more():
            pass
        rest = "\n".join(self._lines[self._pos:])
        if rest.strip():
            raise self.fail(f"printed past its last frame: {rest[:200]!r} "
                            "(an output equal to the terminator, or an extra frame)")
        try:
            code = self.proc.wait(self.timeout)
        except subprocess.TimeoutExpired:
            self._kill()
            raise self.fail("did not exit after its last frame") from None
        self._err_thread.join(timeout=5)
        if code != 0:
            raise self.fail(f"exited with status {code}")

    def close(self) -> None:
        self.close_input()
        if self.proc.poll() is None:
            self.proc.kill()
            self.proc.wait()


_DONE = object()


def command_step(
    argv: Sequence[str],
    delimiter: str = "---",
    cwd: str | None = None,
    environment: str = DEFAULT_ENVIRONMENT,
    env: Mapping[str, str] | None = None,
    timeout: float | None = None,
    name: str | None = None,
    session_bytes: int = SESSION_BYTES,
) -> Step:
    """A table step running ``argv`` (a list, never a shell string) on sessions of each task's input.

    ``delimiter`` is the terminator the command writes (EXT-4), ``cwd`` and
    ``environment`` where and in which named environment it runs (EXT-6);
    ``timeout`` is how many seconds the command may be silent, or take to
    exit after its last frame (None: no bound).  ``session_bytes`` bounds the
    input of one child, and with it what a task holds; a single larger batch is
    a session of its own.
    """
    argv = list(argv)
    if not argv:
        raise ValueError("an external command needs a program")
    extra_env = dict(env or {})

    def apply(df: DataFrame, frame: str) -> DataFrame:
        from lineflow.session import ship_package

        ship_package(df.sparkSession)
        df, _ = text_frames(df, frame)  # parsed records go out as JSON lines
        out_schema = frame_schema(df.schema, frame)
        idx = df.columns.index(frame)
        list_type = pa.list_(pa.string())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # The writer thread streams every batch into the child and then
            # closes its input; this thread reads frames in the same order.
            # Commands that flush per line and commands that buffer by block
            # both work, and full pipes cannot deadlock the two sides.
            pending: queue.SimpleQueue = queue.SimpleQueue()  # bounded by the session
            box: dict[str, object] = {}
            stop = threading.Event()

            def open_session() -> _Session:
                env_ = {**os.environ, **extra_env, ENVIRONMENT_VARIABLE: environment}
                box["session"] = _Session(_Child(_resolve(argv), delimiter, cwd, env_, timeout))
                return box["session"]

            def feed() -> None:
                session: _Session | None = None
                try:
                    for batch in batches:
                        if stop.is_set():  # the task ended early: read no more input
                            break
                        per_input = batch.column(idx).to_pylist()
                        flat = [r for recs in per_input for r in (recs or []) if r is not None]
                        for r in flat:
                            if "\n" in r:
                                raise FrameProtocolError(f"record holds a newline and cannot be sent: {r[:200]!r}")
                        if session is not None and session.sent + batch.nbytes > session_bytes:
                            session.child.close_input()
                            pending.put((session, None, None, None))
                            session.over.wait()
                            session = None
                            if stop.is_set():
                                break
                        if flat and session is None:
                            session = open_session()
                        pending.put((session, batch, per_input, flat))
                        if session is not None:
                            session.sent += batch.nbytes
                        for at in range(0, len(flat), 1000):
                            session.child.write(flat[at:at + 1000])
                except BaseException as exc:  # noqa: BLE001 - handed to the task thread
                    box["error"] = exc
                finally:
                    if session is not None:
                        session.child.close_input()
                    pending.put(_DONE)

            writer = threading.Thread(target=feed, daemon=True)
            writer.start()
            try:
                last: _Session | None = None
                while True:
                    item = pending.get()
                    if item is _DONE:
                        break
                    last, batch, per_input, flat = item
                    if batch is None:  # the session's input is closed
                        last.child.finish()
                        last.child.close()
                        last.over.set()
                        last = None
                        continue
                    frames = iter(last.child.read_frames(flat)) if flat else iter(())
                    new = []
                    for recs in per_input:
                        out: list[str] = []
                        for r in recs or []:
                            if r is not None:
                                out.extend(next(frames))
                        new.append(out)
                    cols = list(batch.columns)
                    cols[idx] = pa.array(new, type=list_type)
                    yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
                writer.join()
                if "error" in box:
                    err = box["error"]
                    if isinstance(err, (BrokenPipeError, OSError)) and "session" in box:
                        raise box["session"].child.fail(f"could not write input: {err}")
                    raise err
                if last is not None:
                    last.child.finish()
            finally:
                stop.set()
                session = box.get("session")
                if session is not None:
                    session.over.set()
                    session.child.close()

        return df.mapInArrow(run, out_schema)

    return Step(name or os.path.basename(argv[0]), "table", apply)
