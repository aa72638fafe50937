"""Launch options of a flow: what to read, what to run, where to write.

One dataclass holds every option; ``validate`` applies the option checks
(OPT-1..7), ``input_kind`` the URI-scheme rule (SRC-7) and
``start_position`` the precedence of start positions (POS-1..8).
``FlowOptions.from_args`` reads the ``--key=value`` command-line form;
unknown options are kept in ``extra`` and passed on to an external
command (EXT-5).
"""

from __future__ import annotations

import shlex
from dataclasses import dataclass, field, fields
from urllib.parse import urlparse

# Fixed values that must equal the reference's defaults.
DEFAULT_KAFKA_PORT = 9092
DEFAULT_KAFKA_BATCH_BYTES = 1_048_576
DEFAULT_WAIT_SECONDS = 300
DEFAULT_BOLT_DELIMITER = "X"
DEFAULT_ENVIRONMENT = "development"
KAFKA_EARLIEST = -2
KAFKA_LATEST = -1
# Other schemes of Hadoop file systems that Spark reads as folders, besides file: and S3.
FILE_SYSTEM_SCHEMES = frozenset({"hdfs", "viewfs", "abfs", "abfss", "gs", "wasb", "wasbs"})
# Launcher options of the reference that configure its engine or cluster.  Spark
# configuration replaces them; they are accepted, shown by a dry run, and never passed to commands.
ENGINE_OPTIONS = frozenset({
    "resume", "debug", "optimize", "timeout", "workers", "worker_opts", "ackers", "sample_rate",
    "nimbus_host", "nimbus_port", "zookeeper_hosts", "storm_home", "storm_runner",
})


class OptionError(ValueError):
    """An option is missing or malformed."""


@dataclass(frozen=True)
class StartPosition:
    """Where a source starts.

    ``policy`` is one of EARLIEST, LATEST, EXPLICIT, RESUME.  ``offset`` is
    the Kafka offset (-2, -1 or N) and ``marker`` the blob marker; a blob
    marker given with ``--offset`` is always carried, even when an earlier
    rule picked the policy.
    """

    policy: str
    offset: int | None = None
    marker: str | None = None


_BOOL_OPTIONS = {"from_beginning", "from_end", "rm", "dry_run"}
# The short flags of the bolt command.
_SHORT_FLAGS = {"-r": "run", "-t": "delimiter"}
_INT_OPTIONS = {"kafka_partitions", "kafka_batch", "input_parallelism", "parallelism", "wait", "command_session_bytes"}
_FLOAT_OPTIONS = {"command_timeout"}


@dataclass
class FlowOptions:
    flow: str | None = None
    bolt_command: str | None = None
    bolt_program: str | None = None
    command_prefix: str | None = None
    name: str | None = None
    input: str | None = None
    output: str | None = None
    offset: str | None = None
    from_beginning: bool = False
    from_end: bool = False
    kafka_hosts: str = "localhost"
    kafka_partitions: int = 1
    kafka_batch: int = DEFAULT_KAFKA_BATCH_BYTES
    input_parallelism: int = 1
    parallelism: int | None = None
    spread: str = "records"  # what a wider flow gets equal shares of: records or bytes
    aws_key: str | None = None
    aws_secret: str | None = None
    aws_region: str | None = "us-east-1"
    delimiter: str = DEFAULT_BOLT_DELIMITER
    wait: int = DEFAULT_WAIT_SECONDS
    rm: bool = False
    dry_run: bool = False
    directory: str | None = None
    command_timeout: float | None = None  # seconds a command may be silent; none by default
    command_session_bytes: int | None = None  # input of one child of a command; 256 MB by default
    environment: str = DEFAULT_ENVIRONMENT
    extra: dict[str, str] = field(default_factory=dict)
    engine: dict[str, str] = field(default_factory=dict)

    # ------------------------------------------------------------------ parse
    @classmethod
    def from_args(cls, argv: list[str]) -> FlowOptions:
        """Read ``FLOW --key=value --flag ...``; ``--run=FLOW`` or ``-r FLOW`` also names the flow."""
        known = {f.name for f in fields(cls)} - {"extra", "engine"}
        values: dict[str, object] = {}
        extra: dict[str, str] = {}
        engine: dict[str, str] = {}
        positional: list[str] = []
        args = list(argv)
        while args:
            arg = args.pop(0)
            if arg in _SHORT_FLAGS and args:  # -r FLOW, -t TERMINATOR
                arg = f"--{_SHORT_FLAGS[arg]}={args.pop(0)}"
            if not arg.startswith("--"):
                positional.append(arg)
                continue
            key, eq, raw = arg[2:].partition("=")
            key = key.replace("-", "_")
            if key == "run":
                key = "flow"
            if key in ENGINE_OPTIONS:
                engine[key] = raw if eq else "true"
                continue
            if key not in known:
                extra[key] = raw if eq else "true"
                continue
            if key in _BOOL_OPTIONS:
                values[key] = (raw.lower() not in ("false", "0", "no")) if eq else True
            elif key in _INT_OPTIONS or key in _FLOAT_OPTIONS:
                try:
                    values[key] = int(raw) if key in _INT_OPTIONS else float(raw)
                except ValueError as exc:
                    raise OptionError(f"--{key} needs {'an integer' if key in _INT_OPTIONS else 'a number'}, got {raw!r}") from exc
            else:
                values[key] = raw
        if positional and "flow" not in values:
            values["flow"] = positional[0]
        return cls(**values, extra=extra, engine=engine)

    # ------------------------------------------------------------------ names
    @property
    def dataflow_name(self) -> str | None:
        """The flow's name; with only a command, the command's program (D9)."""
        if self.flow:
            return self.flow
        if self.bolt_command:
            argv = shlex.split(self.bolt_command)
            return argv[0].rsplit("/", 1)[-1] if argv else None
        return None

    @property
    def query_name(self) -> str | None:
        """Name of the running query: ``--name``, else the flow's name."""
        return self.name or self.dataflow_name

    @property
    def flow_parallelism(self) -> int:
        """``--parallelism``, defaulting to the source's (PAR-3)."""
        return self.parallelism if self.parallelism is not None else self.input_parallelism

    # ------------------------------------------------------------------ input
    @property
    def input_kind(self) -> str:
        """``s3``, ``file`` or ``kafka`` by the input's URI scheme (SRC-7).

        A plain name is a Kafka topic; any other scheme is an error (D12).
        """
        if not self.input:
            raise OptionError("an --input is required")
        scheme = urlparse(self.input).scheme
        if scheme in ("s3", "s3a", "s3n"):
            return "s3"
        if scheme == "file" or scheme in FILE_SYSTEM_SCHEMES:
            return "file"
        if scheme == "":
            return "kafka"
        raise OptionError(f"unknown input scheme {scheme!r} in {self.input!r}")

    @property
    def is_blob_input(self) -> bool:
        return self.input_kind in ("s3", "file")

    @property
    def blob_path(self) -> str:
        """Path for the file source, scheme kept: ``file:/a``, ``hdfs://host/a`` or ``s3a://bucket/key``.

        ``#`` and ``?`` are part of a name (``?`` matches one character, as
        Hadoop paths do), not URL syntax.
        """
        scheme, _, rest = (self.input or "").partition(":")
        if self.input_kind == "s3":
            return f"s3a://{self.s3_bucket}/{self.s3_prefix}"
        if scheme != "file":
            return self.input
        path = self._file_path
        return f"file:{path}" if path else ""

    @property
    def _file_path(self) -> str:
        rest = (self.input or "").partition(":")[2]
        if rest.startswith("//"):  # file://host/path; the host is this file system's own
            return "/" + rest[2:].partition("/")[2] if "/" in rest[2:] else ""
        return rest

    @property
    def s3_bucket(self) -> str:
        return (self.input or "").partition("://")[2].partition("/")[0]

    @property
    def s3_prefix(self) -> str:
        return (self.input or "").partition("://")[2].partition("/")[2].lstrip("/")

    @property
    def kafka_topic(self) -> str:
        return self.input or ""

    @property
    def kafka_servers(self) -> str:
        """Every host with a port, ``:9092`` when none is given (OPT-6)."""
        hosts = [h.strip() for h in (self.kafka_hosts or "").split(",") if h.strip()]
        if not hosts:
            raise OptionError("--kafka_hosts must name at least one host")
        out = []
        for h in hosts:
            parts = h.split(":")
            if len(parts) > 2:
                raise OptionError(f"bad Kafka host {h!r}: use HOST[:PORT]")
            if len(parts) == 2 and not parts[1].isdigit():
                raise OptionError(f"bad Kafka port in {h!r}")
            out.append(h if len(parts) == 2 else f"{h}:{DEFAULT_KAFKA_PORT}")
        return ",".join(out)

    def start_position(self) -> StartPosition:
        """Precedence: from_beginning, from_end, offset, resume (POS-1..8)."""
        if self.is_blob_input:
            marker = self.offset
            if self.from_beginning:  # POS-5
                return StartPosition("EARLIEST", marker=marker)
            if self.from_end:  # POS-6
                return StartPosition("LATEST", marker=marker)
            if self.offset is not None:  # POS-7
                return StartPosition("EXPLICIT", marker=marker)
            return StartPosition("RESUME", marker=marker)  # POS-8
        if self.from_beginning:  # POS-1
            return StartPosition("EARLIEST", offset=KAFKA_EARLIEST)
        if self.from_end:  # POS-2
            return StartPosition("LATEST", offset=KAFKA_LATEST)
        if self.offset is not None:  # POS-3
            try:
                return StartPosition("EXPLICIT", offset=int(self.offset))
            except ValueError as exc:
                raise OptionError(f"a Kafka --offset must be an integer, got {self.offset!r}") from exc
        return StartPosition("RESUME")  # POS-4

    # ------------------------------------------------------------------ command
    def command_argv(self) -> list[str] | None:
        """Argument list of the external record command (EXT-5), or None.

        ``--bolt_command`` is used as given.  With ``--bolt_program`` a
        named flow runs through that program speaking the protocol, as
        ``[prefix..., program..., flow, --k=v for every extra option]``.
        Otherwise the flow runs natively (None).
        """
        if self.bolt_command:
            return shlex.split(self.bolt_command)
        if self.bolt_program:
            return self.bolt_argv(shlex.split(self.bolt_program))
        return None

    def bolt_argv(self, program: list[str]) -> list[str]:
        """``prefix + program + [flow] + --k=v`` for a bolt program speaking the protocol."""
        prefix = shlex.split(self.command_prefix) if self.command_prefix else []
        tail = [f"--{k}={v}" for k, v in sorted(self.extra.items())]
        return [*prefix, *program, *([self.flow] if self.flow else []), *tail]

    # ------------------------------------------------------------------ checks
    def validate(self, sink: str = "kafka") -> FlowOptions:
        """Raise OptionError on the first failed check (OPT-1..7)."""
        if not (self.flow or self.bolt_command):  # OPT-1
            raise OptionError("provide a dataflow to run (a flow name, --run or --bolt_command)")
        if not self.input:  # OPT-2
            raise OptionError("an --input is required")
        if not self.output:  # OPT-3
            raise OptionError("an --output is required")
        kind = self.input_kind
        if kind == "kafka" or sink == "kafka":  # OPT-4, OPT-6
            self.kafka_servers  # raises on empty or malformed hosts
        if kind == "kafka" and not self.kafka_topic:  # OPT-7
            raise OptionError("Kafka input needs a topic")
        if kind == "file" and not self.blob_path:
            raise OptionError("file input needs a path")
        if kind == "s3":  # OPT-5
            if not self.s3_bucket:
                raise OptionError("S3 input needs a bucket")
            if bool(self.aws_key) != bool(self.aws_secret):
                raise OptionError("give --aws_key and --aws_secret together, or neither")
        if self.kafka_partitions < 1 or self.input_parallelism < 1 or self.flow_parallelism < 1:
            raise OptionError("partitions and parallelism must be positive")
        if self.spread not in ("records", "bytes"):
            raise OptionError("--spread is records or bytes")
        if self.kafka_batch < 1:
            raise OptionError("--kafka_batch must be positive")
        if self.command_timeout is not None and self.command_timeout <= 0:
            raise OptionError("--command_timeout must be positive")
        if self.command_session_bytes is not None and self.command_session_bytes <= 0:
            raise OptionError("--command_session_bytes must be positive")
        if self.wait < 0:
            raise OptionError("--wait must not be negative")
        return self
