"""Option fixtures (FIXTURES 3) and option checks OPT-1..7."""

import json

import pytest

from lineflow.options import FlowOptions, OptionError
from lineflow.plans.registry import UnknownFlowError, lookup
from lineflow.sources.files import normalize_marker, s3_options
from lineflow.sources.kafka import kafka_reader_options

import examples  # noqa: F401


def args(s):
    return FlowOptions.from_args(s.split())


def test_kafka_defaults():
    o = args("identity --input=foo --output=bar")
    assert o.input_kind == "kafka" and o.kafka_topic == "foo" and o.output == "bar"
    assert o.kafka_partitions == 1 and o.kafka_batch == 1_048_576
    ko = kafka_reader_options(o)
    assert ko["subscribe"] == "foo" and ko["kafka.bootstrap.servers"] == "localhost:9092"
    assert ko["kafka.max.partition.fetch.bytes"] == "1048576" and ko["startingOffsets"] == "latest"


@pytest.mark.parametrize("flag,policy,offset,starting", [
    ("--from_beginning", "EARLIEST", -2, "earliest"),
    ("--from_end", "LATEST", -1, "latest"),
    ("--offset=1234", "EXPLICIT", 1234, None),
])
def test_kafka_offsets(flag, policy, offset, starting):
    o = args(f"identity --input=foo --output=bar --kafka_partitions=2 {flag}")
    pos = o.start_position()
    assert (pos.policy, pos.offset) == (policy, offset)
    so = kafka_reader_options(o)["startingOffsets"]
    if starting:
        assert so == starting
    else:
        assert json.loads(so) == {"foo": {"0": 1234, "1": 1234}}


def test_kafka_precedence():
    o = args("identity --input=foo --output=bar --from_end --offset=5 --from_beginning")
    assert o.start_position().policy == "EARLIEST"


def test_file_input():
    o = args("identity --input=file:///foo/bar --output=bar")
    assert o.input_kind == "file" and o.blob_path == "file:/foo/bar"
    assert o.start_position().policy == "RESUME"


@pytest.mark.parametrize("flag,policy", [("--from_beginning", "EARLIEST"), ("--from_end", "LATEST"),
                                         ("--offset=bing-1", "EXPLICIT")])
def test_file_positions_keep_marker(flag, policy):
    o = args(f"identity --input=file:///foo/bar --output=bar {flag} --offset=bing-1")
    pos = o.start_position()
    assert pos.policy == policy and pos.marker == "bing-1"
    assert normalize_marker(pos.marker, o.blob_path) == "file:/foo/bar/bing-1"


def test_s3_input():
    o = args("identity --input=s3://foo/bar --output=bar --aws_key=K --aws_secret=S")
    assert o.input_kind == "s3" and o.s3_bucket == "foo" and o.s3_prefix == "bar"
    assert o.blob_path == "s3a://foo/bar" and o.start_position().policy == "RESUME"
    assert s3_options(o) == {"fs.s3a.access.key": "K", "fs.s3a.secret.key": "S",
                             "fs.s3a.endpoint.region": "us-east-1"}
    o.validate()


def test_s3_key_and_secret_together():
    with pytest.raises(OptionError):
        args("identity --input=s3://foo/bar --output=bar --aws_key=K").validate()
    with pytest.raises(OptionError):
        args("identity --input=s3:///bar --output=bar").validate()
    args("identity --input=s3://foo --output=bar").validate()  # whole bucket (D11)


def test_name():
    o = args("identity --name=myFlow --input=foo --output=bar")
    assert o.query_name == "myFlow" and o.dataflow_name == "identity"
    assert args("identity --input=foo --output=bar").query_name == "identity"


@pytest.mark.parametrize("line", [
    "--input=foo --output=bar",
    "identity --output=bar",
    "identity --input=foo",
    "identity --input=foo --output=bar --kafka_hosts=",
    "identity --input=foo --output=bar --kafka_hosts=a:1:2",
    "identity --input=ftp://x/y --output=bar",
    "identity --input=foo --output=bar --parallelism=0",
])
def test_invalid(line):
    with pytest.raises(OptionError):
        args(line).validate()


def test_unknown_flow():
    with pytest.raises(UnknownFlowError, match="no processor or dataflow named 'nope'"):
        lookup("nope")
    with pytest.raises(UnknownFlowError):
        lookup(None)


def test_hosts_get_ports():
    o = FlowOptions.from_args(["identity", "--input=foo", "--output=bar", "--kafka_hosts=a,b:1234, c"])
    assert o.kafka_servers == "a:9092,b:1234,c:9092"


def test_command_line():
    o = args("my_flow --input=foo --output=bar --command_prefix=bundle_exec --foo=bar --baz")
    assert o.extra == {"foo": "bar", "baz": "true"}
    assert o.bolt_argv(["run-flow"]) == ["bundle_exec", "run-flow", "my_flow", "--baz=true", "--foo=bar"]
    c = FlowOptions(bolt_command="my_cmd --some-option=value -af -q 3", input="foo", output="bar")
    assert c.command_argv() == ["my_cmd", "--some-option=value", "-af", "-q", "3"]
    assert c.dataflow_name == "my_cmd" and c.validate()  # a command alone is valid (D9)


def test_parallelism_defaults_to_source():
    assert args("x --input=foo --output=bar --input_parallelism=3").flow_parallelism == 3
    assert args("x --input=foo --output=bar --input_parallelism=3 --parallelism=5").flow_parallelism == 5
    assert kafka_reader_options(args("x --input=foo --output=bar --input_parallelism=3"))["minPartitions"] == "3"


def test_builtin_names_resolve():
    for name in ("identity", "upcaser", "tokenizer", "from_json", "to_json", "prime_factorizer"):
        assert lookup(name).steps


def test_engine_options_are_not_passed_to_commands():
    o = args("my_flow --input=t --output=o --workers=4 --zookeeper_hosts=z1 --resume --size=3")
    assert o.engine == {"workers": "4", "zookeeper_hosts": "z1", "resume": "true"}
    assert o.extra == {"size": "3"}
    assert o.bolt_argv(["prog"]) == ["prog", "my_flow", "--size=3"]


def test_short_flags():
    o = FlowOptions.from_args(["-r", "simple", "-t", "---", "--input=x", "--output=y"])
    assert o.flow == "simple" and o.delimiter == "---"
