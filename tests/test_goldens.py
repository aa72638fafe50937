"""Goldens G1-G6 and the documentation examples: framed text, byte for byte."""

import glob

import pytest

from lineflow import lookup, python_step, run_frames, tokenize, write_framed_text
from lineflow.functions.udtf import factorize

import examples  # noqa: F401  (registers the spec flows)


def bolt(spark, tmp_path, text: str, flow, delimiter="X") -> str:
    """Run ``flow`` over the lines of ``text`` and return the framed output as one string."""
    src = tmp_path / "in.txt"
    src.write_text(text)
    lines = spark.read.text(str(src))
    frames = run_frames(lines, flow, "value")
    out = tmp_path / "out"
    write_framed_text(frames, "out", str(out), delimiter)
    parts = sorted(glob.glob(str(out / "part-*")))
    return "".join(open(p).read() for p in parts)


@pytest.mark.parametrize(
    "gid,text,flow,expected",
    [
        ("G1", "one event", "simple", "one event\nX\n"),
        ("G2", "never see this", "skipped", "X\n"),
        ("G3", "foo", "multi", "foo\nfoo\nfoo\nX\n"),
        ("G4", '{"foo":"bar"}', "flow", "I raised the bar\nX\n"),
        ("G5", "foo\nbar\nbaz", "simple", "foo\nX\nbar\nX\nbaz\nX\n"),
        ("G6", "hello", "simple", "hello\nX\n"),
    ],
)
def test_golden(spark, tmp_path, gid, text, flow, expected):
    assert bolt(spark, tmp_path, text, lookup(flow)) == expected


def test_tokenizer_docs(spark, tmp_path):
    assert bolt(spark, tmp_path, "adds a terminator\n", tokenize(), "---") == "adds\na\nterminator\n---\n"
    assert bolt(spark, tmp_path, "\n", tokenize(), "---") == "---\n"


def test_prime_factor_docs(spark, tmp_path):
    step = python_step(lambda s: [str(p) for p in factorize(int(s))], "prime_factorizer")
    assert bolt(spark, tmp_path, "2\n12\n19\n", step, "---") == "2\n---\n2\n2\n3\n---\n19\n---\n"


def test_interpolate_missing_field_is_empty(spark, tmp_path):
    assert bolt(spark, tmp_path, '{"bar":1}', lookup("flow")) == "I raised the \nX\n"


def test_bad_json_gives_empty_frame(spark, tmp_path):
    out = bolt(spark, tmp_path, '{"foo":"a"}\njunk\n{"foo":"b"}\n', lookup("flow"))
    assert out == "I raised the a\nX\nX\nI raised the b\nX\n"
