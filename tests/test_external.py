"""External commands (EXT-1, EXT-4..6) and their failure modes."""

import sys

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from lineflow import command_step, run_frames, run_records

ECHO_WORDS = ["awk", '{ for (i = 1; i <= NF; i++) print $i; print "---"; fflush() }']


def py(code):
    return [sys.executable, "-c", code]


def lines(spark, values, parts=1):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, str string").repartition(parts, "id")


def test_words(spark):
    df = lines(spark, ["a b", "", "c", "d e f"], parts=3)
    out = run_frames(df, command_step(ECHO_WORDS), "str", keep=["id"]).orderBy("id").collect()
    assert [r.out for r in out] == [["a", "b"], [], ["c"], ["d", "e", "f"]]


def test_terminator_and_env(spark, tmp_path):
    code = ("import os, sys\n"
            "for line in sys.stdin:\n"
            "    print(os.environ['LINEFLOW_ENVIRONMENT'], os.getcwd(), line.strip(), sep='|')\n"
            "    print('END', flush=True)\n")
    step = command_step(py(code), delimiter="END", cwd=str(tmp_path), environment="production")
    out = run_records(lines(spark, ["x"]), step, "str").collect()
    assert [r.record for r in out] == [f"production|{tmp_path}|x"]


def test_block_buffered_child(spark):
    # writes everything at end of input: still paired correctly
    code = "import sys\nrows = sys.stdin.read().splitlines()\nsys.stdout.write(''.join(r.upper() + '\\n---\\n' for r in rows))\n"
    out = run_records(lines(spark, [f"w{i}" for i in range(5000)], parts=2), command_step(py(code)), "str",
                      keep=["id"]).collect()
    assert sorted((r.id, r.record) for r in out) == [(i, f"W{i}") for i in range(5000)]


@pytest.mark.parametrize("code,msg", [
    ("import sys\nprint(sys.stdin.readline().strip()); print('---')", "output ended after 1 of 3"),
    ("import sys\nfor l in sys.stdin: print(l.strip(), flush=True)", "output ended"),
    ("import sys\nfor l in sys.stdin: print('---'); print('---', flush=True)", "printed past its last frame"),
    ("import sys\nfor l in sys.stdin: print('---', flush=True)\nsys.exit(3)", "exited with status 3"),
])
def test_hostile_commands(spark, code, msg):
    with pytest.raises(PythonException, match=msg):
        run_records(lines(spark, ["a", "b", "c"]), command_step(py(code)), "str").collect()


def test_newline_in_record_rejected(spark):
    with pytest.raises(PythonException, match="newline"):
        run_records(lines(spark, ["a\nb"]), command_step(ECHO_WORDS), "str").collect()


def test_timeout(spark):
    step = command_step(py("import time\ntime.sleep(30)"), timeout=1)
    with pytest.raises(PythonException, match="read timeout"):
        run_records(lines(spark, ["a"]), step, "str").collect()


def test_no_child_for_empty_partitions(spark):
    # a command that would fail is never started when no record reaches it
    df = lines(spark, ["a"]).where("id < 0")
    assert run_records(df, command_step(["false"]), "str").count() == 0


def test_bolt_program_with_prefix_and_settings(spark, tmp_path):
    from lineflow import FlowOptions
    from lineflow.plans.topology import resolve_flow

    prog = tmp_path / "bolt.py"
    prog.write_text(
        "import sys\n"
        "args = sys.argv[1:]\n"
        "for line in sys.stdin:\n"
        "    print(' '.join(args) + ':' + line.strip())\n"
        "    print('---', flush=True)\n")
    o = FlowOptions.from_args(["my_flow", "--input=t", "--output=o", f"--command_prefix={sys.executable}",
                               f"--bolt_program={prog}", "--delimiter=---", "--size=3"])
    assert o.command_argv() == [sys.executable, str(prog), "my_flow", "--size=3"]
    out = run_records(lines(spark, ["a"]), resolve_flow(o), "str").collect()
    assert [r.record for r in out] == ["my_flow --size=3:a"]


def test_crlf_child(spark):
    code = "import sys\nfor l in sys.stdin:\n    sys.stdout.write(l.strip() + '\\r\\n---\\r\\n')\n"
    out = run_records(lines(spark, ["a", "b"]), command_step(py(code)), "str").collect()
    assert sorted(r.record for r in out) == ["a", "b"]


def test_missing_program(spark):
    with pytest.raises(PythonException, match="No such file|not found"):
        run_records(lines(spark, ["a"]), command_step(["no-such-program-lineflow"]), "str").collect()


def test_many_batches_per_task(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        vals = [" ".join(f"w{i}_{j}" for j in range(i % 4)) for i in range(2500)]
        out = run_records(lines(spark, vals, parts=2), command_step(ECHO_WORDS), "str", keep=["id"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    expect = sorted((i, f"w{i}_{j}") for i in range(2500) for j in range(i % 4))
    assert sorted((r.id, r.record) for r in out) == expect


def test_slow_steady_command_finishes(spark):
    code = "import sys, time\nfor l in sys.stdin:\n    time.sleep(0.4)\n    print(l.strip())\n    print('---', flush=True)\n"
    step = command_step(py(code), timeout=2)  # the batch takes longer than that
    assert len(run_records(lines(spark, [f"w{i}" for i in range(10)]), step, "str").collect()) == 10


def test_command_that_never_exits(spark):
    code = "import sys, time\nfor l in sys.stdin: print('---', flush=True)\nimport os; os.close(1)\ntime.sleep(60)"
    with pytest.raises(PythonException, match="did not exit"):
        run_records(lines(spark, ["a"]), command_step(py(code), timeout=1), "str").collect()


def test_output_that_is_not_text(spark):
    code = "import sys\nfor l in sys.stdin:\n    sys.stdout.buffer.write(b'a\\xff\\n---\\n')\n"
    with pytest.raises(PythonException, match="not UTF-8"):
        run_records(lines(spark, ["a"]), command_step(py(code)), "str").collect()


def test_commands_that_answer_at_the_end_of_their_input(spark):
    """Each session has a child of its own, which may keep all its input before it answers."""
    code = ("import os, sys\nheld = [l.strip() for l in sys.stdin]\n"
            "for l in held: print(l, os.getpid(), len(held)); print('---')\n")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        vals = [f"w{i}" + "x" * 100 for i in range(2500)]
        for limit in (30_000, 1):  # about two batches, and every batch alone
            out = run_records(lines(spark, vals, parts=2), command_step(py(code), session_bytes=limit), "str", keep=["id"]).collect()
            assert sorted((r.id, r.record.split()[0]) for r in out) == list(enumerate(vals))
            sizes = {r.record.split()[1]: int(r.record.split()[2]) for r in out}
            assert sum(sizes.values()) == 2500 and max(sizes.values()) <= (300 if limit > 1 else 100) and len(sizes) >= 2500 // 300
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_a_late_answer_holds_one_session(spark):
    """A whole sort over a partition much larger than a session: no child and no task holds more than a session."""
    code = ("import sys\nheld = sorted((l.strip() for l in sys.stdin), reverse=True)\n"
            "for l in held: print(len(held)); print('---')\n")
    text = F.concat(F.col("id").cast("string"), F.repeat(F.lit("y"), 1000))
    df = spark.range(0, 60_000, 1, 1).select(text.alias("str"))
    out = run_records(df, command_step(py(code), session_bytes=12 << 20), "str").collect()
    assert len(out) == 60_000
    assert max(int(r.record) for r in out) * 1000 <= 12 << 20


def test_a_failing_session_fails_the_task(spark):
    code = "import sys\nn = sum(1 for l in sys.stdin)\nfor i in range(n - (n < 100)): print('---')\n"
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        with pytest.raises(PythonException, match="output ended after"):
            run_records(lines(spark, ["a"] * 950, parts=1), command_step(py(code), session_bytes=1), "str").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_launch_option_for_sessions():
    from lineflow.options import FlowOptions, OptionError

    assert FlowOptions.from_args(["f", "--input=t", "--output=o", "--command_session_bytes=1000"]).command_session_bytes == 1000
    with pytest.raises(OptionError):
        FlowOptions.from_args(["f", "--input=t", "--output=o", "--command_session_bytes=0"]).validate()


def test_launch_option_for_the_timeout():
    from lineflow.options import FlowOptions, OptionError

    args = ["f", "--input=t", "--output=o", "--command_timeout=2.5"]
    assert FlowOptions.from_args(args).command_timeout == 2.5
    with pytest.raises(OptionError):
        FlowOptions.from_args(["f", "--input=t", "--output=o", "--command_timeout=0"]).validate()
