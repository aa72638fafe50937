"""Command line: bolt over files, dry run, option errors."""

import glob

from lineflow import read_sink
from lineflow.cli import main

FLOWS = '''
from lineflow import dataflow, from_json, interpolate, register
register("test_example", interpolate("I raised the {foo}"))
dataflow("flow", from_json(), "test_example")
'''


def test_bolt_files(spark, tmp_path):
    flows = tmp_path / "flows.py"
    flows.write_text(FLOWS)
    (tmp_path / "in.txt").write_text('{"foo":"bar"}\njunk\n')
    out = tmp_path / "out"
    assert main(["bolt", "flow", f"--flows={flows}", f"--input={tmp_path}/in.txt", f"--output={out}"]) == 0
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{out}/part-*")))
    assert text == "I raised the bar\nX\nX\n"


def test_bolt_command(spark, tmp_path):
    (tmp_path / "in.txt").write_text("a b\n\nc\n")
    out = tmp_path / "out"
    cmd = "awk '{ for (i = 1; i <= NF; i++) print $i; print \"---\" }'"
    assert main(["bolt", f"--bolt_command={cmd}", "--delimiter=---", f"--input={tmp_path}/in.txt",
                 f"--output={out}"]) == 0
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{out}/part-*")))
    assert text == "a\nb\n---\n---\nc\n---\n"


def test_bolt_keeps_the_order_of_files_and_lines(spark, tmp_path):
    """Frames of three files of unequal sizes, cut into many splits, in input order; through a command too."""
    src = tmp_path / "in"
    src.mkdir()
    want = []
    for name, n in (("a.txt", 3), ("b.txt", 4000), ("c.txt", 50)):
        lines = [f"{name} {i}" for i in range(n)]
        (src / name).write_text("".join(f"{x}\n" for x in lines))
        want += [w for x in lines for w in (*x.split(), "---")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, small as they are
    try:
        for how in (["tokenizer", "--flows=lineflow.functions.examples"],
                    ["--bolt_command=awk '{ for (i = 1; i <= NF; i++) print $i; print \"---\" }'"]):
            out = tmp_path / f"out{len(how)}"
            assert main(["bolt", *how, "--delimiter=---", f"--input={src}", f"--output={out}"]) == 0
            files = sorted(glob.glob(f"{out}/part-*"))
            assert "".join(open(p).read() for p in files).split("\n")[:-1] == want and len(files) > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_run_dry(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\n")
    code = main(["run", "upcaser", f"--name=dry_{tmp_path.name}_{id(tmp_path)}", f"--input=file://{tmp_path}/in",
                 "--output=out", "--sink=memory", "--dry_run"])
    assert code == 0
    printed = capsys.readouterr().out
    assert "query name : dry_" in printed and "Physical Plan" in printed


def test_errors(spark, tmp_path):
    assert main(["run", "--input=foo", "--output=bar"]) == 1
    assert main(["run", "upcaser", f"--input=file://{tmp_path}", "--output=o", "--max_per_trigger=lots"]) == 1
    assert main(["run", "upcaser", f"--input=file://{tmp_path}", "--output=o", "--sink=parquet"]) == 1
    assert main(["run", "nope", "--input=foo", "--output=bar"]) == 1
    assert main([]) == 1


def test_run_files_to_parquet(spark, tmp_path):
    from lineflow.session import new_run_dir

    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        (src / f"f{i}.txt").write_text(f"line {i}\n")
    run = new_run_dir(spark, "t-cli-run")
    code = main(["run", "upcaser", "--flows=lineflow.functions.examples", f"--input=file://{src}", "--output=o",
                 "--from_beginning", "--sink=parquet", f"--path={run}/out", f"--checkpoint={run}/ckpt",
                 "--max_per_trigger=1", "--trigger=available"])
    assert code == 0
    got = sorted(r.record.split("\t")[1] for r in read_sink(spark, f"{run}/out").collect())
    assert got == ["LINE 0", "LINE 1", "LINE 2"]


def test_run_batch(spark, tmp_path):
    from lineflow.session import new_run_dir

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("x y\nz\n")
    run = new_run_dir(spark, "t-cli-batch")
    code = main(["run", "tokenizer", f"--input=file://{src}", "--output=o", "--from_beginning", "--batch",
                 "--sink=parquet", f"--path={run}/out"])
    assert code == 0
    # the tokenizer splits the combined record: path, content and line number are all words
    words = sorted(r.record for r in spark.read.parquet(f"{run}/out").collect())
    assert {"x", "y", "z", "1", "2"} <= set(words)
