"""Line records with provenance (SRC-4), combined form (MAP-2), line numbers across splits."""

from pyspark.sql import functions as F

from lineflow.sources.records import combine_metadata, read_numbered_lines, read_wholetext, recordize

SMALL = {
    "f1.txt": [("a b", 1), ("c", 2), ("", 3), ("d", 4)],
    "f2.txt": [("x", 1), ("y", 2)],
    "f3.txt": [("deep", 1)],
}


def _by_file(rows):
    out = {}
    for r in rows:
        out.setdefault(r["metadata"].rsplit("/", 1)[-1], []).append((r["content"], r["linenumber"]))
    return {k: sorted(v, key=lambda t: t[1]) for k, v in out.items()}


def test_small_dir_two_pass(spark, text_dir):
    rows = read_numbered_lines(spark, str(text_dir)).collect()
    assert _by_file(rows) == SMALL


def test_small_dir_wholetext(spark, text_dir):
    blobs = read_wholetext(spark, str(text_dir))
    rows = recordize(blobs, "value", "path").collect()
    assert _by_file(rows) == SMALL


def test_metadata_is_spark_file_path(spark, text_dir):
    rows = read_numbered_lines(spark, str(text_dir)).select("metadata").distinct().collect()
    assert sorted(r[0] for r in rows) == sorted(
        f"file:{text_dir}/{p}" for p in ("f1.txt", "f2.txt", "sub/f3.txt"))


def test_line_numbers_across_splits(spark, tmp_path):
    d = tmp_path / "split"
    d.mkdir()
    (d / "a.txt").write_text("".join(f"line {i}\n" for i in range(1, 50001)))
    (d / "b.txt").write_text("".join(f"line {i}\n" for i in range(1, 3001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        df = read_numbered_lines(spark, str(d))
        blocks = df.select(F.spark_partition_id()).distinct().count()
        wrong = df.where(F.col("content") != F.concat(F.lit("line "), F.col("linenumber").cast("string"))).count()
        total = df.count()
        # the same result when the block table is not broadcast
        wrong_shuffled = read_numbered_lines(spark, str(d), broadcast_limit=0).where(
            F.col("content") != F.concat(F.lit("line "), F.col("linenumber").cast("string"))).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert blocks > 10 and total == 53000 and wrong == 0 and wrong_shuffled == 0


def test_combine_metadata_null(spark):
    df = spark.createDataFrame([(None, "c", 3), ("m", None, 1)], "metadata string, content string, linenumber int")
    assert [r.str for r in combine_metadata(df).collect()] == ["null\tc\t3", "m\tnull\t1"]


def test_after_marker_skips_files(spark, text_dir):
    marker = f"file:{text_dir}/f1.txt"
    rows = read_numbered_lines(spark, str(text_dir), after_marker=marker).collect()
    assert set(_by_file(rows)) == {"f2.txt", "f3.txt"}


def test_retried_tasks_give_exact_results(tmp_path):
    """Executor loss, simulated: every task fails once; retries must give the same line numbers and outputs."""
    import json
    import os
    import subprocess
    import sys

    d = tmp_path / "text"
    d.mkdir()
    (d / "a.txt").write_text("".join(f"line {i}\n" for i in range(1, 6001)))
    (d / "b.txt").write_text("x\ny\n")
    script = os.path.join(os.path.dirname(__file__), "scripts", "retry_check.py")
    proc = subprocess.run([sys.executable, script, str(d), str(tmp_path / "ckpt")], capture_output=True, text=True,
                          timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    rows = json.loads(proc.stdout.strip().splitlines()[-1])
    expect = sorted([["a.txt", i, f"LINE {i}"] for i in range(1, 6001)] + [["b.txt", 1, "X"], ["b.txt", 2, "Y"]])
    assert rows == expect
    assert json.loads(proc.stdout.strip().splitlines()[-2]) == [{"inputs": 6002, "records": 5402, "failures": 600}, 600, 5402]


def test_numbers_do_not_depend_on_live_cores(spark, tmp_path):
    """The cores of the cluster change between the building of the plan and its run, both ways."""
    d = tmp_path / "live"
    d.mkdir()
    for n, count in (("a", 60_000), ("b", 40_000), ("c", 5_000)):
        (d / f"{n}.txt").write_text("".join(f"{i}\n" for i in range(1, count + 1)))
    key = "spark.sql.leafNodeDefaultParallelism"
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        for before, after in ((4, 16), (16, 4), (40, 3)):
            spark.conf.set(key, str(before))
            df = read_numbered_lines(spark, str(d))
            spark.conf.set(key, str(after))
            assert df.where(F.col("content") == F.col("linenumber").cast("string")).count() == 105_000 == df.count()
            assert dict(df.dtypes)["linenumber"] == "bigint"
    finally:
        spark.conf.unset(key)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_a_changed_layout_is_an_error(spark, tmp_path):
    import pytest

    from lineflow.sources.records import number_lines, tag_lines

    d = tmp_path / "changed"
    d.mkdir()
    (d / "a.txt").write_text("".join(f"{i}\n" for i in range(1, 60_001)))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "200000")
        df = number_lines(tag_lines(spark.read.text(str(d))))  # not a fixed layout
        spark.conf.set(key, "30000")
        with pytest.raises(Exception, match="split layout changed"):
            df.collect()
    finally:
        spark.conf.set(key, old)


def test_numbered_lines_belong_to_the_callers_session(spark, tmp_path):
    """Its views, functions and later settings apply; the scan keeps its layout through them."""
    d = tmp_path / "own"
    d.mkdir()
    (d / "a.txt").write_text("".join(f"line {i}\n" for i in range(1, 20001)))
    key, size = "spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "20000")
    try:
        lines = read_numbered_lines(spark, str(d))
        assert lines.sparkSession is spark
        spark.conf.set(size, "70000")
        spark.conf.set(key, "3")  # cuts files another way from now on
        lines.createOrReplaceTempView("numbered_here")
        spark.udf.register("tail_here", lambda s: s.rsplit(" ", 1)[-1])
        row = spark.sql("select count(*) n, sum(case when tail_here(content) = linenumber then 1 else 0 end) ok from numbered_here").first()
        assert (row.n, row.ok) == (20000, 20000)
        assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("lineflow_")]
    finally:
        spark.conf.set(size, old)
        spark.conf.unset(key)
        spark.catalog.dropTempView("numbered_here")
