"""PAR-1..3, SRC-7 dispatch, STR-2 batch caps, files shipped to commands (EXT-6)."""

import pytest
from pyspark.sql import functions as F

from lineflow import FlowOptions, command_step, read_sink, run_records, upcase
from lineflow.operators.partitioning import spread, spread_by_bytes, spread_to_cluster
from lineflow.plans.topology import build_flow, explain_text
from lineflow.session import new_run_dir
from lineflow.sources import read_lines
from lineflow.streaming import start_flow

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_spread_only_when_wider(spark):
    ev = spark.read.parquet(EVENTS)
    assert spread(ev, 8, 1).rdd.getNumPartitions() == 8
    assert "Exchange" not in explain_text(spread(ev, 1, 1))
    assert "Exchange" not in explain_text(spread(ev, 4, 8))
    with pytest.raises(ValueError):
        spread(ev, 0, 1)


def test_spread_to_cluster(spark):
    narrow = spark.read.parquet(EVENTS)
    assert spread_to_cluster(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, numPartitions=64)
    assert spread_to_cluster(wide).rdd.getNumPartitions() == 64  # no exchange added


@pytest.mark.parametrize("few", [0, 1])
def test_spread_by_bytes(spark, few):
    """A third of the bytes in 1 % of the rows, and many equal rows: tasks get bytes within 1.5 of each other."""
    n = 20_000
    size = F.when(F.col("id") % 100 == few * 7, 5000).otherwise(100)
    rows = spark.range(0, n, 1, 3).select(F.when(F.col("id") < n // 3, 0).otherwise(F.col("id")).alias("id"),
                                          F.repeat(F.lit("x"), size.cast("int")).alias("str"))
    out = spread_by_bytes(rows, 8, F.octet_length("str"))
    parts = out.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("str") + 64)).collect()
    sizes = [p[1] for p in parts]
    assert len(sizes) == 8 and max(sizes) <= 1.5 * min(sizes)
    assert out.groupBy("id", "str").count().exceptAll(rows.groupBy("id", "str").count()).count() == 0 and out.count() == n
    nothing = rows.where("id < 0")
    assert spread_by_bytes(nothing, 4, F.octet_length("str")).count() == 0
    nulls = rows.limit(10).withColumn("str", F.lit(None).cast("string"))
    assert spread_by_bytes(nulls, 4, F.octet_length("str")).count() == 10


def test_read_lines_dispatch_batch(spark, text_dir):
    o = FlowOptions(flow="upcaser", input=f"file://{text_dir}", output="x", from_beginning=True)
    rows = sorted(r.str for r in read_lines(spark, o).collect())
    assert f"file:{text_dir}/f1.txt\tc\t2" in rows and len(rows) == 7
    out = build_flow(spark, FlowOptions(**{**o.__dict__, "parallelism": 4}), upcase())
    assert "RoundRobinPartitioning(4)" in explain_text(out)
    assert out.count() == 7


def test_kafka_source_is_requested(spark):
    o = FlowOptions(flow="upcaser", input="topic", output="x", kafka_hosts="h")
    with pytest.raises(Exception, match="(?i)kafka"):
        read_lines(spark, o, streaming=True)


def test_files_per_trigger(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(4):
        (src / f"f{i}.txt").write_text(f"line {i}\n")
    run = new_run_dir(spark, "t-cap")
    o = FlowOptions(flow="upcaser", input=f"file://{src}", output="x", from_beginning=True)
    q = start_flow(spark, o, upcase(), checkpoint=f"{run}/ckpt", sink="parquet", path=f"{run}/out",
                   max_per_trigger=1, trigger={"availableNow": True})
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4
    assert read_sink(spark, f"{run}/out").count() == 4


def test_shipped_file(spark, tmp_path):
    script = tmp_path / "shout.awk"
    script.write_text('{ print toupper($0); print "---" }\n')
    spark.sparkContext.addFile(str(script))
    df = spark.createDataFrame([("a",), ("b",)], "str string")
    step = command_step(["awk", "-f", "sparkfile:shout.awk"])
    assert sorted(r.record for r in run_records(df, step, "str").collect()) == ["A", "B"]


def test_empty_frames_keep_provenance(spark):
    df = spark.createDataFrame([(1, ""), (2, "x y")], "id int, str string")
    out = run_records(df, command_step(["awk", '{ for (i = 1; i <= NF; i++) print $i; print "---" }']), "str",
                      keep=["id"])
    assert sorted(tuple(r) for r in out.collect()) == [(2, "x"), (2, "y")]
    assert out.where(F.col("id") == 1).count() == 0


def test_bytes_per_trigger(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(4):
        (src / f"f{i}.txt").write_text("x" * 1000 + "\n")
    run = new_run_dir(spark, "t-bytes")
    o = FlowOptions(flow="upcaser", input=f"file://{src}", output="x", from_beginning=True)
    q = start_flow(spark, o, upcase(), checkpoint=f"{run}/ckpt", sink="parquet", path=f"{run}/out",
                   max_bytes_per_trigger=1500, trigger={"availableNow": True})
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4


def test_wide_inputs_stay_wide(spark, tmp_path):
    for i in range(145):
        (tmp_path / f"{i}.txt").write_text("x\n")
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(256 << 20))  # one file a split
    try:
        raw = spark.read.text(str(tmp_path))
        assert spread(raw, 8, 1).rdd.getNumPartitions() == 145
        assert spread(raw, 200, 1).rdd.getNumPartitions() == 200
        o = FlowOptions(flow="upcaser", input=f"file://{tmp_path}", output="x", from_beginning=True, parallelism=8)
        out = build_flow(spark, o, upcase())
        assert "RoundRobin" not in explain_text(out) and out.rdd.getNumPartitions() == 145
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)


def jobs_of(spark, fn):
    """The ids of the jobs that ``fn`` runs, and its result."""
    import uuid

    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "test")
    try:
        out = fn()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return spark.sparkContext.statusTracker().getJobIdsForGroup(group), out


def test_counting_partitions_runs_no_job(spark):
    from lineflow.operators.partitioning import scan_partitions

    ev = spark.read.parquet(EVENTS)
    grouped = ev.groupBy("event_type").count()
    jobs, n = jobs_of(spark, lambda: (scan_partitions(grouped), scan_partitions(ev)))
    assert n[0] is None and n[1] >= 1 and not jobs
    jobs, _ = jobs_of(spark, lambda: spread_to_cluster(grouped))
    assert not jobs


def test_dry_runs_start_no_job(spark, text_dir):
    o = FlowOptions(flow="upcaser", input=f"file://{text_dir}", output="x", from_beginning=True, dry_run=True)
    jobs, df = jobs_of(spark, lambda: build_flow(spark, o, upcase()))
    assert not jobs and "file_block_start" in explain_text(df)
    jobs, text = jobs_of(spark, lambda: start_flow(spark, o, upcase(), sink="kafka"))
    assert not jobs and "Physical Plan" in text


def test_source_parallelism_of_files(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text("some line of text\n" * 50_000)
    o = FlowOptions(flow="upcaser", input=f"file://{d}", output="x", from_beginning=True, input_parallelism=40)
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        lines = read_lines(spark, o, combine=False)
        assert lines.rdd.getNumPartitions() >= 40
        assert lines.agg(F.max("linenumber"), F.count("*")).first() == (50_000, 50_000)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
