"""Streams: named queries, replace, dry run, resume, start markers, sinks (STR-1..7, POS-5..8, SNK-1..2)."""

import pytest

from lineflow import FlowOptions, upcase
from lineflow.session import new_run_dir
from lineflow.sinks import ForeignSink, ManifestSink, compact, kafka_frame, read_sink, replay_safe
from lineflow.sources.kafka import apply_start_offsets, as_kafka_log, decode_messages
from lineflow.streaming import FlowAlreadyRunning, active_query, start_flow


NOW = {"availableNow": True}


def opts(path, **kw):
    return FlowOptions(flow="upcaser", input=f"file://{path}", output="out", **kw)


def write(d, name, text):
    d.mkdir(parents=True, exist_ok=True)
    (d / name).write_text(text)


def run_once(spark, o, ckpt, out, **kw):
    q = start_flow(spark, o, upcase(), checkpoint=ckpt, sink="parquet", path=out, **{"trigger": NOW} | kw)
    q.awaitTermination()
    assert q.exception() is None
    if kw.get("whole_files"):
        return sorted(r.record for r in spark.read.parquet(out).collect())
    return sorted(r.record for r in read_sink(spark, out).collect())


def test_file_stream_resume(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "a.txt", "one\ntwo\n")
    run = new_run_dir(spark, "t-resume")
    o = opts(src, from_beginning=True)
    first = run_once(spark, o, f"{run}/ckpt", f"{run}/out")
    path = f"file:{src}/a.txt".upper()
    assert first == [f"{path}\tONE\t1", f"{path}\tTWO\t2"]
    write(src, "b.txt", "three\n")
    second = run_once(spark, o, f"{run}/ckpt", f"{run}/out")  # same checkpoint: only b.txt is new
    assert len(second) == 3 and second[-1].endswith("THREE\t1")


def test_from_end_skips_existing(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "a.txt", "old\n")
    run = new_run_dir(spark, "t-latest")
    o = opts(src, from_end=True)
    assert run_once(spark, o, f"{run}/ckpt", f"{run}/out") == []
    write(src, "b.txt", "new\n")
    # a restart resumes (stored marker), without --from_end as well
    assert [r.split("\t")[1] for r in run_once(spark, opts(src), f"{run}/ckpt", f"{run}/out")] == ["NEW"]


def test_explicit_marker(spark, tmp_path):
    src = tmp_path / "in"
    for n in ("a.txt", "b.txt", "c.txt"):
        write(src, n, n + "\n")
    run = new_run_dir(spark, "t-marker")
    got = run_once(spark, opts(src, offset="b.txt"), f"{run}/ckpt", f"{run}/out")
    assert [r.split("\t")[1] for r in got] == ["C.TXT"]


def test_name_replace_and_dry_run(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "a.txt", "x\n")
    run = new_run_dir(spark, "t-replace")
    o = opts(src, name=f"named_{run.rsplit('-', 1)[-1]}")
    text = start_flow(spark, FlowOptions(**{**o.__dict__, "dry_run": True}), upcase(), sink="memory")
    assert f"query name : {o.name}" in text and "Physical Plan" in text
    every = {"processingTime": "1 second"}
    q1 = start_flow(spark, o, upcase(), sink="parquet", path=f"{run}/out", trigger=every)
    try:
        with pytest.raises(FlowAlreadyRunning):
            start_flow(spark, o, upcase(), sink="parquet", path=f"{run}/out", trigger=every)
        o2 = FlowOptions(**{**o.__dict__, "rm": True, "wait": 5})
        q2 = start_flow(spark, o2, upcase(), sink="parquet", path=f"{run}/out", trigger=every)
        assert not q1.isActive and q2.isActive and active_query(spark, o.name).id == q2.id
        assert q2.id == q1.id and q2.runId != q1.runId  # same checkpoint, new run
        q2.stop()
    finally:
        for q in spark.streams.active:
            q.stop()


def test_topic_per_record(spark):
    df = spark.createDataFrame([("a", None), ("b", "special")], "record string, topic string")
    assert [tuple(r) for r in kafka_frame(df, "default").collect()] == [("default", "a"), ("special", "b")]
    no_topic = spark.createDataFrame([("a",)], "record string")
    assert [tuple(r) for r in kafka_frame(no_topic, "default").collect()] == [("default", "a")]


def test_kafka_log_positions(spark):
    df = spark.createDataFrame([(p, o, f"m{p}{o}") for p in range(2) for o in range(5)], "p int, o long, v string")
    log = as_kafka_log(df, "t", value="v", partition="p", offset="o")
    assert log.columns == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
    pos = FlowOptions(input="t", offset="3").start_position()
    assert sorted(r.str for r in decode_messages(apply_start_offsets(log, pos)).collect()) == [
        "m03", "m04", "m13", "m14"]
    assert apply_start_offsets(log, FlowOptions(input="t", from_end=True).start_position()).count() == 0
    assert apply_start_offsets(log, {0: -2, 1: 4}).count() == 6


def test_replay_safe_overwrites(spark):
    run = new_run_dir(spark, "t-replay")
    sink = replay_safe(f"{run}/out")
    batch = spark.createDataFrame([(1,), (2,)], "x int")
    sink(batch, 0)
    sink(batch, 0)  # replayed
    sink(batch, 1)
    assert spark.read.parquet(f"{run}/out").count() == 4


def test_kafka_sink_plan(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "a.txt", "x\n")
    o = FlowOptions(flow="upcaser", input=f"file://{src}", output="out_topic", kafka_hosts="k1,k2:9093",
                    dry_run=True)
    text = start_flow(spark, o, upcase(), sink="kafka")
    assert "out_topic AS topic" in text and "value" in text


def test_framed_output_on_a_stream(spark, tmp_path):
    from lineflow import frame_text, run_frames, tokenize
    from lineflow.sources.records import read_wholetext, recordize

    src = tmp_path / "in"
    write(src, "a.txt", "a b\n\nc\n")
    lines = recordize(read_wholetext(spark, str(src), streaming=True), "value", "path")
    frames = run_frames(lines, tokenize(), "content", keep=["linenumber"])
    out = frames.select("linenumber", frame_text("out", "---").alias("frame"))
    run = new_run_dir(spark, "t-framed-stream")
    q = (out.writeStream.option("checkpointLocation", f"{run}/ckpt").trigger(availableNow=True)
         .format("parquet").start(f"{run}/out"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{run}/out").collect())
    assert got == [(1, "a\nb\n---\n"), (2, "---\n"), (3, "c\n---\n")]


def test_split_file_stream_numbers_lines(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "a.txt", "".join(f"line {i}\n" for i in range(1, 20001)))
    write(src, "b.txt", "x\ny\n")
    run = new_run_dir(spark, "t-split")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        q = start_flow(spark, opts(src, from_beginning=True), upcase(), checkpoint=f"{run}/ckpt",
                       sink="parquet", path=f"{run}/out", trigger=NOW)
        q.awaitTermination()
        assert q.exception() is None
        out = read_sink(spark, f"{run}/out")
        rows = [r.record.split("\t") for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    a = [r for r in rows if r[0].endswith("A.TXT")]
    assert len(a) == 20000 and all(r[1] == f"LINE {r[2]}" for r in a)
    assert sorted((r[1], r[2]) for r in rows if r[0].endswith("B.TXT")) == [("X", "1"), ("Y", "2")]


def test_restart_by_name_resumes(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "a.txt", "one\n")
    run = new_run_dir(spark, "t-by-name")
    o = opts(src, name=f"by_name_{run.rsplit('-', 1)[-1]}", from_beginning=True)
    q = start_flow(spark, o, upcase(), sink="parquet", path=f"{run}/out", trigger=NOW)
    q.awaitTermination()
    write(src, "b.txt", "two\n")
    q = start_flow(spark, o, upcase(), sink="parquet", path=f"{run}/out", trigger=NOW)
    q.awaitTermination()
    got = sorted(r.record.split("\t")[1] for r in read_sink(spark, f"{run}/out").collect())
    assert got == ["ONE", "TWO"]  # the second start read only the new file


def test_dry_run_writes_nothing(spark, tmp_path):
    from lineflow.sources.files import stored_cut

    src = tmp_path / "in"
    write(src, "a.txt", "x\n")
    run = new_run_dir(spark, "t-dry")
    o = opts(src, from_end=True, dry_run=True)
    assert "Physical Plan" in start_flow(spark, o, upcase(), checkpoint=f"{run}/ckpt", sink="memory")
    assert stored_cut(spark, f"{run}/ckpt") is None


def test_route_step_sets_topic(spark):
    from pyspark.sql import functions as F

    from lineflow import route, run_records

    df = spark.createDataFrame([("ok",), ("bad thing",)], "str string")
    flow = upcase() | route(lambda x: F.when(x.startswith("BAD"), F.lit("errors")))
    frame = kafka_frame(run_records(df, flow, "str"), "clean")
    assert sorted(tuple(r) for r in frame.collect()) == [("clean", "OK"), ("errors", "BAD THING")]


def test_replay_after_failure_is_not_doubled(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    src = tmp_path / "in"
    for i in range(3):
        write(src, f"f{i}.txt", f"line {i}\n")
    run = new_run_dir(spark, "t-replay-fail")
    sink = replay_safe(f"{run}/out")
    state = {"fail": True}

    def flaky(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1 and state["fail"]:
            state["fail"] = False
            raise RuntimeError("lost after the write, before the commit")

    o = opts(src, from_beginning=True)
    q = start_flow(spark, o, upcase(), checkpoint=f"{run}/ckpt", sink=flaky, max_per_trigger=1, trigger=NOW)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    q = start_flow(spark, o, upcase(), checkpoint=f"{run}/ckpt", sink=flaky, max_per_trigger=1, trigger=NOW)
    q.awaitTermination()
    assert q.exception() is None
    got = sorted(r.record.split("\t")[1] for r in spark.read.parquet(f"{run}/out").collect())
    assert got == ["LINE 0", "LINE 1", "LINE 2"]  # batch 1 ran twice, written once


def test_checkpoint_of_another_input_is_refused(spark, tmp_path):
    from lineflow.options import OptionError

    a, b = tmp_path / "a", tmp_path / "b"
    write(a, "x.txt", "1\n")
    write(b, "y.txt", "2\n")
    run = new_run_dir(spark, "t-other-input")
    q = start_flow(spark, opts(a, from_beginning=True), upcase(), checkpoint=f"{run}/ckpt", sink="parquet",
                   path=f"{run}/out", trigger=NOW)
    q.awaitTermination()
    with pytest.raises(OptionError, match="belongs to input"):
        start_flow(spark, opts(b), upcase(), checkpoint=f"{run}/ckpt", sink="parquet", path=f"{run}/out")


def test_routed_stream_to_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from lineflow import route

    src = tmp_path / "in"
    write(src, "a.txt", "ok\nbad one\n")
    run = new_run_dir(spark, "t-routed")
    flow = upcase() | route(lambda x: F.when(x.contains("BAD"), F.lit("errors")))
    q = start_flow(spark, opts(src, from_beginning=True), flow, checkpoint=f"{run}/ckpt", sink="parquet",
                   path=f"{run}/out", trigger=NOW)
    q.awaitTermination()
    got = kafka_frame(read_sink(spark, f"{run}/out"), "clean").collect()
    assert sorted((r.topic, r.value.split("\t")[1]) for r in got) == [("clean", "OK"), ("errors", "BAD ONE")]


def test_stop_flow(spark, tmp_path):
    from lineflow.streaming import stop_flow

    src = tmp_path / "in"
    write(src, "a.txt", "x\n")
    run = new_run_dir(spark, "t-stop")
    name = f"stop_{run.rsplit('-', 1)[-1]}"
    assert stop_flow(spark, name, 1) is False
    q = start_flow(spark, opts(src, name=name), upcase(), checkpoint=f"{run}/ckpt", sink="parquet",
                   path=f"{run}/out", trigger={"processingTime": "1 second"})
    try:
        assert stop_flow(spark, name, 5) is True and not q.isActive
    finally:
        if q.isActive:
            q.stop()


def wait_for(spark, out, n, seconds=60):
    import time

    for _ in range(seconds * 4):
        try:
            rows = read_sink(spark, out).collect()
        except Exception:  # noqa: BLE001 - nothing written yet, or being written
            rows = []
        if len(rows) >= n:
            return sorted(r.record.split("\t")[1] for r in rows)
        time.sleep(0.25)
    raise AssertionError(f"{len(rows)} of {n} rows")


def test_a_flow_runs_on_by_default(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "a.txt", "old\n")
    run = new_run_dir(spark, "t-runs-on")
    q = start_flow(spark, opts(src), upcase(), checkpoint=f"{run}/ckpt", sink="parquet", path=f"{run}/out")
    try:
        q.processAllAvailable()
        assert q.isActive
        write(src, "0.txt", "new\n")  # sorts before what was there
        assert wait_for(spark, f"{run}/out", 1) == ["NEW"] and q.isActive
    finally:
        q.stop()


def test_files_of_the_same_moment_and_older_names_are_told_apart(spark, tmp_path):
    import os

    src = tmp_path / "in"
    for n in ("f.txt", "e.txt"):
        write(src, n, n + "\n")
        os.utime(src / n, (1_700_000_000, 1_700_000_000))
    run = new_run_dir(spark, "t-moment")
    assert run_once(spark, opts(src), f"{run}/ckpt", f"{run}/out") == []
    write(src, "a b%.txt", "same moment\n")
    os.utime(src / "a b%.txt", (1_700_000_000, 1_700_000_000))
    write(src, "b.txt", "later\n")
    got = run_once(spark, opts(src), f"{run}/ckpt", f"{run}/out")
    assert sorted(r.split("\t")[1] for r in got) == ["LATER", "SAME MOMENT"]


def test_no_file_is_lost_by_its_modification_time(spark, tmp_path):
    """A file that arrives with an old modification time is new: renamed in, copied with its times, or days old."""
    import os
    import time

    src = tmp_path / "in"
    write(src, "early.txt", "early\n")
    run = new_run_dir(spark, "t-old-times")
    assert run_once(spark, opts(src), f"{run}/ckpt", f"{run}/out") == []
    write(tmp_path / "aside", "late.txt", "late\n")
    hour_ago = time.time() - 3600
    os.utime(tmp_path / "aside" / "late.txt", (hour_ago, hour_ago))
    os.rename(tmp_path / "aside" / "late.txt", src / "late.txt")
    write(src, "late2.txt", "late2\n")
    got = run_once(spark, opts(src), f"{run}/ckpt", f"{run}/out", max_per_trigger=1)
    assert sorted(r.split("\t")[1] for r in got) == ["LATE", "LATE2"]

    src = tmp_path / "weeks"
    write(src, "a.txt", "a\n")
    run = new_run_dir(spark, "t-weeks")
    o = opts(src, from_beginning=True)
    assert len(run_once(spark, o, f"{run}/ckpt", f"{run}/out")) == 1
    write(src, "b.txt", "b\n")
    os.utime(src / "b.txt", (time.time() - 9 * 86400,) * 2)
    write(src, "c.txt", "c\n")
    got = run_once(spark, o, f"{run}/ckpt", f"{run}/out")
    assert sorted(r.split("\t")[1] for r in got) == ["A", "B", "C"]


def test_files_present_are_passed_by_unread(spark, tmp_path):
    """The flow's own batches hold only rows of files that came after its first start."""
    src = tmp_path / "in"
    write(src, "a.txt", "old\n")
    run = new_run_dir(spark, "t-unread")
    assert run_once_rows(spark, opts(src), f"{run}/ckpt", f"{run}/out") == 0
    write(src, "b.txt", "new\n")
    # one row, scanned for its number and for the flow
    assert run_once_rows(spark, opts(src), f"{run}/ckpt", f"{run}/out") == 2


def run_once_rows(spark, o, ckpt, out):
    q = start_flow(spark, o, upcase(), checkpoint=ckpt, sink="parquet", path=out, trigger=NOW)
    q.awaitTermination()
    assert q.exception() is None
    return sum(p["numInputRows"] for p in q.recentProgress)


def test_the_memory_sink_starts_at_the_end_too(spark, tmp_path):
    import os

    src = tmp_path / "in"
    write(src, "a.txt", "old\n")
    name = f"mem_{tmp_path.name}_{os.getpid()}".replace("-", "_")
    run = new_run_dir(spark, "t-memory")
    q = start_flow(spark, opts(src, name=name), upcase(), checkpoint=f"{run}/ckpt", sink="memory")
    try:
        q.processAllAvailable()
        write(src, "b.txt", "new\n")
        os.utime(src / "b.txt", (1_600_000_000, 1_600_000_000))
        q.processAllAvailable()
        assert [r.record.split("\t")[1] for r in spark.table(name).collect()] == ["NEW"]
    finally:
        q.stop()


def test_markers_with_special_characters(spark, tmp_path):
    src = tmp_path / "in#1"
    for n in ("a b.txt", "a b%.txt", "a#c.txt", "ä.txt"):
        write(src, n, n + "\n")
    names = sorted(p.name for p in src.iterdir())
    paths = sorted(r.p for r in spark.read.text(str(src)).selectExpr("_metadata.file_path p").collect())
    from lineflow.sources.files import normalize_marker

    assert sorted(normalize_marker(n, str(src)) for n in names) == paths
    run = new_run_dir(spark, "t-special")
    got = run_once(spark, opts(src, offset="a b.txt"), f"{run}/ckpt", f"{run}/out")
    later = [p for p in paths if p > normalize_marker("a b.txt", str(src))]
    assert len(got) == len(later) < len(paths)


def test_other_borders_neither_lose_nor_double(spark, tmp_path):
    """A flow started again on a new checkpoint leaves out the files that its sink holds."""
    src = tmp_path / "in"
    for i in range(4):
        write(src, f"f{i}.txt", f"line {i}\n" * (i + 1))
    run = new_run_dir(spark, "t-borders")
    o = opts(src, from_beginning=True)
    assert len(run_once(spark, o, f"{run}/c1", f"{run}/out", max_per_trigger=1)) == 10
    write(src, "f4.txt", "line 4\n")
    assert len(run_once(spark, o, f"{run}/c2", f"{run}/out", max_per_trigger=3)) == 11


def test_a_sink_folder_belongs_to_one_flow(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    src = tmp_path / "in"
    write(src, "a.txt", "x\n")
    run = new_run_dir(spark, "t-owner")
    o = opts(src, from_beginning=True)
    assert len(run_once(spark, o, f"{run}/c1", f"{run}/out")) == 1
    with pytest.raises(StreamingQueryException, match="holds the records of flow"):
        run_once(spark, opts(src, from_beginning=True, name=f"other_{tmp_path.name}"), f"{run}/c2", f"{run}/out")


def test_replay_safe_belongs_to_one_query(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    src = tmp_path / "in"
    for i in range(4):
        write(src, f"f{i}.txt", f"line {i}\n")
    run = new_run_dir(spark, "t-owner")
    o = opts(src, from_beginning=True)
    for ckpt, sink in (("c1", replay_safe(f"{run}/out")), ("c2", replay_safe(f"{run}/out")), ("c3", replay_safe(f"{run}/out", replace=True))):
        q = start_flow(spark, o, upcase(), checkpoint=f"{run}/{ckpt}", sink=sink, max_per_trigger=3, trigger=NOW)
        if ckpt == "c2":
            with pytest.raises(StreamingQueryException, match="holds the batches of query"):
                q.awaitTermination()
        else:
            q.awaitTermination()
            assert q.exception() is None and spark.read.parquet(f"{run}/out").count() == 4


@pytest.mark.parametrize("moment", ["staged", "published"])
def test_a_kill_around_the_manifest(spark, tmp_path, monkeypatch, moment):
    """Lost after the data is staged, or after the manifest but before the checkpoint's commit: nothing is lost or doubled."""
    from pyspark.errors import StreamingQueryException

    from lineflow.sinks import manifest

    src = tmp_path / "in"
    for i in range(3):
        write(src, f"f{i}.txt", f"line {i}\n")
    run = new_run_dir(spark, f"t-kill-{moment}")
    real, state = manifest.publish, {"left": 2}

    def flaky(s, path, entry):
        state["left"] -= 1
        if state["left"] or moment == "published":
            real(s, path, entry)
        if not state["left"]:
            raise RuntimeError("lost here")

    monkeypatch.setattr(manifest, "publish", flaky)
    o = opts(src, from_beginning=True)
    q = start_flow(spark, o, upcase(), checkpoint=f"{run}/c", sink="parquet", path=f"{run}/out", max_per_trigger=1, trigger=NOW)
    with pytest.raises(StreamingQueryException, match="lost here"):
        q.awaitTermination()
    assert len(read_sink(spark, f"{run}/out").collect()) == (1 if moment == "staged" else 2)
    # the same checkpoint, and then a new one with other borders
    assert [r.split("\t")[1] for r in run_once(spark, o, f"{run}/c", f"{run}/out", max_per_trigger=1)] == ["LINE 0", "LINE 1", "LINE 2"]
    assert len(run_once(spark, o, f"{run}/c2", f"{run}/out", max_per_trigger=2)) == 3


def test_dead_letters_of_a_stream(spark, tmp_path):
    """Failed records are published with their batch, counted once although the batch ran twice; compaction keeps them."""
    from lineflow import python_step
    from lineflow.sinks import failure_count, read_failures
    from lineflow.sinks import manifest as manifests

    src = tmp_path / "in"
    for i in range(4):
        write(src, f"f{i}.txt", "ok\nbad\n")
    run = new_run_dir(spark, "t-dead")

    def fussy(line):
        if "\tbad\t" in line:
            raise ValueError("no good")
        return line

    flow = python_step(fussy, "fussy", suppress_errors=True)
    o = opts(src, from_beginning=True)
    real, state = manifests.publish, {"fail": True}

    def flaky(s, path, entry):
        if entry.number == 1 and state.pop("fail", False):
            raise RuntimeError("lost before it was published")
        real(s, path, entry)

    manifests.publish = flaky
    try:
        for attempt in range(2):
            q = start_flow(spark, o, flow, checkpoint=f"{run}/c", sink="parquet", path=f"{run}/out", max_per_trigger=1,
                           trigger=NOW, dead_letters=True)
            if attempt:
                q.awaitTermination()
            else:
                with pytest.raises(Exception, match="lost before"):
                    q.awaitTermination()
    finally:
        manifests.publish = real
    for _ in range(2):
        assert failure_count(spark, f"{run}/out") == 4 and read_sink(spark, f"{run}/out").count() == 4
        letters = read_failures(spark, f"{run}/out").collect()
        assert [(r.step, r.reason) for r in letters] == [("fussy", "ValueError: no good")] * 4
        assert sorted(r.record.split("\t")[0][-6:] for r in letters) == [f"f{i}.txt" for i in range(4)]
        compact(spark, f"{run}/out")
    with pytest.raises(ValueError, match="dead letters need"):
        start_flow(spark, o, flow, sink="memory", dead_letters=True)


def test_compaction(spark, tmp_path):
    """Many batches become few files; readers see the same records; replays are still told."""
    from lineflow import storage

    run = new_run_dir(spark, "t-compact")
    sink = ManifestSink(f"{run}/out", "parquet", "me", compact_after=6)
    for i in range(20):
        paths = spark.createDataFrame([(f"file:/f{i}",)], "path string")
        sink.write(spark.createDataFrame([(f"r{i}",)], "record string"), paths, "q", i)
    assert sorted(int(r.record[1:]) for r in read_sink(spark, f"{run}/out").collect()) == list(range(20))
    assert len(storage.names(spark, f"{run}/out/_lineflow/manifests")) <= 7
    again = ManifestSink(f"{run}/out", "parquet", "me")
    assert all(again.published(spark, "q", i) for i in range(20)) and not again.published(spark, "q", 20)
    assert again.known_inputs(spark, "other").distinct().count() == 20
    with pytest.raises(ForeignSink):
        ManifestSink(f"{run}/out", "parquet", "you").published(spark, "q", 1)
    before = len(storage.names(spark, f"{run}/out/_lineflow/data"))
    assert compact(spark, f"{run}/out") > 1 and compact(spark, f"{run}/out") == 0
    assert len(storage.names(spark, f"{run}/out/_lineflow/data")) < before + 1
    assert read_sink(spark, f"{run}/out").count() == 20
    assert read_sink(spark, f"{run}/none").count() == 0


def test_a_name_is_leased(spark):
    """A second driver is refused the name, takes it over, or takes it when the lease is stale; the first can't publish then."""
    import time

    from lineflow.streaming.lease import _HELD, LeaseLost, NameLease, NameTaken

    name = new_run_dir(spark, "t-lease").rsplit("/", 1)[-1]

    def driver(ttl=60.0):
        _HELD.clear()  # as another process sees it
        return NameLease(spark, name, ttl)

    first = driver().acquire()
    with pytest.raises(NameTaken, match="already running in another application"):
        driver().acquire()
    first.renew()
    second = driver().acquire(take_over=True, wait=0.2)
    assert second.number > first.number
    for what in (first.check, first.renew):
        with pytest.raises(LeaseLost):
            what()
    second.check()
    second.release()
    third = driver().acquire()  # given back: free
    time.sleep(1.2)
    fourth = driver(ttl=1.0).acquire()  # stale: free
    assert fourth.number > third.number
    with pytest.raises(LeaseLost):
        third.check()


def test_a_flow_taken_over_stops_and_a_name_in_use_is_refused(spark, tmp_path, monkeypatch):
    import time

    from lineflow.streaming import lease

    monkeypatch.setattr(lease, "TTL", 4.0)
    monkeypatch.setattr(lease.NameLease.__init__, "__defaults__", (4.0,))
    src = tmp_path / "in"
    write(src, "a.txt", "x\n")
    run = new_run_dir(spark, "t-taken")
    name = run.rsplit("/", 1)[-1]
    held = lease.NameLease(spark, name).acquire()
    lease._HELD.clear()
    with pytest.raises(FlowAlreadyRunning, match="another application"):
        start_flow(spark, opts(src, name=name), upcase(), checkpoint=f"{run}/c", sink="parquet", path=f"{run}/out", trigger=NOW)
    held.release()
    q = start_flow(spark, opts(src, name=name), upcase(), checkpoint=f"{run}/c", sink="parquet", path=f"{run}/out")
    try:
        assert q.isActive
        lease._HELD.clear()
        lease.NameLease(spark, name).acquire(take_over=True)
        for _ in range(100):
            if not q.isActive:
                break
            time.sleep(0.2)
        assert not q.isActive
    finally:
        q.stop()


def test_whole_files(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "a.txt", "one\ntwo\n")
    run = new_run_dir(spark, "t-whole")
    got = run_once(spark, opts(src, from_beginning=True), f"{run}/ckpt", f"{run}/out", whole_files=True)
    assert [r.split("\t")[1:] for r in got] == [["ONE", "1"], ["TWO", "2"]]


def test_names_never_share_a_checkpoint(spark):
    from lineflow.session import query_checkpoint

    assert len({query_checkpoint(spark, n) for n in ("a/b", "a_b", "a b")}) == 3


def test_s3_options_reach_the_listing(spark, tmp_path, monkeypatch):
    from lineflow.sources import files

    write(tmp_path / "in", "a.txt", "x\n")
    seen = []
    real = files.list_blobs
    monkeypatch.setattr(files, "list_blobs", lambda s, p, r, g, o: seen.append(o) or real(s, str(tmp_path / "in"), r, g, o))
    o = FlowOptions(flow="f", input="s3://bucket/in", output="x", aws_key="k", aws_secret="s")
    files.resolve_cut(spark, o.start_position(), o.blob_path, None, options=files.s3_options(o))
    assert seen[0]["fs.s3a.access.key"] == "k" and seen[0]["fs.s3a.secret.key"] == "s"


def test_only_a_missing_folder_means_no_cut(spark, tmp_path, monkeypatch):
    from pyspark.errors import AnalysisException

    from lineflow.sources.files import list_blobs, stored_cut

    assert list_blobs(spark, str(tmp_path / "none")) is None and stored_cut(spark, str(tmp_path / "none")) is None
    with pytest.raises(AnalysisException):
        list_blobs(spark, str(tmp_path), options={"modifiedAfter": "no time"})


def test_a_topic_keeps_its_checkpoint(spark):
    from lineflow.options import OptionError
    from lineflow.streaming.runner import claim_checkpoint

    run = new_run_dir(spark, "t-topic")
    o = FlowOptions(flow="f", input="topic_a", output="x")
    claim_checkpoint(spark, o, f"{run}/ckpt")
    claim_checkpoint(spark, o, f"{run}/ckpt")
    with pytest.raises(OptionError, match="belongs to input kafka://topic_a"):
        claim_checkpoint(spark, FlowOptions(flow="f", input="topic_b", output="x"), f"{run}/ckpt")
