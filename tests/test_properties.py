"""Property: record mode and framed mode of any flow give the same outputs per input."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lineflow import (
    drop_if,
    flat_step,
    keep_if,
    map_step,
    pandas_step,
    python_step,
    repeat,
    run_frames,
    run_records,
    tokenize,
    upcase,
)

STEPS = {
    "upcase": lambda: upcase(),
    "tokenize": lambda: tokenize(),
    "repeat2": lambda: repeat(2),
    "drop_a": lambda: drop_if(lambda x: x.startswith("a"), "drop_a"),
    "keep_short": lambda: keep_if(lambda x: F.length(x) < 6, "keep_short"),
    "null_if_b": lambda: map_step(lambda x: F.when(~x.contains("b"), x), "null_if_b"),
    "pairs": lambda: flat_step(lambda x: F.array(x, F.concat(x, F.lit("!"))), "pairs"),
    "py_split": lambda: python_step(lambda s: s.split("c"), "py_split"),
    "pd_split": lambda: pandas_step(lambda s: s.str.split("b"), "pd_split"),
}

lines = st.lists(st.text(alphabet="abc \t", max_size=12), min_size=1, max_size=8)
flows = st.lists(st.sampled_from(sorted(STEPS)), min_size=1, max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=lines, names=flows)
def test_record_and_frame_modes_agree(spark, values, names):
    flow = STEPS[names[0]]()
    for n in names[1:]:
        flow = flow | STEPS[n]()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, str string")
    records = Counter((r.id, r.record) for r in run_records(df, flow, "str", keep=["id"]).collect())
    frames = run_frames(df, flow, "str", keep=["id"]).collect()
    assert len(frames) == len(values)  # one frame per input, even when empty
    assert Counter((r.id, x) for r in frames for x in r.out) == records


texts = st.lists(st.text(alphabet="ab \r\n", max_size=300), min_size=1, max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(contents=texts)
def test_line_numbering_ways_agree(spark, tmp_path_factory, contents):
    from lineflow.sources.records import read_numbered_lines, read_wholetext, recordize

    d = tmp_path_factory.mktemp("lines")
    for i, c in enumerate(contents):
        (d / f"f{i}.txt").write_bytes(c.encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        split = Counter(tuple(r) for r in read_numbered_lines(spark, str(d)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = Counter(tuple(r) for r in recordize(read_wholetext(spark, str(d)), "value", "path")
                    .select("content", "metadata", "linenumber").collect())
    assert split == whole
