"""Record steps, composition and the two compiled shapes (MAP-1..14, UDF-1..3)."""

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from lineflow import (
    Flow,
    dataflow,
    drop_if,
    flat_step,
    from_json,
    identity,
    interpolate,
    keep_if,
    lookup,
    map_step,
    processor,
    python_step,
    repeat,
    run_frames,
    run_records,
    skip,
    to_json,
    tokenize,
    upcase,
)
from lineflow.functions.udtf import factorize, register_udtfs, with_prime_factors


def df_of(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, str string")


def recs(df):
    return sorted((r[0], r[1]) for r in df.collect())


def test_compose_and_describe():
    f = identity() | upcase() | tokenize()
    assert isinstance(f, Flow) and f.describe() == "identity | upcaser | tokenizer"
    assert (f | (repeat(2) | skip())).describe() == "identity | upcaser | tokenizer | multi | skipped"


def test_record_and_frame_shapes_agree(spark):
    df = df_of(spark, ["a b", "", "c", None, "err x"])
    f = upcase() | tokenize() | drop_if(lambda x: x == "ERR") | repeat(2)
    rows = recs(run_records(df, f, "str", keep=["id"]))
    assert rows == [(0, "A"), (0, "A"), (0, "B"), (0, "B"), (2, "C"), (2, "C"), (4, "X"), (4, "X")]
    frames = {r.id: r.out for r in run_frames(df, f, "str", keep=["id"]).collect()}
    assert frames == {0: ["A", "A", "B", "B"], 1: [], 2: ["C", "C"], 3: [], 4: ["X", "X"]}


def test_null_map_output_means_no_output(spark):
    df = df_of(spark, ["keep", "drop"])
    f = map_step(lambda x: F.when(x != "drop", x), "maybe") | map_step(lambda x: F.coalesce(x, F.lit("back")))
    assert recs(run_records(df, f, "str", keep=["id"])) == [(0, "keep")]
    assert [r.out for r in run_frames(df, f, "str", keep=["id"]).orderBy("id").collect()] == [["keep"], []]


def test_json_round_trip(spark):
    df = df_of(spark, ['{"foo":"bar","k":3}', "junk", '{"foo":null,"k":1}'])
    typed = from_json("foo STRING, k BIGINT") | keep_if(lambda x: x["k"] >= 1) | to_json()
    assert recs(run_records(df, typed, "str", keep=["id"])) == [(0, '{"foo":"bar","k":3}'),
                                                                 (2, '{"foo":null,"k":1}')]
    open_ = from_json() | to_json()
    assert recs(run_records(df, open_, "str", keep=["id"])) == [(0, '{"foo":"bar","k":3}'),
                                                                 (2, '{"foo":null,"k":1}')]


def test_interpolate_on_struct_variant_text(spark):
    df = df_of(spark, ['{"foo":"bar"}', '{"foo":7}', "{}"])
    expect = [(0, "I raised the bar"), (1, "I raised the 7"), (2, "I raised the ")]
    it = interpolate("I raised the {foo}")
    assert recs(run_records(df, it, "str", keep=["id"])) == expect
    assert recs(run_records(df, from_json() | it, "str", keep=["id"])) == expect
    assert recs(run_records(df, from_json("foo STRING") | it, "str", keep=["id"])) == expect


def test_python_step_suppresses_or_raises(spark):
    df = df_of(spark, ["4", "0", "x", "2"])

    def inv(s):
        yield str(8 // int(s))
        yield "again"

    out = recs(run_records(df, python_step(inv, "inv", suppress_errors=True), "str", keep=["id"]))
    assert out == [(0, "2"), (0, "again"), (3, "4"), (3, "again")]
    with pytest.raises(PythonException, match="ZeroDivisionError|ValueError"):
        run_records(df, python_step(inv), "str").collect()


def test_table_step_between_expression_steps(spark):
    df = df_of(spark, ["a b", "c"])
    f = tokenize() | python_step(lambda s: [s, s + s]) | upcase()
    assert recs(run_records(df, f, "str", keep=["id"])) == [(0, "A"), (0, "AA"), (0, "B"), (0, "BB"), (1, "C"),
                                                             (1, "CC")]
    assert [r.out for r in run_frames(df, f, "str", keep=["id"]).orderBy("id").collect()] == [
        ["A", "AA", "B", "BB"], ["C", "CC"]]


def test_registry(spark):
    @processor("shout", kind="flat")
    def shout(x):
        return F.array(F.upper(x), F.lit("!"))

    dataflow("shout_twice", "shout", repeat(2))
    assert lookup("shout_twice").describe() == "shout | multi"
    assert recs(run_records(df_of(spark, ["hi"]), lookup("shout_twice"), "str", keep=["id"])) == [
        (0, "!"), (0, "!"), (0, "HI"), (0, "HI")]


def test_flat_with_null_arrays(spark):
    df = df_of(spark, ["a", "b"])
    f = flat_step(lambda x: F.when(x == "a", F.array(x, F.lit(None).cast("string"))), "maybe_array")
    assert recs(run_records(df, f, "str", keep=["id"])) == [(0, "a")]
    assert [r.out for r in run_frames(df, f, "str", keep=["id"]).orderBy("id").collect()] == [["a"], []]


def test_prime_factors(spark):
    assert [list(factorize(n)) for n in (None, 0, 1, 2, 12, 19, 97 * 97, 2**10)] == [
        [], [], [], [2], [2, 2, 3], [19], [97, 97], [2] * 10]
    df = spark.createDataFrame([(1, 12), (2, 19), (3, 1)], "id long, n int")
    rows = sorted(tuple(r) for r in with_prime_factors(df, "n", ["id"]).collect())
    assert rows == [(1, 2), (1, 2), (1, 3), (2, 19)]
    register_udtfs(spark)
    df.createOrReplaceTempView("nums")
    sql = spark.sql("select id, factor from nums, lateral prime_factors(n)")
    assert sorted(tuple(r) for r in sql.collect()) == rows


def test_filter_reaches_parquet_scan(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = run_records(ev, keep_if(lambda x: x != "error"), "event_type", keep=["event_id"])._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))]" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_dataframe_step(spark):
    from lineflow import dataframe_step

    df = df_of(spark, ["b a", "a", "c a b"])
    distinct_words = tokenize() | dataframe_step(lambda d: d.dropDuplicates(["record"]), "distinct") | upcase()
    out = sorted(r.record for r in run_records(df, distinct_words, "str").collect())
    assert out == ["A", "B", "C"]
    with pytest.raises(ValueError, match="per-input frame"):
        run_frames(df, distinct_words, "str")
    with pytest.raises(ValueError, match="record column"):
        run_records(df, dataframe_step(lambda d: d.select("id")), "str", keep=["id"])


def test_null_record_has_no_outputs_after_flat(spark):
    # found by the property test: a null from a map must not be repeated by a later flat step
    df = df_of(spark, ["b", "a"])
    f = map_step(lambda x: F.when(~x.contains("b"), x), "null_if_b") | repeat(2)
    assert recs(run_records(df, f, "str", keep=["id"])) == [(1, "a"), (1, "a")]
    assert [r.out for r in run_frames(df, f, "str", keep=["id"]).orderBy("id").collect()] == [[], ["a", "a"]]


def test_expensive_map_evaluated_once(spark):
    from lineflow.plans.topology import explain_text

    df = df_of(spark, ['{"k": 70}'])
    f = from_json("k BIGINT") | keep_if(lambda r: r["k"] >= 50) | to_json()
    plan = explain_text(run_records(df, f, "str", keep=["id"]), "simple").splitlines()
    # one operator each (within an operator, subexpression elimination evaluates repeats once)
    assert sum("from_json(" in line for line in plan) == 1
    assert sum("StructsToJson" in line for line in plan) == 1


def test_pandas_step_matches_python_step(spark):
    from lineflow import pandas_step

    df = df_of(spark, ["a b", "", "c", None, "d e f"])
    split = pandas_step(lambda s: s.str.split(), "split")
    shout = pandas_step(lambda s: s.str.upper().where(s != "c"), "shout_unless_c")
    f = split | shout
    expect = recs(run_records(df, python_step(str.split) | python_step(lambda w: None if w == "c" else w.upper()),
                              "str", keep=["id"]))
    assert recs(run_records(df, f, "str", keep=["id"])) == expect == [
        (0, "A"), (0, "B"), (4, "D"), (4, "E"), (4, "F")]
    frames = {r.id: r.out for r in run_frames(df, f, "str", keep=["id"]).collect()}
    assert frames == {0: ["A", "B"], 1: [], 2: [], 3: [], 4: ["D", "E", "F"]}


def test_pandas_step_lists_with_nulls(spark):
    from lineflow import pandas_step

    df = df_of(spark, ["x", "y", "z"])
    f = pandas_step(lambda s: s.map(lambda v: None if v == "y" else [v, None, v + "!"]), "with_nulls")
    assert recs(run_records(df, f, "str", keep=["id"])) == [(0, "x"), (0, "x!"), (2, "z"), (2, "z!")]


def test_python_processor_like_the_reference(spark):
    @processor("yield_twice_unless_blank", kind="python")
    def twice(line):
        if line.strip():
            yield line
            yield line.upper()

    @processor("vector_len", kind="pandas")
    def lengths(s):
        return s.str.len().astype(str)

    df = df_of(spark, ["ab", " "])
    assert recs(run_records(df, lookup("yield_twice_unless_blank") | lookup("vector_len"), "str", keep=["id"])) == [
        (0, "2"), (0, "2")]


def test_interpolate_nested_and_missing(spark):
    df = df_of(spark, ['{"user":{"name":"ann"},"k":1}', '{"k":2}'])
    it = interpolate("{user.name}:{k}:{nope}")
    expect = [(0, "ann:1:"), (1, ":2:")]
    assert recs(run_records(df, it, "str", keep=["id"])) == expect
    assert recs(run_records(df, from_json() | it, "str", keep=["id"])) == expect
    assert recs(run_records(df, from_json("user STRUCT<name: STRING>, k BIGINT") | it, "str", keep=["id"])) == expect


def test_suppressed_errors_are_dead_letters(spark):
    from lineflow import run_with_failures

    df = spark.createDataFrame([(i, str(i)) for i in range(20)] + [(20, None)], "id int, str string").repartition(3)
    step = python_step(lambda s: [s, 1 // (int(s) % 5)], "count_errors", suppress_errors=True)
    flow = upcase() | step | python_step(lambda s: 1 // (int(s) - 7), "second", suppress_errors=True)
    out = run_with_failures(df, flow, "str", keep=["id"])
    assert sorted((r.id, r.step, r.record, r.reason.split(":")[0]) for r in out.failures.collect()) == sorted(
        [(i, "count_errors", str(i), "ZeroDivisionError") for i in (0, 5, 10, 15)] + [(7, "second", "7", "ZeroDivisionError")])
    assert out.counts == {"inputs": 21, "records": out.records.count(), "failures": 5}
    assert out.records.count() == 31
    assert recs(run_records(df, step, "str", keep=["id"])) == sorted(
        (i, v) for i in range(20) if i % 5 for v in (str(i), str(1 // (i % 5))))


def test_python_steps_see_parsed_records(spark):
    import json

    df = spark.createDataFrame([(1, '{"foo": "bar", "n": [1, {"x": null}]}'), (2, "[1, 2]"), (3, "junk")], "id int, str string")
    variant = from_json() | python_step(lambda r: r["foo"] if isinstance(r, dict) else len(r), "foo")
    assert recs(run_records(df, variant, "str", keep=["id"])) == [(1, "bar"), (2, "2")]
    typed = from_json("foo STRING, n ARRAY<STRING>") | python_step(lambda r: {"was": r["foo"], "é": None}, "again") | to_json()
    out = [json.loads(r.record) for r in run_records(df.where("id = 1"), typed, "str").collect()]
    assert out == [{"was": "bar", "é": None}]
    many = from_json() | python_step(lambda r: [{"a": 1}, None, 7] if isinstance(r, dict) else None, "many")
    assert sorted(r.record for r in run_records(df, many, "str").collect()) == ["7", '{"a":1}']


def test_parsed_records_reach_commands_as_json(spark):
    from lineflow import command_step

    df = spark.createDataFrame([('{"foo": 1}',)], "str string")
    flow = from_json() | command_step(["awk", '{ print $0; print "---"; fflush() }'])
    assert [r.record for r in run_records(df, flow, "str").collect()] == ['{"foo":1}']


def test_from_json_with_any_field_name(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("user-id", LongType()), StructField("a b:c", StringType())])
    df = spark.createDataFrame([('{"user-id": 5, "a b:c": "x"}',), ("junk",)], "str string")
    assert [tuple(r.record) for r in run_records(df, from_json(schema), "str").collect()] == [(5, "x")]


def test_large_factors():
    from lineflow.functions.udtf import factorize

    big = 2_147_483_659
    assert list(factorize(big)) == [big]
    for n in (12, 19, 1, 0, -4, None, 2**62, 3037000493**2, 2147483647 * 4294967291, 9223372036854775783, 999983 * 1000003, 997**6):
        found = list(factorize(n))
        product = 1
        for p in found:
            product *= p
        assert found == sorted(found) and product == (n if n and n > 1 else 1)
    assert list(factorize(3037000493**2)) == [3037000493] * 2


def test_factors_of_a_batch():
    """Array trial division, primality and cycle searches give what factoring one number at a time gives."""
    import random

    import numpy as np

    from lineflow.functions.udtf import factor_batch

    rng = random.Random(11)
    values = [0, 1, -5, 2, 12, 19, 997 * 997, 1009 * 1009, 1009 * 1013, 2**31 - 1, (2**31 - 1) ** 2, 2**61 - 1, 2**62, 3**39,
              1000003 * 998244353, 67280421 * 2147483629, 2**63 - 1, 9223372036854775783]
    values += [rng.randrange(2, 10**k) for k in range(1, 16) for _ in range(8)]
    rows, factors = factor_batch(np.array(values, np.int64))
    got = [[] for _ in values]
    for r, f in zip(rows.tolist(), factors.tolist(), strict=True):
        got[r].append(f)
    assert got == [list(factorize(v)) for v in values]
    assert factor_batch(np.empty(0, np.int64))[0].size == 0
