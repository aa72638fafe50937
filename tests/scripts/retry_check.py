"""Run in its own process: tasks fail on their first attempt and must be retried to exact results."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lineflow import command_step, python_step, run_records, run_with_failures  # noqa: E402
from lineflow.sources.records import read_numbered_lines  # noqa: E402


def flaky_upper(line: str) -> str:
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("executor lost (simulated)")
    return line.upper()


def no_ones(line: str) -> str:
    if line.endswith("1"):
        raise ValueError("ends in 1")
    return line


def main() -> None:
    text_dir, ckpt = sys.argv[1], sys.argv[2]
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", ckpt)
             .config("spark.sql.files.maxPartitionBytes", "20000").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    lines = read_numbered_lines(spark, text_dir)
    flow = python_step(flaky_upper, "flaky_upper", suppress_errors=False) | command_step(
        ["awk", '{ print $0; print "---" }'])
    out = run_records(lines, flow, "content", keep=["metadata", "linenumber"])
    rows = out.select(F.regexp_extract("metadata", r"([^/]+)$", 1).alias("f"), "linenumber", "record").collect()
    # the first attempts count their failed records too, and are lost
    fussy = python_step(no_ones, "no_ones", suppress_errors=True) | python_step(flaky_upper, "flaky_upper")
    outcome = run_with_failures(lines, fussy, "content", keep=["linenumber"])
    print(json.dumps([outcome.counts, outcome.failures.count(), outcome.records.count()]))
    print(json.dumps(sorted([r.f, r.linenumber, r.record] for r in rows)))


if __name__ == "__main__":
    main()
