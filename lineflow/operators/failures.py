"""Dead letters (MAP-14): failed records as rows, beside the flow's output, with exact counts.

A flow whose Python steps suppress errors is run once; its outputs and the
records that failed, each with its step and reason, are staged together in the
shared folder.  Both results are read from there, so no record goes through
the flow twice and the two always belong to the same run.  The counts are
observed on the staged write (``DataFrame.observe``): what a retried task
counted on its first attempt is not in them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lineflow.operators.batch import FAILED, FAILED_TYPE
from lineflow.plans.flow import Flow, Step, run_frames
from lineflow.session import new_run_dir

OUT = "__out"


@dataclass(frozen=True)
class Outcome:
    """``records`` (``keep`` and the output), ``failures`` (``keep, step, record, reason``), and their exact counts."""

    records: DataFrame
    failures: DataFrame
    counts: dict[str, int]  # inputs, records, failures


def run_with_failures(df: DataFrame, flow: Step | Flow, record: str | Column = "str", keep: Sequence[str | Column] = (),
                      output: str = "record") -> Outcome:
    """Run the flow on a batch; records that an error-suppressing step fails on come back as ``failures``."""
    spark = df.sparkSession
    none = F.array().cast(FAILED_TYPE).alias(FAILED)
    frames = run_frames(df, flow, record, keep=[*keep, none], output=OUT)
    names = frames.columns[:len(keep)]
    seen = Observation()
    folder = f"{new_run_dir(spark, 'outcome')}/frames"
    frames.observe(seen, F.count(F.lit(1)).alias("inputs"), F.coalesce(F.sum(F.size(OUT)), F.lit(0)).alias("records"),
                   F.coalesce(F.sum(F.size(FAILED)), F.lit(0)).alias("failures")).write.parquet(folder)
    staged = spark.read.schema(frames.schema).parquet(folder)
    kept = [F.col(f"`{n}`") for n in names]
    return Outcome(staged.select(*kept, F.explode(OUT).alias(output)), staged.select(*kept, F.inline(FAILED)), dict(seen.get))
