"""The corpus pipeline: documents through five operators of ``lineflow.llm``.

Each stage works on all rows that the one before kept; ``run`` writes every
stage's rows to the shared checkpoint folder and reads them back.  All stages
but the last return all columns of their input.

* ``language``: a byte network learns from the rows' own labels; rows whose
  text has no letter, or whose score is below ``MIN_SCORE``, go.  Without a
  labelled row there is nothing to learn: all rows with a letter stay.
* ``line_dedup``: cross-site boilerplate lines are cut from the texts, whatever
  their share; ``n_chars`` follows.  A copied text counts for one site, so that
  copies reach the next stage as copies, without the notices they carry.
* ``jaccard``: of the texts linked at 0.8 over shingles of five words, the
  one with the least id stays.
* ``decontaminate``: rows that hold ten words in a row of a benchmark item go.
* ``bpe``: token ids of the texts that are left, and whether they decode to
  the same text.

The language stage cannot be said in SQL, so ``ORACLE_SQL`` is None; the
stages are tested against plain Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.llm import bpe, decontam, jaccard, langid, linededup
from lineflow.llm.textops import bounded_batches, table
from lineflow.session import new_run_dir, ship_package

MIN_SCORE = 0.3
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    bounded_batches(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    net = langid.train(docs)
    if net is None:
        return langid.lettered(docs)
    # the row travels as one column, so that no name of its own can clash
    judged = langid.predict(docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("_row"), "text"), net)
    kept = judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.select(*(F.col("_row")[c].alias(c) for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = linededup.remove_boilerplate(docs)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return jaccard.keep_one(docs, width=5, threshold=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    items = table(spark, sf_dir, "benchmark")
    return decontam.drop_contaminated(docs, items, f"{new_run_dir(spark, 'postings')}/index")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    out = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text"), BYTE_BPE), BYTE_BPE)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [("language", language), ("line_dedup", line_dedup), ("jaccard", near_duplicates),
          ("decontaminate", decontaminate), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = new_run_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
