"""Sinks for processed pages and run records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewinnow.operators.assemble import STREAMS
from pagewinnow.operators.ledger import LEDGER_COLUMNS


def split_sinks(processed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write accepted and refused pages to their own partitions in one pass.

    One job and one write: the documents are processed once, and each side is
    read back by partition pruning.  A refused row keeps its ledger columns and
    none of its text.
    """
    accepted = F.col("outcome") == "ok"
    let_go = {c: F.when(accepted, F.col(c)).otherwise("") for c in STREAMS if c in processed.columns}
    if "metadata" in processed.columns:
        let_go["metadata"] = F.when(accepted, F.col("metadata"))
    # files are named by task, so a hot reason is spread over many files
    processed.withColumns(let_go).withColumn("refused_as", F.coalesce("reason", F.lit("none"))).write.mode(
        mode
    ).partitionBy("outcome", "refused_as").parquet(path)


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    kept = spark.read.parquet(path).where(F.col("outcome") == "ok")
    return kept.drop("outcome", "refused_as", "reason", "reason_detail", "reason_offset")


def read_refused(spark: SparkSession, path: str) -> DataFrame:
    """Ledger columns of refused pages; the text columns are not read."""
    return spark.read.parquet(path).where(F.col("outcome") != "ok").select(*LEDGER_COLUMNS)


def run_record(
    spark: SparkSession,
    verdict: DataFrame,
    scores: DataFrame,
    run_date: dt.date,
    corpus_version: str,
    gate_row: str,
) -> DataFrame:
    """One row: date, corpus, pages, verdict and the F-score of the gate row."""
    gate = scores.where(F.col("run") == gate_row).agg(F.max("f_score").alias("f"))
    return verdict.select(
        F.lit(run_date).alias("run_date"),
        F.lit(corpus_version).alias("corpus_version"),
        F.col("pages_b").alias("pages"),
        "verdict",
        gate.select("f").scalar().alias("fscore"),
    )


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)
