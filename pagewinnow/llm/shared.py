"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def ship(module: str) -> None:
    """Send the functions of a module to the executors with each job; they need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (the folder may be in any store Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only a local session may do without the setting; it gets a fresh temporary
    folder.  On a cluster a missing setting is an error, because executors
    would write to disks that the others can't read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = spark.sparkContext.getCheckpointDir()
    if made is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagewinnow-llm-"))
        made = spark.sparkContext.getCheckpointDir()
    return made


def settle(df: DataFrame) -> DataFrame:
    """Work ``df`` out once through a reliable checkpoint; this cuts its lineage."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Work ``df`` out once into Parquet in the shared folder and read it back.

    For wide results: Parquet compresses them, a checkpoint doesn't.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_value(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker makes once and keeps for its later tasks.

    Functions travel by value, so their modules' globals are new with each
    task; a module that stands in ``sys.modules`` stays as long as the worker.
    """
    kept = sys.modules.setdefault("pagewinnow_llm_worker", types.ModuleType("pagewinnow_llm_worker"))
    values = kept.__dict__.setdefault("values", {})
    if name not in values:
        values[name] = make()
    return values[name]


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, name: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about ``most`` bytes of ``name``, one row at least."""
    column = batch.column(batch.schema.get_field_index(name))
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    begin = total = 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: ``node, root`` with the smallest node as root.

    Large-star and small-star steps in turn: every node hands its neighbours to
    the smallest node it knows, so the diameter shrinks geometrically.  The
    minimum is an aggregate with a map-side part and returns by a join that
    adaptive execution can split, so a node with very many neighbours is no
    single task.  Each round ends in a reliable checkpoint.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = settle(e)
    known = state(e)
    for _ in range(rounds):
        if not known[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("m").alias("b")),
                    F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")),
                )
            ).alias("x")
        )
        e = settle(small.select("x.a", "x.b").where("a <> b").distinct())
        now = state(e)
        if now == known:
            break
        known = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # settled: every node but the roots has one edge, to its root
    own = e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    roots = e.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return own.unionByName(roots)
