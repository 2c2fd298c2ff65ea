"""Streaming intake of pages.

Row windows do not run on streams, and extraction is a function of one page,
so ``stream_extract`` runs the batch job on each micro-batch.  A batch is
written under its own number with overwrite, so a batch replayed after a
failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pagewinnow.functions.text import squash
from pagewinnow.operators.intake import gate_reason
from pagewinnow.operators.repeats import body_hashes, content_hash, new_bodies, with_firsts
from pagewinnow.options import ExtractOptions, OptionError
from pagewinnow.plans.extract import process, process_with_bodies

BODY_SCHEMA = "body BINARY, first_page BIGINT"
PAGE_SCHEMA = "page_id BIGINT, url STRING, html STRING"


def read_page_stream(spark: SparkSession, path: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


class _Bodies:
    """An index of body hashes in a folder, versioned by run and batch; 40 bytes a body."""

    def __init__(self, folder: str, run: str):
        if "/" in run or not run:
            raise OptionError(f"run: expected a plain name, got {run!r}")
        self.folder, self.run = folder.rstrip("/"), run

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """``body, first_page`` of all other runs and of this run's earlier batches."""
        spark.createDataFrame([], BODY_SCHEMA).coalesce(1).write.mode("ignore").parquet(f"{self.folder}/run=none/batch_id=-1")
        every = spark.read.schema(f"{BODY_SCHEMA}, run STRING, batch_id BIGINT").parquet(self.folder)
        return every.where((F.col("run") != self.run) | (F.col("batch_id") < batch_id)).select("body", "first_page")

    def add(self, hashed: DataFrame, seen: DataFrame, batch_id: int) -> None:
        """The batch's new bodies, in place of what an earlier try wrote."""
        new_bodies(hashed, seen).write.mode("overwrite").parquet(f"{self.folder}/run={self.run}/batch_id={batch_id}")


def stream_extract(
    pages: DataFrame, sink: str, checkpoint: str, options=None, index: str | None = None, run: str = "stream", **overrides
) -> StreamingQuery:
    """Accepted and refused pages of each batch to ``sink/batch_id=N``.

    With ``deduplicate`` copies of bodies of earlier batches, and of other runs
    that use the same ``index`` folder, are refused too: the first batch that
    has a body keeps it, within a batch the smallest ``page_id``.  A batch adds
    its new bodies under its ``run`` and number and looks only at what lies
    before it, so a replayed batch gives the same rows and the same index.
    """
    from pagewinnow.sources.sinks import split_sinks

    options = ExtractOptions.of(options, **overrides)
    bodies = _Bodies(index or f"{sink.rstrip('/')}-bodies", run)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        if not options.deduplicate:
            split_sinks(process(batch, options), f"{sink}/batch_id={batch_id}", mode="overwrite")
            return
        seen = bodies.before(batch.sparkSession, batch_id)
        done, hashed = process_with_bodies(batch, options, seen=seen)
        split_sinks(done, f"{sink}/batch_id={batch_id}", mode="overwrite")
        bodies.add(hashed, seen, batch_id)

    return (
        pages.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_tally(
    pages: DataFrame, time: str = "ingest_ts", width: str = "1 minute", late: str = "10 minutes",
    options=None, **overrides,
) -> DataFrame:
    """Gate outcomes per tumbling window; works on streams and batches alike."""
    options = ExtractOptions.of(options, **overrides)
    reason, _ = gate_reason(options.byte_cap)
    gated = pages.selectExpr(time, f"coalesce({reason}, 'ok') AS reason")
    if pages.isStreaming:
        gated = gated.withWatermark(time, late)
    return (
        gated.groupBy(F.window(time, width).alias("w"), "reason")
        .agg(F.count(F.lit(1)).alias("pages"))
        .selectExpr("w.start AS window_start", "reason", "pages")
    )


def stream_tally_sink(
    pages: DataFrame, sink: str, checkpoint: str, time: str = "ingest_ts", width: str = "1 minute", late: str = "10 minutes",
    options=None, **overrides,
) -> StreamingQuery:
    """Gate outcomes per tumbling window, batch by batch, with late rows counted apart.

    The watermark of a batch is the newest time of all batches before it, less
    ``late``; a row is late when its window ended at or before it.  Such rows
    never change a window again, but they are counted, not lost.  Each batch
    writes its own counts and its newest time under its number and reads only
    those before it, so a replayed batch changes nothing.  ``read_tally`` sums up.
    """
    options = ExtractOptions.of(options, **overrides)
    reason, _ = gate_reason(options.byte_cap)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        none = spark.createDataFrame([], "newest TIMESTAMP").coalesce(1)
        none.write.mode("ignore").parquet(f"{sink}/times/batch_id=-1")
        times = spark.read.schema("newest TIMESTAMP, batch_id BIGINT").parquet(f"{sink}/times").where(F.col("batch_id") < batch_id)
        mark = _watermark(times, late)
        rows = batch.selectExpr(f"window({time}, '{width}') AS w", f"coalesce({reason}, 'ok') AS reason")
        counts = rows.groupBy("w", "reason").agg(F.count(F.lit(1)).alias("pages"))
        counts = counts.selectExpr("w.start AS window_start", "w.end AS window_end", "reason", f"coalesce(w.end <= {mark}, false) AS late", "pages")
        counts.write.mode("overwrite").parquet(f"{sink}/counts/batch_id={batch_id}")
        batch.agg(F.max(time).alias("newest")).write.mode("overwrite").parquet(f"{sink}/times/batch_id={batch_id}")

    return (
        pages.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_tally(spark: SparkSession, sink: str, late: str = "10 minutes") -> DataFrame:
    """``window_start, reason, late, closed, pages`` of a tally sink; a closed window takes no more rows."""
    mark = _watermark(spark.read.parquet(f"{sink}/times"), late)
    counts = spark.read.parquet(f"{sink}/counts").groupBy("window_start", "window_end", "reason", "late")
    counts = counts.agg(F.sum("pages").cast("long").alias("pages"))
    return counts.selectExpr("window_start", "reason", "late", f"coalesce(window_end <= {mark}, false) AS closed", "pages")


def _watermark(times: DataFrame, late: str) -> str:
    """The newest time less ``late``, as an expression; one value comes to the driver."""
    (newest,) = times.agg(F.unix_micros(F.max("newest"))).first()
    return "cast(NULL AS timestamp)" if newest is None else f"(timestamp_micros({newest}) - interval {late})"


def stream_dedup(pages: DataFrame, time: str = "ingest_ts", late: str = "10 minutes") -> DataFrame:
    """Drop pages whose body was seen within the lateness bound.

    State holds one 32-byte hash per body inside the watermark, spread by that
    hash; a body on many pages is one state row.  Pages with a blank body have
    no copies and all pass.
    """
    hashed = pages.selectExpr("*", f"{content_hash(squash('html'))} AS body_sha")
    own = "coalesce(body_sha, encode(concat('page ', page_id), 'utf-8'))"
    hashed = hashed.selectExpr("*", f"{own} AS _body")
    if pages.isStreaming:
        return hashed.withWatermark(time, late).dropDuplicatesWithinWatermark(["_body"]).drop("_body")
    return hashed.dropDuplicates(["_body"]).drop("_body")


def stream_unique(
    pages: DataFrame, sink: str, checkpoint: str, index: str | None = None, run: str = "stream"
) -> StreamingQuery:
    """Pages whose raw body no earlier page had, whenever that came, to ``sink/batch_id=N``.

    There is no state store and no bound on lateness: hashes alone are compared,
    with an index in a folder, as in ``stream_extract``; the pages are rejoined by
    ``page_id``, so a body on very many pages sends no page to one task.  Pages
    with a blank body have no copies and all pass.  Within a batch the smallest
    ``page_id`` stays, across batches the first batch.
    """
    bodies = _Bodies(index or f"{sink.rstrip('/')}-bodies", run)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        seen = bodies.before(batch.sparkSession, batch_id)
        hashed = body_hashes(batch.selectExpr("page_id", f"{squash('html')} AS body"), "body")
        kept = with_firsts(batch, hashed, seen).where("seen_page IS NULL AND (first_page IS NULL OR first_page = page_id)")
        kept.drop("seen_page", "first_page").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        bodies.add(hashed, seen, batch_id)

    return (
        pages.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
