"""Quality classifier (operator 5): supervised subword embeddings.

Hashed word and character n-grams have learned vectors; a text is their
average, and a softmax over two classes follows.  Fitted by stochastic
gradients in numpy on a bounded sample (``linear.FIT_ROWS``) of one fold of
labelled rows, calibrated on another one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewinnow.llm.linear import CALIBRATION_ROWS, FIT_ROWS, Model, calibrated, fit_embeddings, sampled
from pagewinnow.llm.shared import held_out, ship, slices, table

ship(__name__)

GOOD_FROM = 0.5
SLICE = 4 << 20


def learned(docs: DataFrame, labels: DataFrame, label: str) -> Model:
    fitted = fit_embeddings(sampled(docs, labels, label, 0, FIT_ROWS, balanced=True))
    return calibrated(fitted, sampled(docs, labels, label, 2, CALIBRATION_ROWS, balanced=False))


def classified(docs: DataFrame, labels: DataFrame, label: str = "quality", good_from: float = GOOD_FROM) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have no grams and score what the bias says.  A null id
    is in no fold, so it isn't held out.  Repeated rows score alike.  Without
    labelled rows of both classes the score is the constant share of ones.
    Other columns are ignored.
    """
    model = learned(docs, labels, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                score = model.scores([t or "" for t in batch.column(2).to_pylist()])
                arrays = [*batch.columns[:2], pa.array(score), pa.array((score >= good_from).astype("i4"))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(
        F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
