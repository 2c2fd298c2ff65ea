"""Quality rules (operator 1): plain counts with fixed limits, then a calibrated n-gram regression.

The regression over hashed word and character n-grams is fitted on one fold of
labelled rows and calibrated (Platt) on another; every text is then scored in
Arrow batches and kept at a fixed probability.  The samples are bounded by
``linear.FIT_ROWS`` and ``linear.CALIBRATION_ROWS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewinnow.llm.linear import CALIBRATION_ROWS, FIT_ROWS, Model, calibrated, fit_logistic, sampled
from pagewinnow.llm.shared import ship, slices, table

ship(__name__)

KEEP_FROM = 0.5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
RUN = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
SLICE = 4 << 20
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words inside runs of ``RUN`` words that come at least twice, the first time counted as well."""
    n = len(words) - RUN + 1
    if n < 2:
        return 0
    codes = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    runs = codes
    for k in range(1, RUN):  # exact names of longer and longer runs
        runs = pd.factorize(runs[:-1] * len(words) + codes[k:])[0]
    again = np.bincount(runs)[runs] > 1
    covered = np.zeros(len(words), bool)
    for k in range(RUN):
        covered[k : k + n] |= again
    return int(covered.sum())


def stats(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    fitted = fit_logistic(sampled(docs, labels, "quality", 0, FIT_ROWS, balanced=True))
    return calibrated(fitted, sampled(docs, labels, "quality", 2, CALIBRATION_ROWS, balanced=False))


def judged(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ("doc_id",), keep_from: float = KEEP_FROM) -> DataFrame:
    """The columns ``carry`` of ``docs(doc_id, text)``, the counts, ``base_failed``, ``score`` and ``kept``.

    A row per row; repeated rows are judged alike.  Null, empty and blank texts
    have no words and fail the base.  Without labelled rows of both classes the
    score is the constant share of good ones.  Labels that are null, not 0 or 1
    or contradict each other are ignored.  Columns that aren't named are ignored.
    """
    model = learned(docs, labels)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(
        [*(f"`{c}` {kinds[c]}" for c in carry), *(f"{s} long" for s in STATS), "base_failed boolean, score double, kept boolean"]
    )
    names = [*carry, *STATS, "base_failed", "score", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "judged_text", SLICE):
                texts = [t or "" for t in batch.column(len(carry)).to_pylist()]
                counts = np.array([stats(t) for t in texts], np.int64).reshape(-1, len(STATS))
                failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED_PERCENT * counts[:, 0])
                score = model.scores(texts)
                arrays = [*batch.columns[: len(carry)], *(pa.array(c) for c in counts.T)]
                arrays += [pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep_from))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(*carry, F.col("text").cast("string").alias("judged_text")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(docs, table(spark, sf_dir, "labels")).select("doc_id", *STATS, "base_failed", "kept", "score")
