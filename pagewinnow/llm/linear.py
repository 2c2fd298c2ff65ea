"""Models over hashed n-grams, trained in numpy on a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pagewinnow.llm.ngrams import BITS, features, labelled, means, texts_of
from pagewinnow.llm.shared import ship

ship(__name__)

#: bounds of the samples that models are fitted and calibrated on
FIT_ROWS, CALIBRATION_ROWS = 3000, 2000
#: grams of a sample's texts, at the most, that meet in the driver, of 8 bytes each; text has about a third of that
SAMPLE_GRAMS = 64_000_000
SAMPLE = "doc_id long, y int, slots array<int>, shares array<float>"


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Model:
    """A score per text: ``logistic(slope * (bias + mean table entries) + shift)``."""

    table: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, texts: list[str]) -> np.ndarray:
        return self.bias + means(texts, self.table)

    def scores(self, texts: list[str]) -> np.ndarray:
        return logistic(self.slope * self.raw(texts) + self.shift)


Rows = list[tuple[int, np.ndarray, np.ndarray]]


def sampled(
    docs: DataFrame, labels: DataFrame, label: str, fold: int, most: int, balanced: bool, most_grams: int = SAMPLE_GRAMS
) -> Rows:
    """``(y, slots, shares)`` of the sample in the order of its ids; bounded in rows and in size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text, y = (c[i].as_py() for c in batch.columns)
                slots, shares = features(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc], pa.int64()),
                        pa.array([y], pa.int32()),
                        pa.array([slots], pa.list_(pa.int32())),
                        pa.array([shares], pa.list_(pa.float32())),
                    ],
                    ["doc_id", "y", "slots", "shares"],
                )

    rows = texts_of(docs, labelled(labels, label, fold, most, balanced), most_grams).mapInArrow(run, SAMPLE).toArrow()
    order = np.argsort(rows["doc_id"].to_numpy())
    y, slots, shares = rows["y"].to_numpy(), rows["slots"], rows["shares"]
    return [(int(y[i]), slots[int(i)].values.to_numpy(), shares[int(i)].values.to_numpy()) for i in order]


def calibrated(model: Model, rows: Rows) -> Model:
    """Platt's fit of the probability on rows the table has not been fitted to."""
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return model
    x = np.array([model.bias + float(model.table[slots] @ shares) for _, slots, shares in rows])
    ones, zeros = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design = np.column_stack([x, np.ones(len(x))])
    coef = np.zeros(2)
    for _ in range(60):  # Newton's steps, slightly damped
        p = logistic(design @ coef)
        gradient = design.T @ (p - target) + 1e-3 * coef
        curvature = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        coef -= np.linalg.solve(curvature, gradient)
    model.slope, model.shift = map(float, coef)
    return model


def prior(rows: Rows) -> Model:
    """Without rows of both classes: a constant score."""
    ones = sum(y for y, *_ in rows)
    p = (ones + 1) / (len(rows) + 2)
    return Model(np.zeros(1 << BITS, np.float32), float(np.log(p / (1 - p))))


def fit_logistic(rows: Rows, epochs: int = 12, rate: float = 0.5, decay: float = 1e-6) -> Model:
    """Logistic regression by adaptive stochastic gradients."""
    if len({y for y, *_ in rows}) < 2:
        return prior(rows)
    table, sums = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    bias, bias_sum = 0.0, 1e-8
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            y, slots, shares = rows[i]
            slip = logistic(bias + float(table[slots] @ shares)) - y
            step = slip * shares + decay * table[slots]
            sums[slots] += step * step
            table[slots] -= rate * step / np.sqrt(sums[slots])
            bias_sum += slip * slip
            bias -= 0.1 * slip / np.sqrt(bias_sum)
    return Model(table.astype(np.float32), bias)


def fit_embeddings(rows: Rows, width: int = 8, epochs: int = 10, rate: float = 0.1) -> Model:
    """Learned vectors of grams, averaged over a text, with a softmax output of two classes.

    Averaging and the output's matrix are linear, so for scoring the difference
    of the two outputs is folded into one number per gram.
    """
    if len({y for y, *_ in rows}) < 2:
        return prior(rows)
    order = np.random.default_rng(11)
    vectors = order.normal(0, 0.1, (1 << BITS, width)).astype(np.float32)
    sums = np.full(1 << BITS, 1e-10, np.float32)
    out, out_sums = order.normal(0, 0.1, (2, width)).astype(np.float32), np.full((2, width), 1e-8, np.float32)
    bias, bias_sums = np.zeros(2, np.float32), np.full(2, 1e-8, np.float32)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            y, slots, shares = rows[i]
            hidden = shares @ vectors[slots]
            logits = out @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1  # the gradient of the softmax loss
            back = p @ out
            out_step = np.outer(p, hidden)
            out_sums += out_step**2
            out -= rate * out_step / np.sqrt(out_sums)
            bias_sums += p * p
            bias -= rate * p / np.sqrt(bias_sums)
            sums[slots] += shares**2 * float(back @ back) / width
            vectors[slots] -= rate * (shares / np.sqrt(sums[slots]))[:, None] * back
    side = out[1] - out[0]
    return Model((vectors @ side).astype(np.float32), float(bias[1] - bias[0]))
