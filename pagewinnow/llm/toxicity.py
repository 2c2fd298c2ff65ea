"""Toxicity (operator 3): a weighted lexicon, matched by Aho-Corasick in folded text.

Folding lower-cases, composes accents, maps look-alike letters of other scripts
and full-width forms to Latin ones, and digits that stand inside words to the
letters they replace.  Lexicon entries are whole words and word beginnings;
their weights are log odds learned from one fold of labelled rows.  Hits inside
an exception phrase don't count.  The weight per word and the heaviest hit
enter a logistic function that is fitted on another fold.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewinnow.llm.linear import logistic
from pagewinnow.llm.ngrams import labelled, texts_of
from pagewinnow.llm.shared import held_out, ship, table

ship(__name__)

#: bounds of the samples the weights and the logistic function are fitted on
FIT_ROWS, CALIBRATION_ROWS = 4000, 4000
TOXIC_FROM = 0.7
#: an entry needs so many toxic texts and these log odds, which lie so many standard errors above zero
LEAST_TEXTS, LEAST_ODDS, ERRORS = 3, 2.5, 1.64
BEGINNINGS = range(5, 10)

# fixed values: look-alike letters
LOOKALIKES = str.maketrans(
    "аеорсухіѕјԁһкмтвнԛԝαεορικντυχγɑɡıʟոսօ",
    "aeopcyxisjdhkmtbhqwaeopikvtuxyagilnuo",
)
FULL_WIDTH = {0xFF00 + i: 0x20 + i for i in range(1, 95)}
HIDDEN = dict.fromkeys((0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))
FOLD = LOOKALIKES | FULL_WIDTH | HIDDEN
ODD = re.compile("[" + "".join(map(chr, [*LOOKALIKES, *HIDDEN])) + "！-～]")
# fixed values: digits and signs that stand for letters inside words
DIGITS = str.maketrans("0134578@$!", "oieastbasi")
INSIDE = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|(?<![\w.])[0134578@$](?=[^\W\d_]\w)")
# fixed values: phrases in which a listed word is harmless
EXCEPTIONS = (
    "trash can",
    "trash bin",
    "trash collection",
    "clown fish",
    "circus clown",
    "pond scum",
    "not stupid",
    "no idiot",
    "not an idiot",
    "not a loser",
    "not worthless",
    "not pathetic",
)
LETTER = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if ODD.search(text):
            text = text.translate(FOLD).lower()
    text = INSIDE.sub(lambda m: m[0].translate(DIGITS), text)
    return " ".join(text.split())


def candidates(text: str) -> set[str]:
    """Words (marked by a space) and word beginnings that could be entries."""
    words = set(LETTER.findall(folded(text)))
    return {w + " " for w in words if len(w) > 2} | {w[:n] for w in words for n in BEGINNINGS if len(w) >= n}


class Lexicon:
    """Entries with weights; a trailing space marks a whole word."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.empty = not weights
        self.machine = ahocorasick.Automaton()
        for name in {e.strip() for e in weights} | set(exceptions):
            value = len(name), weights.get(name + " ", 0.0), weights.get(name, 0.0), name in exceptions
            self.machine.add_word(name, value)
        self.machine.make_automaton()

    def measures(self, text: str) -> tuple[float, float, float]:
        """Weight per word, the heaviest hit, and the whole weight on a log scale."""
        text = folded(text)
        if self.empty or not text:
            return 0.0, 0.0, 0.0
        hits: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        last = len(text) - 1
        for end, (n, word, stem, exception) in self.machine.iter(text):
            begin = end - n + 1
            if begin and text[begin - 1].isalpha():
                continue
            ends = end == last or not text[end + 1].isalpha()
            if exception and ends:
                spared.append((begin, end))
            weight = max(stem, word if ends else 0.0)
            if weight > hits.get(begin, 0.0):
                hits[begin] = weight
        kept = [w for at, w in hits.items() if not any(a <= at <= b for a, b in spared)] if spared else list(hits.values())
        if not kept:
            return 0.0, 0.0, 0.0
        total = sum(kept)
        return 10 * total / (10 + text.count(" ")), max(kept), float(np.log1p(total))


def weights_of(docs: DataFrame, sample: DataFrame) -> dict[str, float]:
    """Log odds of the entries that tell toxic texts apart; entries are counted by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = sorted(candidates(text))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], ["entry", "y"])

    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        return {}
    seen = texts_of(docs, sample).mapInArrow(run, "entry string, y int")
    counts = seen.groupBy("entry").agg(F.sum("y").alias("ones"), F.sum(1 - F.col("y")).alias("zeros"))
    odds = F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((F.col("zeros") + 0.5) / (zeros + 1))
    error = F.sqrt(1 / (F.col("ones") + 0.5) + 1 / (F.col("zeros") + 0.5))
    sure = (F.col("ones") >= LEAST_TEXTS) & (F.col("odds") >= LEAST_ODDS) & (F.col("odds") > ERRORS * error)
    order = F.desc(F.col("odds") * F.col("ones")), F.desc(F.length("entry")), "entry"
    counts = counts.withColumn("odds", odds).where(sure).orderBy(*order)
    return chosen((r["entry"], r["odds"]) for r in counts.select("entry", "odds").toLocalIterator())


def chosen(ranked: Iterable[tuple[str, float]]) -> dict[str, float]:
    """All entries that say more than those before them; the sample bounds how many there are."""
    weights: dict[str, float] = {}
    longer: dict[str, list[float]] = {}
    for entry, odds in ranked:
        covered = any(weights.get(entry[:n], -1.0) >= odds - 0.5 for n in range(1, len(entry) + 1))
        vague = any(abs(w - odds) < 0.05 for w in longer.get(entry, ()))  # says no more than the longer one
        if not covered and not vague:
            weights[entry] = odds
            for n in range(1, len(entry) + 1):
                longer.setdefault(entry[:n], []).append(odds)
    return weights


def learned(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[dict[str, float], np.ndarray]:
    """The lexicon's weights and the logistic function's coefficients."""
    weights = weights_of(docs, labelled(labels, label, 0, FIT_ROWS, balanced=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights)
        for batch in batches:
            found = np.array([lexicon.measures(t) for t in batch.column(1).to_pylist()], float).reshape(-1, 3)
            arrays = [batch.column(0), batch.column(2), *(pa.array(c) for c in found.T)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "y", "a", "b", "c"])

    sample = labelled(labels, label, 2, CALIBRATION_ROWS, balanced=False)
    rows = texts_of(docs, sample).mapInArrow(run, "doc_id long, y int, a double, b double, c double").toPandas()
    rows = rows.sort_values(list(rows.columns))
    y = rows["y"].to_numpy(float)
    if not len(y):
        return weights, np.array([0, 0, 0, 0.0])
    design = np.column_stack([rows[["a", "b", "c"]].to_numpy(float), np.ones(len(y))])
    coef = np.array([0, 0, 0, np.log((y.sum() + 1) / (len(y) - y.sum() + 1))])
    for _ in range(50):
        p = logistic(design @ coef)
        ridge = np.array([0.1, 0.1, 0.1, 1e-6])
        gradient = design.T @ (p - y) + ridge * coef
        coef = coef - np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge), gradient)
    return weights, coef


def scored(docs: DataFrame, labels: DataFrame, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have no hits and score what the constant says.  A null
    id is in no fold, so it isn't held out.  Repeated rows score alike.  Without
    labelled toxic and clean rows the lexicon is empty and the score constant.
    Other columns are ignored.
    """
    weights, coef = learned(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights)
        for batch in batches:
            found = np.array([(*lexicon.measures(t or ""), 1.0) for t in batch.column(2).to_pylist()]).reshape(-1, 4)
            score = logistic(found @ coef)
            arrays = [*batch.columns[:2], pa.array(score), pa.array((score >= toxic_from).astype("i4"))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(
        F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
