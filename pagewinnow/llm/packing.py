"""Packing token sequences by non-negative least squares (operator 10).

A document's ids are cut into whole windows and one remainder.  The histogram
of remainders has fewer bins than the window has places, so the plan is made on
the driver whatever the size of the corpus: enumerate combinations of two and
three lengths that fill the window, solve for how often each is used so that
the histogram is met (non-negative least squares), round down, and pack what is
left greedily, cutting pieces only where nothing fits.  A plan is a table of
rank ranges of the length classes; Spark gives every remainder its rank and
looks its place up.

Ranks within a length are counted per bucket of documents and added up over
buckets, so a length that a third of all documents share is no single task.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from pagewinnow.llm.shared import settle, ship, table, worker_value, written

ship(__name__)

WINDOW = 1024
VOCABULARY = "byte_bpe_50k.json"
#: rows of one bucket of the rank count
BUCKET_ROWS = 500
#: remainders travel as 16-bit ids
ID_BYTES = 2


class Words:
    """Ids of texts.

    A faster library encodes with the same vocabulary; only texts that hold the
    string of a special token go to the vocabulary's own, which makes it that token
    and is loaded when such a text comes.
    """

    def __init__(self, path: str):
        self.path, self.whole = path, None
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        letters = dict(zip(map(chr, self._letters()), range(256), strict=True))
        self.special = [x["content"] for x in rules["added_tokens"]]
        ranks = {
            bytes(letters[c] for c in t): i for t, i in rules["model"]["vocab"].items() if t not in set(self.special)
        }
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    @staticmethod
    def _letters() -> list[int]:
        """The code point that stands for each byte in byte-level vocabularies."""
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        return [b if b in plain else next(others) for b in range(256)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for t in texts:
            if any(s in t for s in self.special):
                self.whole = self.whole or Tokenizer.from_file(self.path)
                ids = np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4")
            else:
                ids = self.encoding.encode_to_numpy(t, allowed_special=set(), disallowed_special=()).astype("<u4")
            out.append(ids.tobytes())
        return out


def tokenized(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """``doc_id, doc_tokens, whole_crcs, rest``: checksums of whole windows, and the remainder's ids as bytes."""
    schema = "doc_id long, doc_tokens long, whole_crcs array<long>, rest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_value(f"words {vocabulary}", lambda: Words(vocabulary))
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * WINDOW
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                counts, crcs, rests = [], [], []
                for data in words.ids([t or "" for t in batch.column(1).to_pylist()]):
                    data += end
                    full = len(data) // step * step
                    counts.append(len(data) // 4)
                    crcs.append([zlib.crc32(data[k : k + step]) for k in range(0, full, step)])
                    rests.append(np.frombuffer(data[full:], "<u4").astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(crcs, pa.list_(pa.int64())),
                        pa.array(rests, pa.binary()),
                    ],
                    ["doc_id", "doc_tokens", "whole_crcs", "rest"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def combinations_of(lengths: np.ndarray, window: int, triples: int) -> np.ndarray:
    """Two and three lengths that fill the window, as rows of three (0: no third)."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    a = np.array([x for x in lengths if 2 * x <= window and there[window - x]], np.int64)
    pairs = np.column_stack([a, window - a, np.zeros(len(a), np.int64)])
    x, y = np.meshgrid(lengths, lengths, indexing="ij")
    z = window - x - y
    ok = (x <= y) & (y <= z) & there[np.clip(z, 0, window)]
    found = np.column_stack([x[ok], y[ok], z[ok]])
    if len(found) > triples:  # evenly over the enumeration
        found = found[np.linspace(0, len(found) - 1, triples).astype(int)]
    return np.concatenate([pairs, found]).astype(np.int64)


def least_squares(combos: np.ndarray, counts: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Non-negative least squares by exact coordinate steps: how often each combination is used."""
    residual = counts.astype(float)
    used = np.zeros(len(combos))
    members = [np.unique(c[c > 0], return_counts=True) for c in combos]
    for _ in range(sweeps):
        moved = 0.0
        for j, (rows, times) in enumerate(members):
            step = max(-used[j], float(residual[rows] @ times) / float(times @ times))
            if step:
                used[j] += step
                residual[rows] -= step * times
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return used


@dataclass
class Plan:
    """Where remainders go, by length class and rank.

    ``rows``: class, first rank, pieces, first sequence, offset; the pieces of a
    row go whole to consecutive sequences.  ``stream``: class, first rank,
    pieces, begin; the pieces of these rows follow each other in one stream that
    is cut at every window, its end at powers of two.
    """

    rows: np.ndarray
    stream: np.ndarray
    first: int  # the stream's first sequence
    total: int  # the stream's tokens
    window: int

    def ends(self) -> np.ndarray:
        """Ends of the stream's last sequences, after its whole windows."""
        at, ends = self.total // self.window * self.window, []
        while at < self.total:
            at += 1 << ((self.total - at).bit_length() - 1)
            ends.append(at)
        return np.array(ends, np.int64)

    def sequences(self) -> int:
        return self.first + self.total // self.window + len(self.ends())


def plan(counts: np.ndarray, window: int = WINDOW, triples: int = 1500) -> Plan:
    """A place for every remainder; ``counts[n]`` of them have length n.

    Least squares first, rounded down.  Then greedily, for what is left: the
    longest length with the longest ones that still fit, as often as the counts
    allow, if that fills the window.  What fills no window is streamed and cut.
    The number of rows depends on the window and not on the counts, since each
    greedy step uses up or sets aside one length.
    """
    left, used = counts.astype(np.int64), np.zeros(window, np.int64)
    rows, sequence = [], 0

    def use(parts: list[int], many: int) -> None:
        nonlocal sequence
        offset = 0
        for n in parts:
            rows.append((n, used[n], many, sequence, offset))
            used[n] += many
            left[n] -= many
            offset += n
        sequence += many

    def times(parts: list[int]) -> int:
        return min(int(left[n]) // parts.count(n) for n in parts)

    combos = combinations_of(np.flatnonzero(left), window, triples)
    for combo, wanted in zip(combos, least_squares(combos, left), strict=True):
        parts = [int(n) for n in combo if n]
        many = min(int(wanted), times(parts))
        if many > 0:
            use(parts, many)
    aside = np.zeros(window, bool)
    while (open_lengths := np.flatnonzero((left > 0) & ~aside)).size:
        parts, room = [int(open_lengths[-1])], window - int(open_lengths[-1])
        rest = np.where(aside, 0, left)
        rest[parts[0]] -= 1
        while room and (fits := np.flatnonzero(rest[: room + 1])).size:
            parts.append(int(fits[-1]))
            rest[parts[-1]] -= 1
            room -= parts[-1]
        if room:
            aside[parts[0]] = True
        else:
            use(parts, times(parts))
    stream, total = [], 0
    for n in np.flatnonzero(left):
        stream.append((n, used[n], left[n], total))
        total += int(n * left[n])
    shaped = lambda x, width: np.array(x, np.int64).reshape(-1, width)
    return Plan(shaped(rows, 5), shaped(stream, 4), sequence, total, window)


class Places:
    """A plan, looked up by length class and rank."""

    def __init__(self, plan: Plan):
        self.plan, self.ends = plan, plan.ends()
        own = {int(n): plan.rows[plan.rows[:, 0] == n] for n in np.unique(plan.rows[:, 0])}
        self.lows = {n: r[:, 1].tolist() for n, r in own.items()}  # ranks were given out in order
        self.rows = {n: r.tolist() for n, r in own.items()}
        self.streamed = {n: (low, begin) for n, low, _, begin in plan.stream.tolist()}

    def __call__(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """begin, length, sequence, offset of each piece of a remainder"""
        low, begin = self.streamed.get(length, (rank + 1, 0))
        if rank < low:
            _, low, _, sequence, offset = self.rows[length][bisect_right(self.lows[length], rank) - 1]
            yield 0, length, sequence + rank - low, offset
            return
        window, whole = self.plan.window, self.plan.total // self.plan.window
        at = start = begin + (rank - low) * length
        while at < start + length:
            number = at // window
            if number < whole:
                first, end = number * window, (number + 1) * window
            else:
                k = int(np.searchsorted(self.ends, at, side="right"))
                first, end = int(self.ends[k - 1]) if k else whole * window, int(self.ends[k])
                number = whole + k
            n = min(end, start + length) - at
            yield at - start, n, self.plan.first + number, at - first
            at += n


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every document.

    Every row of ``docs(doc_id, text)`` is a document of its own, repeated rows
    as well; a null text is empty and gives the end id alone; a null ``doc_id``
    stays null.  Other columns are ignored.  An empty table gives no pieces.
    Only the last few sequences may be shorter than the window, each a power of two.
    Very long texts are tokenized whole.  A vocabulary with ids beyond 16 bits is refused.
    """
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    if max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1) > 1 << 8 * ID_BYTES:
        raise ValueError(f"{vocabulary}: ids beyond {8 * ID_BYTES} bits")
    tokens = written(tokenized(docs, vocabulary, end_id), "tokens")
    rows = tokens.withColumn("tail", (F.octet_length("rest") / ID_BYTES).cast("int"))
    totals = np.zeros(WINDOW, np.int64)
    for tail, n in rows.groupBy("tail").count().collect():  # as many rows as the window has places, at most
        totals[tail] = n
    buckets = F.array(*(F.lit(int(-(-n // BUCKET_ROWS)) or 1) for n in totals))
    rows = rows.withColumn("order", F.xxhash64("doc_id", "doc_tokens", "rest"))
    rows = rows.withColumn("bucket", F.pmod(F.col("order"), buckets[F.col("tail")]))
    cells = settle(rows.groupBy("tail", "bucket").agg(F.count("*").alias("n")))
    before = Window.partitionBy("tail").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("tail", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("tail", "bucket").orderBy("order", "doc_id")
    ranked = rows.join(cells, ["tail", "bucket"]).select(
        "doc_id", "doc_tokens", "whole_crcs", "rest", "tail", (F.col("before") + F.row_number().over(inside) - 1).alias("rank")
    )
    remainders = totals.copy()
    remainders[0] = 0
    planned = plan(remainders)
    first_whole = planned.sequences()
    class_begin = np.cumsum(totals) - totals
    n_docs = int(totals.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(planned)
        for batch in batches:
            out = []
            for doc, n, crcs, rest, tail, rank in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                number = first_whole + int(class_begin[tail]) + rank
                for k, crc in enumerate(crcs):
                    out.append((doc, k * WINDOW, WINDOW, crc, n, number + k * n_docs, 0))
                if tail:
                    ids = np.frombuffer(rest, "<u2").astype("<u4").tobytes()
                    for begin, length, sequence, offset in places(tail, rank):
                        crc = zlib.crc32(ids[4 * begin : 4 * (begin + length)])
                        out.append((doc, n - tail + begin, length, crc, n, sequence, offset))
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)

    return ranked.mapInArrow(run, PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
