"""Substring dedup by recompression (operator 2).

A window is ``WINDOW`` consecutive words.  Words covered by a window whose
sequence also starts earlier, in a smaller document or further ahead in the
same one, are removed.

*Rounds.*  Words become 64-bit names.  Each round splits the names into left
and right ones by a bit of a hash and merges every left-right pair into a new
name, made from its two parts alone, so that all executors give equal content
the same name without asking each other.  A run of one name has no left-right
pair: it stays a chain of equal names.  Whether a symbol begins at a word
depends on four words around it after two rounds, so equal texts have the same
symbols but at their ends.

*Reveal.*  Of the symbols that begin inside a window, the one with the least
name over its next ``GRAM`` words is the window's anchor.  Neighbouring windows
with one anchor form a unit; there is about one for six words.  Only units are
exchanged: a unit whose content comes earlier is removed as a whole.

*Verify.*  Where different units share an anchor, copies part ways.  Only the
windows of these units are compared one by one, by a 128-bit name.

Equal rows are settled inside each task first and an anchor with many units in
one task skips the exchange of units, so a passage that a third of all
documents hold gives each task's part a few rows, not one task all of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewinnow.llm.shared import column_bytes, settle, ship, slices, table

ship(__name__)

WINDOW = 20
GRAM = 8
ROUNDS = 2
#: words before and after a symbol's begin on which it depends after the rounds
BEFORE, AFTER = 2, 1
#: units of one anchor in one task beyond which they go to the window check directly
MANY = 16
#: units held in a task before they are settled and handed on
HELD = 1_000_000
SLICE = 4 << 20
LAST = (1 << 63) - 1
ROWS = "anchor long, unit long, doc long, tag long, start int, n int, kind int"
FIELDS = ("anchor", "unit", "doc", "tag", "start", "n", "kind")
UNIT, COPY, CHECK = 0, 1, 2
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Names of word sequences, from one running sum."""

    def __init__(self, names: np.ndarray, base: np.uint64):
        n = len(names)
        powers = np.full(n + 1, base)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        self.inverse = np.full(n + 1, np.uint64(pow(int(base), -1, 1 << 64)))
        self.inverse[0] = 1
        self.inverse = np.multiply.accumulate(self.inverse)
        self.sums = np.append(np.uint64(0), np.add.accumulate(names * powers[:n]))

    def __call__(self, begin: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[begin + length] - self.sums[begin]) * self.inverse[begin] + np.uint64(1) * np.asarray(length, np.uint64))


def named(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words, and the index of each text's first word (one more at the end)."""
    words: list[bytes] = []
    ends = [0]
    for t in texts:
        words += t.split()
        ends.append(len(words))
    if not words:
        return np.zeros(0, np.uint64), np.array(ends)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False), np.array(ends)


def symbol_begins(names: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where a symbol begins after the rounds of pair naming; no pair crosses texts."""
    at = np.arange(len(names))
    first = np.zeros(len(names) + 1, bool)
    first[ends[:-1]] = True
    for r in range(ROUNDS):
        left = (mixed(names, 2 * r + 1) & np.uint64(1)).astype(bool)
        pair = left[:-1] & ~left[1:] & ~first[at[1:]]
        into = np.flatnonzero(pair)
        names = names.copy()
        names[into] = mixed(names[into] * np.uint64(3) + mixed(names[into + 1], 2 * r + 2))
        stay = np.append(True, ~pair)
        names, at = names[stay], at[stay]
    begins = np.zeros(first.size - 1, bool)
    begins[at] = True
    return begins


def units(names: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all windows: anchor name, unit name, text number, first window's start in the text, windows."""
    none = (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    if len(names) < WINDOW:
        return none
    lengths = np.diff(ends)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    start = np.flatnonzero(np.arange(len(names)) + WINDOW <= np.repeat(ends[1:], lengths))
    if not len(start):
        return none
    spans = Spans(names, BASES[0])
    keys = np.full(len(names), np.uint64((1 << 64) - 1))
    p = np.flatnonzero(symbol_begins(names, ends)[: len(names) - GRAM + 1])
    keys[p] = spans(p, GRAM) >> np.uint64(1)
    best, where = keys[start + BEFORE], np.full(len(start), BEFORE)
    for k in range(BEFORE + 1, min(WINDOW - GRAM, WINDOW - 1 - AFTER) + 1):
        other = keys[start + k]
        less = other < best
        best = np.where(less, other, best)
        where[less] = k
    anchor = start + where
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(start)))
    s = start[begin]
    owner = text_of[s]
    return best[begin], spans(s, n + WINDOW - 1), owner, s - ends[owner], n


def windows(names: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """As ``units``, a row for each wanted window."""
    if not len(wanted):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    owner = np.searchsorted(ends, wanted, side="right") - 1
    names_of = [Spans(names, b)(wanted, WINDOW) for b in BASES]
    return names_of[0] >> np.uint64(1), names_of[1], owner, wanted - ends[owner], np.ones(len(wanted), np.int64)


def joined(rows: np.ndarray) -> np.ndarray:
    """Copies that follow each other in a text as one row."""
    rows = rows[np.lexsort((rows["start"], rows["tag"], rows["doc"]))]
    if len(rows) < 2:
        return rows
    reach = rows["start"] + rows["n"]
    new = np.append(
        True,
        (rows["doc"][1:] != rows["doc"][:-1]) | (rows["tag"][1:] != rows["tag"][:-1]) | (rows["start"][1:] > reach[:-1]),
    )
    first = np.flatnonzero(new)
    out = rows[first]
    out["n"] = np.maximum.reduceat(reach, first) - out["start"]
    return out


KIND = np.dtype([("anchor", "<i8"), ("unit", "<i8"), ("doc", "<i8"), ("tag", "<i8"), ("start", "<i4"), ("n", "<i4"), ("kind", "<i4")])


def settled(rows: np.ndarray, split: bool) -> np.ndarray:
    """What a task hands on of its rows: first ones, and marks where it knows already."""
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["unit"], rows["anchor"]))]
    new_anchor = np.append(True, rows["anchor"][1:] != rows["anchor"][:-1])
    new = new_anchor | np.append(True, rows["unit"][1:] != rows["unit"][:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (rows["doc"] != rows["doc"][first]) | (rows["start"] != rows["start"][first])
    copies = rows[later]
    copies["kind"] = COPY
    copies["anchor"] = (mixed(copies["doc"].view(np.uint64)) >> np.uint64(1)).view(np.int64)
    copies["unit"] = 0
    checks = rows[:0]
    stay = ~later
    if split:
        group = np.cumsum(new_anchor) - 1
        sizes = np.bincount(group[new], minlength=group[-1] + 1)
        crowded = sizes[group] > MANY
        number = np.cumsum(new) - 1
        witness = number - number[np.flatnonzero(new_anchor)[group]] < 2
        checks = rows[crowded & ~later]
        checks["kind"] = CHECK
        checks["anchor"] = (mixed(checks["doc"].view(np.uint64)) >> np.uint64(1)).view(np.int64)
        checks["unit"] = 0
        stay &= ~crowded | witness
    return np.concatenate([rows[stay], joined(copies), joined(checks)])


def to_batch(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[f])) for f in FIELDS], list(FIELDS))


def gathered(found: Iterator[np.ndarray], split: bool) -> Iterator[pa.RecordBatch]:
    held, count = [], 0
    for rows in found:
        held.append(rows)
        count += len(rows)
        if count >= HELD:
            yield to_batch(settled(np.concatenate(held), split))
            held, count = [], 0
    if count:
        yield to_batch(settled(np.concatenate(held), split))


def as_rows(found: tuple[np.ndarray, ...], doc: np.ndarray, tag: np.ndarray) -> np.ndarray:
    anchor, unit, owner, start, n = found
    rows = np.zeros(len(anchor), KIND)
    rows["anchor"], rows["unit"] = anchor.view(np.int64), unit.view(np.int64)
    rows["doc"], rows["tag"], rows["start"], rows["n"] = doc[owner], tag[owner], start, n
    return rows


def resolved(rows: DataFrame, split: bool) -> DataFrame:
    """``doc, tag, start, n, kind``: copies of earlier units, and units to be checked window by window.

    Rows arrive sorted, so a task remembers one place, however large a group is.
    """
    rows = rows.repartition("anchor").sortWithinPartitions("anchor", "unit", "doc", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros(0, KIND)  # of the unit that the last batch ended in, the rows at its first place
        open_check = False  # whether they have been handed on to be checked
        for batch in batches:
            rows = np.zeros(batch.num_rows, KIND)
            for i, f in enumerate(FIELDS):
                rows[f] = batch.column(i).to_numpy()
            done = rows[rows["kind"] != UNIT]
            rows = rows[rows["kind"] == UNIT]
            if len(rows):
                whole = np.concatenate([last, rows])
                new_anchor = np.append(True, whole["anchor"][1:] != whole["anchor"][:-1])
                new = new_anchor | np.append(True, whole["unit"][1:] != whole["unit"][:-1])
                begin = np.flatnonzero(new)
                first = begin[np.cumsum(new) - 1]
                later = (whole["doc"] != whole["doc"][first]) | (whole["start"] != whole["start"][first])
                copies = whole[later]
                copies["kind"] = COPY
                out = [done, joined(copies)]
                if split:
                    several = np.zeros(len(begin), bool)  # of each unit, whether its anchor has another
                    anchors = new_anchor[begin]
                    several[1:] = ~anchors[1:]
                    several[:-1] |= ~anchors[1:]
                    several[0] |= bool(len(last)) and open_check
                    flags = several[np.cumsum(new) - 1] & ~later
                    if len(last) and open_check:
                        flags[: len(last)] = False  # have been handed on
                    checks = whole[flags]
                    checks["kind"] = CHECK
                    out.append(checks)
                    open_check = bool(several[-1])
                last = whole[begin[-1] :][~later[begin[-1] :]]
                done = np.concatenate(out)
            yield to_batch(done)

    return rows.mapInArrow(run, ROWS).select("doc", "tag", "start", "n", "kind")


def keyed(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Rows with their place in the order (null ids last) and a tag that tells rows of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("tag"),
        text.alias("text"),
        *(F.col(c).alias(f"carried_{c}") for c in carry),
    )


def packed(rows: DataFrame) -> DataFrame:
    """The text compressed, as it travels."""
    rest = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*rest).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            small = pa.array([squeeze(t) for t in column_bytes(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], small], [*rest, "squeezed"])

    return rows.select(*rest, "text").mapInArrow(run, f"{schema}, squeezed binary")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc, tag, spans``: of rows that repeat something, the starts and numbers of windows that come earlier."""
    rows = keyed(docs, ())

    def find_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[np.ndarray]:
            for whole in batches:
                for batch in slices(whole, "text", SLICE):
                    names, ends = named(column_bytes(batch, "text"))
                    yield as_rows(units(names, ends), batch.column(0).to_numpy(), batch.column(1).to_numpy())

        return gathered(parts(), True)

    marks = settle(resolved(rows.mapInArrow(find_units, ROWS), True))

    def find_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress

        def parts() -> Iterator[np.ndarray]:
            for batch in batches:
                doc, tag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for i, (small, spans) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                    names, ends = named([grow(small)])
                    wanted = np.zeros(len(names), bool)
                    for s in spans:
                        wanted[s["start"] : s["start"] + s["n"]] = True
                    yield as_rows(windows(names, ends, np.flatnonzero(wanted)), doc[i : i + 1], tag[i : i + 1])

        return gathered(parts(), False)

    spans_of = lambda kind: marks.where(F.col("kind") == kind)
    asked = spans_of(CHECK).groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    checked = packed(rows).join(asked, ["doc", "tag"]).select("doc", "tag", "squeezed", "spans").mapInArrow(find_windows, ROWS)
    more = resolved(checked, False)
    every = spans_of(COPY).unionByName(more)
    return every.groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "n")).alias("spans"))


def kept_of(text: bytes, spans: list | None) -> tuple[int, int, bytes, bytes]:
    """Words, removed words, the digest's text, and the text without the removed words."""
    words = text.split()
    if not spans:
        return len(words), 0, b" ".join(words), text
    change = np.zeros(len(words) + 1, np.int64)
    starts = np.array([s["start"] for s in spans])
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + np.array([s["n"] for s in spans]) + WINDOW - 1, len(words)), -1)
    gone = np.cumsum(change[:-1]) > 0
    kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
    out, last = [], 0
    for g, m in zip(gone, WORD.finditer(text), strict=True):
        if not g:
            out.append(text[last if out else m.start() : m.end()])
        last = m.end()
    return len(words), int(gone.sum()), kept, b"".join(out)


def without_repeats(docs: DataFrame, carry: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """A row per row of ``docs(doc_id, text)``: ``doc_id, n_words, n_removed, kept_sha256``.

    ``carry`` names columns that are returned as they are, ``with_text`` adds
    ``kept_text``, which keeps the white space between words that stay.  Words
    are split at ASCII white space.  Null, empty and blank texts have no words
    and the digest of the empty text.  Null ids come after all others; rows of
    one id (null as well) stand at one place of the order, so of them only a
    smaller start is earlier, and identical rows don't remove each other.
    Columns that aren't named are ignored.
    """
    rows = packed(keyed(docs, ("doc_id", *carry)))
    found = rows.join(repeated_spans(docs), ["doc", "tag"], "left")
    passed = ["doc_id", *carry]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in passed) + ", n_words long, n_removed long, kept_sha256 string"
    names = [*passed, "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            done = []
            for small, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, removed, kept, text = kept_of(grow(small), spans)
                done.append((n, removed, hashlib.sha256(kept).hexdigest(), text if with_text else None))
            columns = list(zip(*done, strict=True)) or [()] * 4
            arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())]
            if with_text:
                arrays.append(pa.array(columns[3], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *arrays], names)

    chosen = found.select("squeezed", "spans", *(F.col(f"carried_{c}").alias(c) for c in passed))
    return chosen.mapInArrow(run, schema + ", kept_text string" * with_text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH w AS (SELECT doc_id, REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
listed AS (SELECT doc_id, [ARRAY_TO_STRING(l[i:i + {WINDOW - 1}], ' ') FOR i IN RANGE(1, LEN(l) - {WINDOW - 2})] AS s FROM w),
windows AS (SELECT doc_id, UNNEST(s) AS s, GENERATE_SUBSCRIPTS(s, 1) AS i FROM listed),
later AS (SELECT doc_id, i FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY s ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, UNNEST(RANGE(i, i + {WINDOW})) AS pos FROM later),
words AS (SELECT doc_id, UNNEST(l) AS word, GENERATE_SUBSCRIPTS(l, 1) AS pos FROM w),
kept AS (SELECT doc_id, STRING_AGG(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
counted AS (SELECT doc_id, COUNT(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(LEN(l) AS BIGINT) AS n_words, COALESCE(n, 0) AS n_removed, SHA256(COALESCE(text, '')) AS kept_sha256
FROM w LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)"""
