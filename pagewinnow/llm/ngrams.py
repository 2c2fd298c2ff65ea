"""Hashed word and character n-grams of many texts at once, in numpy.

Kinds of grams: one to four code points; one and two words; and the repeat
pattern of a word, that is whether it equals the word one, two, four or eight
before it.  Words are split at ASCII white space.  All kinds share one table of
``2 ** BITS`` slots.  A text's features are the shares of each slot within each
kind, so texts of all lengths are on one scale and a linear score is a mean of
table entries over the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from pagewinnow.llm.shared import held_out, ship, written

ship(__name__)

BITS = 17
CHARACTERS = (1, 2, 3, 4)
KINDS = len(CHARACTERS) + 3
BACK = (1, 2, 4, 8)
#: weight of each kind; the few repeat patterns count more than single grams of a varied text
WEIGHTS = np.array([1.0] * (KINDS - 1) + [20.0])
#: code points worked on at once; a single word is never cut
PIECE = 1 << 18
WORD, BLANK = re.compile(r"[^\t-\r ]+"), re.compile(r"[\t-\r ]")
SPACE = np.zeros(34, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def slot(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint32(salt * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    return (x * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)


class Part(NamedTuple):
    """A piece of a text between white space, with what its first and last grams reach beyond it."""

    lead: str
    own: str
    tail: str


def points(parts: list[Part]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all parts, each followed by zeros, and where each part begins (one more at the end)."""
    pad = max(CHARACTERS)
    data = ("\0" * pad).join([*(p.lead + p.own + p.tail for p in parts), ""]).encode("utf-32-le")
    begins = np.cumsum([0, *(sum(map(len, p)) + pad for p in parts)])
    return np.frombuffer(data, "<u4"), begins


def grams(parts: list[Part]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind: the slots of all grams that begin in the parts' own text, and how many each part has."""
    cp, begins = points(parts)
    lengths = np.array([len(p.own) for p in parts])
    inside, known = np.zeros(len(cp), bool), np.zeros(len(cp), bool)
    for b, p in zip(begins[:-1], parts, strict=True):
        inside[b + len(p.lead) : b + len(p.lead) + len(p.own)] = True
        known[b : b + len(p.lead) + len(p.own)] = True
    whole = cp.copy()
    for n in CHARACTERS:
        if n > 1:
            whole = whole * np.uint32(0x01000193)
            whole[: len(cp) - n + 1] += cp[n - 1 :]
        yield slot(whole, n)[inside], lengths
    letter = known & ~SPACE[np.minimum(cp, 33)]
    begin = letter.copy()
    begin[1:] &= ~letter[:-1]
    first = np.flatnonzero(begin)
    number = np.cumsum(begin)
    at = np.flatnonzero(letter)
    owner = np.searchsorted(begins, first, side="right") - 1
    own = inside[first]
    counts = np.bincount(owner[own], minlength=len(parts))
    if len(first):
        place = (at - first[number[at] - 1]).astype(np.uint32)
        mixed = (cp[at] + place * np.uint32(65599)) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        word = np.add.reduceat(mixed * np.uint32(0x27D4EB2F), np.flatnonzero(begin[at]), dtype=np.uint32)
    else:
        word = np.zeros(0, np.uint32)
    yield slot(word, 11)[own], counts
    same = lambda k: np.append(np.zeros(min(k, len(owner)), bool), owner[k:] == owner[:-k])
    two = word + np.uint32(7)
    two[1:] += np.where(same(1)[1:], word[:-1] * np.uint32(31), np.uint32(0))
    yield slot(two, 12)[own], counts
    pattern = np.zeros(len(word), np.uint32)
    for i, k in enumerate(BACK):
        again = same(k)
        again[k:] &= word[k:] == word[:-k]
        pattern |= again.astype(np.uint32) << np.uint32(i)
    yield slot(pattern, 13)[own], counts


def cuts(text: str) -> Iterator[int]:
    """Ends of a text's pieces, each behind white space or at the end."""
    at = 0
    while len(text) - at > PIECE:
        behind = max(text.rfind(blank, at + PIECE // 2, at + PIECE) for blank in "\t\n\v\f\r ") + 1
        if not behind:  # a long word: up to its end
            found = BLANK.search(text, at + PIECE)
            behind = found.end() if found else len(text)
        yield (at := behind)
    if at < len(text) or not text:
        yield len(text)


def pieces(text: str) -> Iterator[Part]:
    """A text in parts; a later one has the eight words before it, all but the last the three code points behind it."""
    if len(text) <= PIECE:
        yield Part("", text, "")
        return
    before, words = 0, []
    for end in cuts(text):
        own = text[before:end]
        yield Part("".join(w + " " for w in words), own, text[end : end + max(CHARACTERS) - 1])
        words = [*words, *WORD.findall(own)][-max(BACK) :]
        before = end


def grouped(texts: list[str]) -> Iterator[tuple[list[Part], np.ndarray]]:
    """Parts of all texts in groups of about ``PIECE`` code points, with the number of each part's text."""
    parts, owners, total = [], [], 0
    for i, t in enumerate(texts):
        for part in pieces(t):
            if parts and total + len(part.own) > PIECE:
                yield parts, np.array(owners)
                parts, owners, total = [], [], 0
            parts.append(part)
            owners.append(i)
            total += len(part.own)
    if parts:
        yield parts, np.array(owners)


def means(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum over the kinds of the mean table entry of each text's grams; none count as zero."""
    sums = np.zeros((KINDS, len(texts)))
    counts = np.zeros((KINDS, len(texts)))
    for parts, owner in grouped(texts):
        for k, (slots, n) in enumerate(grams(parts)):
            has = np.flatnonzero(n)
            if len(has):
                found = np.add.reduceat(weights[slots], (np.cumsum(n) - n)[has], dtype=np.float64)
                np.add.at(sums[k], owner[has], found)
                np.add.at(counts[k], owner[has], n[has])
    return (WEIGHTS[:, None] * sums / np.maximum(counts, 1)).sum(axis=0)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text and their shares, kinds added up."""
    sums = np.zeros(1 << BITS)
    kinds = [np.zeros(1 << BITS) for _ in range(KINDS)]
    totals = np.zeros(KINDS)
    for parts, _ in grouped([text]):
        for k, (slots, n) in enumerate(grams(parts)):
            kinds[k] += np.bincount(slots, minlength=1 << BITS)
            totals[k] += n.sum()
    for k, total, weight in zip(kinds, totals, WEIGHTS, strict=True):
        sums += weight * k / max(total, 1)
    at = np.flatnonzero(sums)
    return at.astype(np.int32), sums[at].astype(np.float32)


def labelled(labels: DataFrame, label: str, fold: int, most: int, balanced: bool) -> DataFrame:
    """At most ``most`` labelled ids of one learning fold, by the order of a hash: ``doc_id, y``.

    Folds are the remainders of crc32(doc_id as text) divided by 3; 1 is never
    learned from.  An id labelled both ways is left out, so is a null label.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y"))
    known = known.where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % 3 == fold)
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").drop("top")
    take = lambda rows, n: rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    if balanced:
        return take(known.where("y = 0"), most // 2).unionByName(take(known.where("y = 1"), most - most // 2))
    return take(known, most)


def texts_of(docs: DataFrame, sample: DataFrame, most_grams: int | None = None) -> DataFrame:
    """``doc_id, text, y`` of a bounded sample, which is broadcast; of repeated ids the least text.

    With ``most_grams`` the sample is bounded by its size as well.  A text has at
    most six kinds of grams per code point and ``2 ** BITS`` slots.  Texts are
    taken in the order of a hash of their ids; one with which the total would
    pass the bound is left out, with all that follow.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    if most_grams is None:
        return rows.select("doc_id", "text", "y")
    rows = written(rows.select("doc_id", "text", "y"), "sample")  # read twice, for the sizes and for the texts
    most = F.least(F.char_length("text").cast("long") * (KINDS - 1), F.lit(1 << BITS))
    # the sample has few rows, and only their sizes meet here
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    fits = rows.select("doc_id", most.alias("n")).withColumn("sum", F.sum("n").over(order)).where(F.col("sum") <= most_grams)
    # at most as many ids as the sample has rows
    return rows.join(F.broadcast(fits.select("doc_id")), "doc_id", "left_semi").select("doc_id", "text", "y")
