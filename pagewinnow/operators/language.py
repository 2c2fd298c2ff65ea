"""Language of a text by stop-word counts or by learned n-gram ranks, and the language refusals.

A stop-word vocabulary is at most a few dozen words, so counting is an
expression on the row that holds the text: no explode, no join, no shuffle.
Rank profiles are learned from texts of known language; they need no list and
reach texts without stop words.  Their n-grams are weighed by an Arrow function,
because a row for each would be many times the text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pagewinnow.functions.patterns import STOP_WORDS
from pagewinnow.functions.text import count_in, letter_words, listed, quoted

MIN_HITS = 2
#: n-grams of a language that are ranked; the first has the greatest weight, the last a weight of 1
PROFILE_SIZE = 300
MIN_GRAMS = 40
#: the best language leads the next by this many percent ...
MARGIN = 5
#: ... and an n-gram has on average at least this percentage of the greatest weight
FLOOR = 10


def detect_language(
    docs: DataFrame,
    text: str = "text",
    profiles: Mapping[str, Sequence[str]] = STOP_WORDS,
    min_hits: int = MIN_HITS,
) -> DataFrame:
    """Add ``detected``: the language with most stop words, NULL when undecided.

    Ties go to the first language in alphabetical order.
    """
    hits = ", ".join(
        f"struct({count_in('_words', profiles[lang])} AS hits, -{i} AS place, '{lang}' AS lang)"
        for i, lang in enumerate(sorted(profiles))
    )
    # one pass over all words, then short passes over the few that count
    known = listed(sorted({w for words in profiles.values() for w in words}))
    return (
        docs.selectExpr("*", f"filter({letter_words(text)}, w -> w IN ({known})) AS _words")
        .selectExpr(*docs.columns, f"array_max(array({hits})) AS _best")
        .selectExpr(*docs.columns, f"CASE WHEN _best.hits >= {min_hits} THEN _best.lang END AS detected")
    )


def _grams(word: str) -> str:
    """Letters, pairs and triples of a word, whose ends count as a letter ``_``."""
    padded = f"concat('_', {word}, '_')"
    part = lambda n, count: f"transform(sequence(1, {count}), i -> substr({padded}, i, {n}))"
    letters = f"transform(sequence(1, length({word})), i -> substr({word}, i, 1))"
    return f"concat({letters}, {part(2, f'length({word}) + 1')}, {part(3, f'length({word})')})"


def language_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> DataFrame:
    """``lang, gram, rank``: the ``size`` most frequent n-grams of each language's texts.

    Words are counted before they are cut up, so a frequent word is cut once.
    Ties go by the n-gram.  Rows without a language or words teach nothing.
    """
    words = docs.where(f"{lang} IS NOT NULL").selectExpr(f"{lang} AS lang", f"explode({letter_words(text)}) AS word")
    counted = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    grams = counted.selectExpr("lang", f"explode({_grams('word')}) AS gram", "n")
    sums = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = sums.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    return ranked.where(f"rank <= {size}").select("lang", "gram", "rank")


def _gram_sums(weights: Mapping[str, Sequence[int]], n: int):
    """A column function of words in one string: how many n-grams they have, and the ``n`` sums of their weights.

    A word is cut as in ``_grams``, once for all its copies; a task remembers short ones.
    """

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def sums(texts: pd.Series) -> pd.Series:
        remembered: dict[str, tuple[int, ...]] = {}

        def of_word(word: str) -> tuple[int, ...]:
            padded = f"_{word}_"
            grams = (padded[i : i + k] for k in (2, 3) for i in range(len(padded) - k + 1))
            found = [weights[g] for g in chain(word, grams) if g in weights]
            total = (3 * len(word) + 1, *(sum(w[i] for w in found) for i in range(n)))
            if len(word) <= 32:
                if len(remembered) >= 100_000:
                    remembered.clear()
                remembered[word] = total
            return total

        def of_text(words: str | None) -> list[int]:
            out = [0] * (n + 1)
            for word, times in Counter((words or "").split(" ")).items():
                if word:
                    for i, x in enumerate(remembered.get(word) or of_word(word)):
                        out[i] += times * x
            return out

        return texts.map(of_text)

    return sums


def detect_by_profiles(
    docs: DataFrame,
    profiles: DataFrame,
    languages: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    size: int = PROFILE_SIZE,
    min_grams: int = MIN_GRAMS,
    margin: int = MARGIN,
    floor: int = FLOOR,
) -> DataFrame:
    """``key, n_grams, detected``: one row per key, NULL where undecided.

    An n-gram has the weight ``size + 1 - rank`` for each of ``languages`` whose
    profile ranks it.  A text is undecided when it is short, when the two best languages are
    close, or when most of its n-grams belong to no profile.  Rows that share a
    key are read as one text.

    Texts stay where they are: the profiles (``size`` rows a language) go to the
    scanning tasks, for which a job is started, and one row of sums per text
    moves on.  No row is made for a word or an n-gram.
    """
    known = sorted(languages)
    weight = lambda lang: F.expr(f"max({size} + 1 - rank) FILTER (WHERE lang = {quoted(lang)})")
    by_gram = profiles.groupBy("gram").agg(*[F.coalesce(weight(lang), F.lit(0)).alias(f"_w{i}") for i, lang in enumerate(known)])
    sums = _gram_sums({row[0]: tuple(row[1:]) for row in by_gram.where("gram IS NOT NULL").collect()}, len(known))
    # words are letters only, so a blank parts them
    texts = docs.selectExpr(key, f"array_join({letter_words(text)}, ' ') AS _words").select(key, sums("_words").alias("_sums"))
    sums = texts.groupBy(key).agg(
        F.sum(F.expr("_sums[0]")).alias("n_grams"),
        *[F.sum(F.expr(f"_sums[{i + 1}]")).alias(f"_s{i}") for i in range(len(known))],
    )
    scores = ", ".join(f"struct(-_s{i} AS loss, {quoted(lang)} AS lang)" for i, lang in enumerate(known))
    best, following = "-_langs[0].loss", "coalesce(-get(_langs, 1).loss, 0)"
    sure = (
        f"n_grams >= {min_grams} AND {best} * 100 >= {following} * {100 + margin} "
        f"AND {best} * 100 >= n_grams * {size * floor}"
    )
    return sums.selectExpr(key, "n_grams", f"sort_array(array({scores})) AS _langs").selectExpr(
        key, "n_grams", f"CASE WHEN {sure} THEN _langs[0].lang END AS detected"
    )


def mismatch(language: str, target: str | None) -> str:
    """Known and different from the target; never with no target."""
    if target is None:
        return "false"
    return f"coalesce({language} <> {quoted(target.lower())}, false)"


def language_gate(docs: DataFrame, target: str | None, declared: str = "declared") -> DataFrame:
    """Add ``refused`` and ``detail``.

    Two phases: a declared language that differs refuses with no detail, else a
    detected one that differs refuses with the detected code.  Needs
    ``detected``; off when the target is ``None``.
    """
    by_declared, by_detected = mismatch(declared, target), mismatch("detected", target)
    return docs.selectExpr(
        "*",
        f"{by_declared} OR {by_detected} AS refused",
        f"CASE WHEN NOT {by_declared} AND {by_detected} THEN detected END AS detail",
    )
