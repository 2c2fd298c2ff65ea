import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pagewinnow.llm import substrings
from tests.llm.conftest import EDGES


def expected(docs):
    """Brute force: the first place of every window, places ordered by id (nulls last) and start."""
    rank = lambda i: (i is None, i or 0)
    words = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        for s in range(len(w) - 19):
            k, place = tuple(w[s : s + 20]), (rank(i), s)
            first[k] = min(first.get(k, place), place)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (rank(i), s):
                gone[s : s + 20] = [True] * 20
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_table(small):
    docs = small("documents")
    assert got(substrings.without_repeats(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def made_docs():
    pick = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    line = lambda n: " ".join(pick.choices(vocabulary, k=n))
    shared, edge = line(60), line(20)
    docs = [(i, f"{line(pick.randrange(40))} {shared}\n{line(pick.randrange(40))}") for i in range(40)]
    docs += [(50 + i, f"{edge} {line(1)}") for i in range(5)]
    docs += [(60, "same " * 57), (61, "same " * 19), (62, "same " * 20 + "end"), (63, "a b " * 40)]
    docs += [(70, line(20)), (71, f"{line(3)} {shared[: len(shared) // 2]}")]
    docs += [(None, shared), (None, shared), (80, shared), (80, shared), (80, f"x {shared}")]
    return docs


@pytest.mark.parametrize("many", [16, 1])
def test_shared_passages_runs_ties_and_nulls(spark, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY", many)
    docs = made_docs()
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, tag int, start int").repartition(5)
    assert got(substrings.without_repeats(df)) == expected(docs)


def test_edges(clashing_docs, no_docs):
    docs = [(r[0], r[1]) for r in EDGES]
    assert got(substrings.without_repeats(clashing_docs)) == expected(docs)
    assert substrings.without_repeats(no_docs).count() == 0


def test_kept_text_keeps_white_space():
    text = b"a b\n\nc  d\te f"
    spans = [{"start": 1, "n": 1}]
    old, substrings.WINDOW = substrings.WINDOW, 2
    try:
        assert substrings.kept_of(text, spans) == (6, 2, b"a d e f", b"a  d\te f")
        assert substrings.kept_of(text, [{"start": 0, "n": 5}]) == (6, 6, b"", b"")
        assert substrings.kept_of(text, None)[3] == text
    finally:
        substrings.WINDOW = old


def test_symbols_depend_on_few_words():
    """Equal stretches have equal symbols but at their ends, whatever stands around."""
    pick = np.random.default_rng(3)
    middle = pick.integers(0, 1 << 63, 40).astype(np.uint64)
    seen = set()
    for _ in range(30):
        a, b = pick.integers(0, 1 << 63, (2, 12)).astype(np.uint64)
        names = np.concatenate([a, middle, b])
        begins = substrings.symbol_begins(names, np.array([0, len(names)]))
        seen.add(begins[12 + substrings.BEFORE : 12 + 40 - substrings.AFTER].tobytes())
        assert np.diff(np.flatnonzero(begins)).max() <= 1 << substrings.ROUNDS
    assert len(seen) == 1
