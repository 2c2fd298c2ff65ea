import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pagewinnow.llm import linear, ngrams, quality_classifier, quality_rules, toxicity
from tests.llm.conftest import EDGES

DATA = "/root/testdata/sf0.1"


def plain_stats(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if counts[r] > 1 for k in range(5)}
    seen, repeated = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), repeated, len(covered)


def failed(s):
    return s[0] < 10 or 100 * s[4] > 20 * s[0]


def area(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = y == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.fixture(scope="module")
def labels(spark):
    rows = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    return {r.doc_id: r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}


def test_rules_of_the_table(spark, labels):
    rows = quality_rules.query(spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows[::7]:
        s = plain_stats(texts[r.doc_id])
        assert s == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert r.base_failed == failed(s) and r.kept == (not r.base_failed and r.score >= 0.5)
    held = [r for r in rows if r.doc_id in labels]
    y = np.array([labels[r.doc_id].quality for r in held])
    assert area(np.array([r.score for r in held]), y) > 0.98
    p = np.array([r.score for r in held])
    assert ((p - y) ** 2).mean() < 0.03  # calibrated
    good = [r for r in held if labels[r.doc_id].quality and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)


def test_rules_on_edges(clashing_docs, no_docs, small, no_labels):
    rows = quality_rules.judged(clashing_docs, small("labels")).collect()
    assert Counter((r.doc_id, *r[1:6], r.base_failed) for r in rows) == Counter(
        (d[0], *plain_stats(d[1]), failed(plain_stats(d[1]))) for d in EDGES
    )
    assert quality_rules.judged(no_docs, small("labels")).count() == 0
    constant = {r.score for r in quality_rules.judged(clashing_docs, no_labels).collect()}
    assert constant == {0.5}


def test_repeated_words_of_runs():
    for text in ("a " * 9, "a b c d e f a b c d e", "a b c d", "", "a b c d e a b c d e a b c d e"):
        assert quality_rules.stats(text)[4] == plain_stats(text)[4]


def test_scores_do_not_depend_on_neighbours_or_pieces(monkeypatch):
    table = np.random.default_rng(1).normal(size=1 << ngrams.BITS).astype(np.float32)
    texts = ["one text", "", "ünï cödé 漢字 " * 50, "a a a b a b\n" * 20, " "]
    together = ngrams.means(texts, table)
    assert np.allclose(together, [ngrams.means([t], table)[0] for t in texts])
    slots, shares = ngrams.features(texts[2])
    assert np.isclose(together[2], float(table[slots] @ shares), rtol=1e-4)
    for piece in (16, 64, 500):
        monkeypatch.setattr(ngrams, "PIECE", piece)
        parts = list(ngrams.pieces(texts[3]))
        assert "".join(p.own for p in parts) == texts[3] and all(p.own[-1] in " \n" for p in parts)
        assert (len(parts) > 3) == (piece < 100)
        assert np.allclose(ngrams.means(texts, table), together, rtol=1e-9)
        at, share = ngrams.features(texts[2])
        assert np.array_equal(at, slots) and np.allclose(share, shares)


@settings(max_examples=200, deadline=None)
@given(st.text(" \n\v\tab漢", max_size=120), st.integers(1, 40))
def test_every_cut_gives_the_same_grams(text, piece):
    table = np.random.default_rng(1).normal(size=1 << ngrams.BITS).astype(np.float32)
    whole = ngrams.means([text, "b a"], table)
    before, ngrams.PIECE = ngrams.PIECE, piece
    try:
        assert "".join(p.own for p in ngrams.pieces(text)) == text
        assert np.allclose(ngrams.means([text, "b a"], table), whole, rtol=1e-9, atol=1e-12)
    finally:
        ngrams.PIECE = before


def plain_mean(text, table):
    """Gram by gram, as the module's docstring says; hashes in plain numbers."""
    full, words = 0xFFFFFFFF, re.findall(r"[^\x20\x09-\x0D]+", text)
    entry = lambda x, salt: float(table[int(ngrams.slot(np.array([x], np.uint32), salt)[0])])

    def named(word):
        total = 0
        for place, c in enumerate(word):
            x = (ord(c) + place * 65599) * 0x9E3779B1 & full
            total += (x ^ x >> 15) * 0x27D4EB2F
        return total & full

    kinds, data, names = [], [*map(ord, text), 0, 0, 0], [named(w) for w in words]
    for n in ngrams.CHARACTERS:
        found = []
        for i in range(len(text)):
            x = 0
            for c in data[i : i + n]:
                x = (x * 0x01000193 + c) & full
            found.append(entry(x, n))
        kinds.append(found)
    kinds.append([entry(w, 11) for w in names])
    kinds.append([entry((w + 7 + (names[i - 1] * 31 if i else 0)) & full, 12) for i, w in enumerate(names)])
    again = lambda i: sum(2**b for b, k in enumerate(ngrams.BACK) if i >= k and names[i] == names[i - k])
    kinds.append([entry(again(i), 13) for i in range(len(names))])
    return sum(w * sum(k) / max(len(k), 1) for w, k in zip(ngrams.WEIGHTS, kinds, strict=True))


def test_means_against_a_plain_scorer():
    table = np.random.default_rng(2).normal(size=1 << ngrams.BITS).astype(np.float32)
    texts = ["", " ", "a", "one two one two\n\vthree  three", "ünï 漢字 \U0001f600 x", *(t for _, t, *_ in EDGES[:2])]
    assert np.allclose(ngrams.means(texts, table), [plain_mean(t, table) for t in texts])


def test_a_sample_is_bounded_in_size(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    docs = spark.createDataFrame([(i, long if i % 2 else "short text") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    whole = linear.sampled(docs, labels, "quality", 0, 100, True)
    some = linear.sampled(docs, labels, "quality", 0, 100, True, most_grams=400_000)
    assert 0 < len(some) < len(whole) and sum(len(s) for _, s, _ in some) <= 400_000
    assert linear.sampled(docs, labels, "quality", 0, 100, True, most_grams=1) == []


def test_classifier(spark, labels):
    rows = quality_classifier.query(spark, DATA).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.doc_id in labels]
    y = np.array([labels[r.doc_id].quality for r in held])
    assert area(np.array([r.score for r in held]), y) > 0.98
    assert (np.array([r.predicted for r in held]) == y).mean() > 0.98


def test_classifier_on_edges(clashing_docs, no_docs, small, no_labels):
    rows = quality_classifier.classified(clashing_docs, small("labels")).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in EDGES)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert quality_classifier.classified(no_docs, small("labels")).count() == 0
    assert {r.score for r in quality_classifier.classified(clashing_docs, no_labels).collect()} == {0.5}


def test_training_separates_two_kinds():
    pick = np.random.default_rng(3)
    text = lambda y: " ".join(pick.choice(["good", "fine", "well"] if y else ["bad", "poor", "well"], 30))
    rows = [(i % 2, *ngrams.features(text(i % 2))) for i in range(80)]
    for fit in (linear.fit_logistic, linear.fit_embeddings):
        model = linear.calibrated(fit(rows[:60]), rows[60:])
        assert model.scores(["good fine " * 9])[0] > 0.55 > 0.45 > model.scores(["bad poor " * 9])[0]


def test_toxicity(spark, labels):
    rows = toxicity.query(spark, DATA).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.doc_id in labels]
    y = np.array([labels[r.doc_id].toxic for r in held])
    assert area(np.array([r.score for r in held]), y) > 0.9
    p = np.array([r.predicted for r in held])
    assert p[y == 0].mean() < 0.01 and p[y == 1].mean() > 0.75


def test_toxicity_on_edges(clashing_docs, no_docs, small, no_labels):
    rows = toxicity.scored(clashing_docs, small("labels")).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in EDGES)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    assert toxicity.scored(no_docs, small("labels")).count() == 0
    assert len({r.score for r in toxicity.scored(clashing_docs, no_labels).collect()}) == 1


def test_folding_and_exceptions():
    assert toxicity.folded("IDІΟТ 1d10t ｍｏｒｏｎ st​upid") == "idiot idiot moron stupid"
    assert toxicity.folded("10.0.0.1 and $$$ 2024 !") == "10.0.0.1 and $$$ 2024 !"
    lexicon = toxicity.Lexicon({"trash ": 4.0, "moron": 3.0})
    hit = lambda t: lexicon.measures(t)[1]
    assert hit("what trash!") == 4 and hit("trashy") == 0 and hit("the trash can") == 0
    assert hit("morons") == 3 and hit("oxymoron") == 0 and hit("tr4sh") == 4 and hit("") == 0
    assert hit("a trash can of trash") == 4
    short, long = "trash " + "word " * 5, "trash " + "word " * 500
    assert lexicon.measures(short)[0] > 10 * lexicon.measures(long)[0]


def test_lexicon_has_rare_words(spark):
    """A word of 10 among 1,000 or more toxic texts is listed however large the sample; chance words aren't."""
    for size in (1000, 2000):
        rows = [(i, f"common filler text{' grobnax' if i < 10 else ''}{' vilest' if i % 2 else ''}{' once' if i == 3 else ''}", 1) for i in range(size)]
        rows += [(size + i, f"common filler text{' plain' if i % 2 else ''}", 0) for i in range(size)]
        df = spark.createDataFrame(rows, "doc_id long, text string, y int")
        weights = toxicity.weights_of(df.select("doc_id", "text"), df.select("doc_id", "y"))
        assert any("grobnax ".startswith(e) for e in weights) and any("vilest ".startswith(e) for e in weights)
        assert not any(e.startswith(("once", "common", "plain")) for e in weights)


def test_lexicon_has_no_greatest_length(spark):
    """Each of 900 words is in six toxic texts; all of them are listed."""
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3)) + "zzq"
    rows = [(i, f"filler {name(i % 900)}", 1) for i in range(5400)] + [(6000 + i, "filler text", 0) for i in range(5400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y int").repartition(8)
    weights = toxicity.weights_of(df.select("doc_id", "text"), df.select("doc_id", "y"))
    lexicon = toxicity.Lexicon(weights)
    assert all(lexicon.measures(f"filler {name(i)}")[1] > 0 for i in range(900)) and len(weights) > 600


def plain_measures(text, weights, exceptions):
    """Every entry looked for at every place."""
    text, hits, spared = toxicity.folded(text), {}, []
    for i in range(len(text)):
        if i and text[i - 1].isalpha():
            continue
        for name in {e.strip() for e in weights} | set(exceptions):
            if not text.startswith(name, i):
                continue
            ends = i + len(name) == len(text) or not text[i + len(name)].isalpha()
            weight = max(weights.get(name, 0.0), weights.get(name + " ", 0.0) if ends else 0.0)
            hits[i] = max(hits.get(i, 0.0), weight)
            if name in exceptions and ends:
                spared.append(range(i, i + len(name)))
    kept = [w for i, w in hits.items() if w and not any(i in r for r in spared)]
    return (10 * sum(kept) / (10 + text.count(" ")), max(kept, default=0.0), float(np.log1p(sum(kept))))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("trash trashy can tr4sh тrash clown circus fish idi0t idiots no not an . ! 10 x".split()), max_size=12), st.sampled_from([" ", "-", ""]))
def test_the_automaton_finds_what_plain_search_finds(words, between):
    weights = {"trash ": 4.0, "idiot": 3.0, "idiots ": 3.5, "clow": 2.5, "can ": 2.0}
    text = between.join(words)
    assert np.allclose(toxicity.Lexicon(weights).measures(text), plain_measures(text, weights, toxicity.EXCEPTIONS))
