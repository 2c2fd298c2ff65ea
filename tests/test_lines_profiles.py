"""Changes inside a field, renamed pages, and languages by learned n-gram ranks."""

import random
from difflib import SequenceMatcher

from hypothesis import given, settings, strategies as st
import pandas as pd
from pyspark.sql import functions as F

from pagewinnow.operators import compare as C
from pagewinnow.operators import language as L
from pagewinnow.plans.extract import process
from tests.conftest import DATA, article

NAMED = "page_id LONG, content_text STRING"


def diff(spark, a: dict, b: dict):
    side = lambda d: spark.createDataFrame(list(d.items()), NAMED)
    return C.changed_lines(full(side(a)), full(side(b)))


def full(rows):
    """Results with empty fields around the given text."""
    empty = {f: F.lit("") for f in C.STREAMS if f != "content_text"}
    scalars = [F.lit(None).cast("string").alias(f) for f in C.SCALAR_FIELDS]
    lists = [F.array().cast("array<string>").alias(f) for f in C.LIST_FIELDS]
    return rows.withColumns(empty).withColumn("metadata", F.struct(*scalars, *lists))


def test_lines_added_removed_moved(spark):
    a = {1: "one\ntwo\nthree\nfour", 2: "same", 3: "x\nx\ny", 4: "", 5: "gone\npage", 6: None}
    b = {1: "zero\none\nthree\nfour\ntwo", 2: "same", 3: "x\ny\nx\nx", 4: "new\n\nlines", 6: "born", 7: "come"}
    found = sorted((r.page_id, r.change, r.line_a or 0, r.line_b or 0, r.line) for r in diff(spark, a, b).collect())
    assert found == [
        (1, "added", 0, 1, "zero"),
        (1, "moved", 2, 5, "two"),
        (3, "added", 0, 4, "x"),
        (3, "moved", 2, 3, "x"),
        (4, "added", 0, 1, "new"),
        (4, "added", 0, 2, ""),
        (4, "added", 0, 3, "lines"),
        (6, "added", 0, 1, "born"),
    ]


def test_only_changed_pages_give_their_lines(spark):
    rows = diff(spark, {1: "a\nb"}, {1: "a\nb"})
    assert rows.count() == 0
    assert diff(spark, {1: "a"}, {2: "a"}).count() == 0


def test_changed_fields_of_real_results(pages_of):
    a = process(pages_of(article("<p>First of two.</p><p>Second of two.</p>")))
    b = process(pages_of(article("<p>Second of two.</p><p>First of two.</p><p>Third.</p>")))
    found = {(r.field, r.change, r.line) for r in C.changed_lines(a, b, ["content_text", "title"]).collect()}
    assert ("content_text", "added", "Third.") in found and len(found) == 2
    assert {c for _, c, _ in found} == {"added", "moved"}


@settings(max_examples=300, deadline=None)
@given(st.permutations(range(9)))
def test_longest_order_is_a_longest_one(places):
    kept = C._in_order.func(pd.Series([places]))[0]
    run = [p for p, k in zip(places, kept) if k]
    assert run == sorted(run)
    best = [1] * len(places)
    for i in range(len(places)):
        best[i] = 1 + max((best[j] for j in range(i) if places[j] < places[i]), default=0)
    assert len(run) == max(best)


def test_a_long_page_of_shuffled_lines(spark):
    lines = [f"line {i}" for i in range(20_000)]
    other = lines[:]
    random.Random(7).shuffle(other)
    rows = diff(spark, {1: "\n".join(lines)}, {1: "\n".join(other)})
    moved = rows.groupBy("change").count().collect()
    assert [r.change for r in moved] == ["moved"] and 19_600 < moved[0]["count"] < 20_000
    # a copy of one block at the end costs just that block
    rows = diff(spark, {1: "\n".join(lines)}, {1: "\n".join(lines[100:] + lines[:100])}).collect()
    assert len(rows) == 100 and SequenceMatcher(None, [r.line for r in rows], lines[:100]).ratio() == 1


def test_lines_cross_one_exchange(spark):
    plan = diff(spark, {1: "a\nb"}, {1: "b\na"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1


def test_renamed_pages(spark):
    side = lambda rows: spark.createDataFrame(rows, NAMED)
    a = side([(1, "kept"), (2, "moved"), (3, "twin"), (4, "twin"), (5, ""), (6, None), (7, "lost")])
    b = side([(1, "kept"), (12, "moved"), (13, "twin"), (15, ""), (16, None), (17, "found"), (18, "kept")])
    found = sorted((r.page_a, r.page_b, r.pages_a, r.pages_b) for r in C.renamed_pages(a, b).collect())
    assert found == [(2, 12, 1, 1), (3, 13, 2, 1)]


def test_profiles_rank_grams(spark):
    rows = spark.createDataFrame([("aa", "ab ab"), ("aa", "b"), (None, "zz"), ("bb", None), ("cc", "12 !")], "lang STRING, text STRING")
    found = {(r.lang, r.gram): r.rank for r in L.language_profiles(rows).collect()}
    assert {lang for lang, _ in found} == {"aa"}
    # b three times; b at an end three times; then those found twice, in order
    assert found["aa", "b"] < found["aa", "_a"] and found["aa", "b_"] < found["aa", "_a"] < found["aa", "a"]
    assert L.language_profiles(rows, size=2).count() == 2


def test_undecided_texts(spark):
    text = "the same letters over and over again until there are enough of them"
    learned = spark.createDataFrame([("aa", text), ("bb", text), ("cc", "zyx wvu tsr qpo nml " * 4)], "lang STRING, text STRING")
    profiles = L.language_profiles(learned)
    docs = spark.createDataFrame(
        [(1, text), (2, "zyx wvu tsr qpo nml kkk zyx wvu tsr"), (3, "zyx"), (4, ""), (5, None), (6, "漢字" * 60), (None, text)],
        "doc_id LONG, text STRING",
    )
    rows = {r.doc_id: r for r in L.detect_by_profiles(docs, profiles, ["aa", "bb", "cc"]).collect()}
    assert {i: r.detected for i, r in rows.items()} == {1: None, 2: "cc", 3: None, 4: None, 5: None, 6: None, None: None}
    assert rows[4].n_grams == rows[5].n_grams == 0 and rows[3].n_grams == 10
    # without a margin, the first of the alphabet
    tied = L.detect_by_profiles(docs.where("doc_id = 1"), profiles, ["bb", "aa"], margin=0).first()
    assert tied.detected == "aa"


def test_profiles_find_what_stop_words_miss(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    profiles = L.language_profiles(docs.where("doc_id % 2 = 0"))
    other = docs.where("doc_id % 2 = 1")
    found = L.detect_by_profiles(other, profiles, ["de", "en", "es", "fr"]).join(other.select("doc_id", "lang"), "doc_id")
    right, decided, n = found.selectExpr("count_if(lang = detected)", "count_if(detected IS NOT NULL)", "count(*)").first()
    assert right >= 0.95 * n and right >= 0.99 * decided
