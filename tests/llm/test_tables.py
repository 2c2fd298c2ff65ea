"""Operators with SQL twins: the twins on given tables, edge cases by brute force."""

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagewinnow.llm import catalog, knn, links, mixing, substrings, warc
from tests.llm.conftest import EDGES

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in "documents embeddings pages".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def twin(engine, df, sql):
    cursor = engine.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(tuple(str(r[names.index(c)]) for c in df.columns) for r in cursor.fetchall())
    assert Counter(tuple(map(str, r)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_twin(spark, engine, name):
    twin(engine, catalog.QUERIES[name](spark, DATA), catalog.ORACLES[name])


def over(spark, engine, name, view, rows, schema, operator):
    """Runs an operator and its twin over made rows."""
    df = spark.createDataFrame(rows, schema)
    own = duckdb.connect()
    own.register("made", df.toArrow())
    own.execute(f"CREATE VIEW {view} AS SELECT * FROM made")
    twin(own, operator(df), catalog.ORACLES[name])


def test_mixing_on_edges(spark, engine, clashing_docs, no_docs, edge_docs):
    rows = Counter(tuple(r) for r in mixing.decided(edge_docs).collect())
    assert Counter(tuple(r) for r in mixing.decided(clashing_docs).collect()) == rows
    assert sum(rows.values()) == len(EDGES)
    assert mixing.decided(no_docs).count() == 0
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    over(spark, engine, "op4_mixing", "documents", EDGES, schema, mixing.decided)


def test_water_filling_prefers_siblings(spark):
    """One source short: its siblings take over; a whole language short: the other language does."""
    leaf = "domain string, language string, source string, n_docs long, supply long"
    t = mixing.Targets(domain_of={}, domains={"a": 1, "b": 1}, languages={"en": 1, "de": 1}, budget_percent=50, max_epochs=1)
    rows = [("a", "en", "s1", 1, 10), ("a", "en", "s2", 1, 1000), ("a", "de", "s3", 1, 1000), ("b", "en", "s4", 1, 2000)]
    found = {r.source: r.budget for r in mixing.budgets(spark.createDataFrame(rows, leaf), t).collect()}
    assert found == {"s1": 10, "s2": 491, "s3": 501, "s4": 1002}
    rows = [("a", "en", "s1", 1, 10), ("a", "en", "s2", 1, 10), ("a", "de", "s3", 1, 2000), ("b", "en", "s4", 1, 1980)]
    found = {r.source: r.budget for r in mixing.budgets(spark.createDataFrame(rows, leaf), t).collect()}
    assert found == {"s1": 10, "s2": 10, "s3": 980, "s4": 1000}
    rows = [("a", "en", "s1", 1, 100), ("b", "en", "s4", 1, 3900)]
    found = {r.source: r.budget for r in mixing.budgets(spark.createDataFrame(rows, leaf), t).collect()}
    assert found == {"s1": 100, "s4": 1900}


def test_buckets_do_not_change_the_mix(spark, small, monkeypatch):
    docs = small("documents")
    want = Counter(tuple(r) for r in mixing.decided(docs).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    assert Counter(tuple(r) for r in mixing.decided(docs).collect()) == want
    copies = sum(r[-1] * n for r, n in want.items())
    assert mixing.mixed(docs).count() == copies and mixing.mixed(docs).columns == docs.columns


PAGES = [
    (1, "http://A.org/x", "same"),
    (2, "http://b.org", "same"),
    (3, None, None),
    (4, "no scheme", ""),
    (5, "http://sub.example.org/en/12?q#f", "x\r\n\r\ny\r\r\n\r\n\r\n"),
    (6, "http://example.org/es/\r\nX: y", "ends\r\n"),
    (7, "http://shop.com?/de/", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (8, "http://shop.com/de/", "漢字 é \U0001f600" * 40),
    (8, "http://shop.com/de/", "漢字 é \U0001f600" * 40),
    (-9, "http://shop.com/fr/#", "\ufeff mark"),
    (None, "a://b.com/en/", "same"),
    (None, "a://b.com/en/", "alone"),
]
PAGE = "page_id long, url string, html string"


@pytest.mark.parametrize("chunk", [7, 256 * 1024])
def test_archives_round_trip(spark, tmp_path, chunk):
    pages = spark.createDataFrame(PAGES, PAGE).repartition(3)
    warc.write_archives(pages, str(tmp_path / "archive"), chunk=chunk)
    got = Counter(tuple(r) for r in warc.read_archives(spark, str(tmp_path / "archive")).collect())
    want = Counter()
    for i, _, html in PAGES:
        same = [p for p, _, h in PAGES if (h or "") == (html or "")]
        known = [p for p in same if p is not None]
        largest = max(known) if len(same) > 1 and known else None
        data = (html or "").encode()
        first = largest is None or i == largest
        name = warc.base32(hashlib.sha1(data).digest())
        want[(i, len(data), name, "response" if first else "revisit", None if first else largest)] += 1
    assert got == want
    rows = warc.chunk_table(pages, chunk=chunk)
    assert rows.where("chunk_no > 1").count() > 0 or chunk > 1000


def test_archives_of_long_pages_and_none(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u://h/", "é\r\n\r\n" * 300_000, 5)], PAGE + ", kind int")
    got = warc.round_trip(pages, str(tmp_path / "long")).collect()
    assert [tuple(r)[:2] for r in got] == [(1, 1_800_000)]
    assert warc.round_trip(spark.createDataFrame([], PAGE), str(tmp_path / "none")).count() == 0


def test_damaged_archives_are_found(spark, tmp_path):
    parser = warc.Parser()
    _, _, value = next(warc.record_rows(1, "u://h/", "payload", None, True, 100))
    with pytest.raises(ValueError, match="digest"):
        list(parser.feed(value.replace("payload", "payloaf").encode() + warc.END))


def test_links_on_edges(spark, engine):
    over(spark, engine, "op8_url_filters", "pages", PAGES, PAGE, links.judged)
    rows = {r.page_id: r for r in links.judged(spark.createDataFrame(PAGES, PAGE)).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("a.org", "/x", "org/", "allow")
    assert (rows[2].path, rows[2].rule) == ("", None)
    assert (rows[5].rule, rows[5].verdict) == ("example.org/en/1", "block")
    assert (rows[3].host, rows[4].path) == ("", "")
    assert links.judged(spark.createDataFrame([], PAGE)).count() == 0


def test_trust_and_distrust_spread(spark, engine):
    link = lambda *hosts: "".join(f'<a class="x" href="https://{h}/p?q">t</a><a href=/local>l</a>' for h in hosts)
    pages = [
        (1, "http://good.org/", link("liked.net", "LIKED.net")),
        (2, "http://liked.net/", link("second.net")),
        (3, "http://second.net/", ""),
        (4, "http://bad.com/de/", ""),
        (5, "http://farm.net/", link("bad.com")),
        (6, "http://feeder.net/", link("farm.net")),
        (7, "http://both.net/", link("bad.com", "liked.net")),
        (8, "http://alone.net/", None),
    ]
    rows = {r.page_id: r.verdict for r in links.judged(spark.createDataFrame(pages, PAGE)).collect()}
    assert [rows[i] for i in range(1, 9)] == ["allow", "allow", "allow", "block", "block", "block", "block", "allow"]
    over(spark, engine, "op8_url_filters", "pages", pages, PAGE, links.judged)


def linking(*hosts):
    return "".join(f'<a href="https://{h}/p">t</a>' for h in hosts)


def test_distrust_reaches_the_end_of_a_chain(spark, engine):
    chain = [(i, f"http://h{i}.net/", linking(f"h{i - 1}.net" if i > 1 else "bad.com")) for i in range(1, 15)]
    pages = [(0, "http://bad.com/de/", ""), (99, "http://aside.net/", ""), *chain]
    rows = {r.page_id: r.verdict for r in links.judged(spark.createDataFrame(pages, PAGE)).collect()}
    assert {i for i, v in rows.items() if v == "allow"} == {99}
    over(spark, engine, "op8_url_filters", "pages", pages, PAGE, links.judged)


def test_verdicts_do_not_depend_on_the_size_of_the_table(spark):
    near = [
        (1, "http://bad.com/de/", ""),
        (2, "http://a.net/", linking("bad.com", *(f"x{k}.net" for k in range(30)))),
        (3, "http://b.net/", linking("a.net", "liked.net")),
        (4, "http://c.org/", linking("liked.net")),
        (5, "http://liked.net/", linking("bad.com")),
    ]
    many = near + [(100 + k, f"http://far{k % 700}.org/", linking(f"else{k % 90}.org")) for k in range(5000)]
    alone, among = ({r.page_id: r.verdict for r in links.judged(spark.createDataFrame(p, PAGE)).collect()} for p in (near, many))
    assert {i: among[i] for i in alone} == alone and set(alone.values()) == {"allow", "block"}


def test_links_are_read_past_quoted_brackets(spark, engine):
    odd = [
        '<a title="x > y" href="https://bad.com/p">t</a>',
        "<A\nclass='a>b' data-href=\"//no.net/\" HREF = '//BAD.com?q'>t</A>",
        "<a href=//bad.com>t</a>",
        '<a title="see href=//bad.com/ there" href="/local">t</a><abbr href="//bad.com/">t</abbr>',
        f"<a {' '.join(f'a{i}=b' for i in range(3000))} href='http://bad.com:80/x'>t</a>",
        "<p>" + "word " * 200_000 + "</p>" + linking("bad.com"),
        "<a href=''>t</a><a href>t</a><a>t</a>" + linking(""),
    ]
    pages = [(0, "http://bad.com/de/", "")] + [(i, f"http://h{i}.net/", html) for i, html in enumerate(odd, 1)]
    frame = spark.createDataFrame(pages, PAGE)
    found = {(r.src, r.dst): r.n for r in links.host_edges(frame).collect()}
    assert found == {("h1.net", "bad.com"): 1, ("h2.net", "bad.com"): 1, ("h3.net", "bad.com"): 1, ("h5.net", "bad.com:80"): 1, ("h6.net", "bad.com"): 1}
    over(spark, engine, "op8_url_filters", "pages", pages, PAGE, links.judged)


def test_links_beside_clashing_names(spark):
    names = "host path rule verdict by_rule blocked trust distrust score amount src dst n total tag t".split()
    frame = spark.createDataFrame(PAGES, PAGE)
    plain, beside = frame, frame.select("*", *(F.lit(7).alias(c) for c in names))
    rows = lambda df: sorted(map(str, links.judged(df).collect()))
    assert rows(plain) == rows(beside)


def test_a_circle_of_hosts_ends(spark, engine):
    pages = [(1, "http://a.org/", linking("b.net")), (2, "http://b.net/", linking("a.org", "bad.com")), (3, "http://bad.com/de/", linking("a.org"))]
    over(spark, engine, "op8_url_filters", "pages", pages, PAGE, links.judged)


def plain_top(rows, k):
    good = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for q, v in {(i, tuple(v)) for i, v in good if i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))
        for rank, (s, i) in enumerate(scored[:k], 1):
            out[(q, rank, i, -s)] += 1
    return out


def test_top_k_on_edges(spark, monkeypatch):
    pick = random.Random(8)
    vector = lambda n=6: [round(pick.uniform(-1, 1), 3) for _ in range(n)]
    hot = vector()
    rows = [(i, hot if i % 3 == 0 else vector()) for i in range(700)]
    rows += [(None, vector()), (701, None), (702, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (800, [float("nan")] * 6), (703, [float("inf")] * 6)]
    rows += [(900, vector(3)), (901, vector(3)), (1000, []), (1001, []), (5, vector()), (100, rows[100][1])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cell int, score int")
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    want = plain_top(exact, 10)
    assert Counter(tuple(r) for r in knn.top_k(df).collect()) == want
    monkeypatch.setattr(knn, "BLOCK", 40)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 2)
    assert Counter(tuple(r) for r in knn.top_k(df).collect()) == want
    assert knn.top_k(df.limit(0)).count() == 0


def test_top_k_of_a_repeated_id(spark, monkeypatch):
    """Rows of the query's own id are no candidates and guarantee nothing, whether they are equal or not."""
    monkeypatch.setattr(knn, "PIVOTS", 500)  # so that the copies are a group of radius 0
    pick = random.Random(11)
    own = [8.0, 0.0, 0.0]
    rows = [(100, own)] * 50 + [(200, [7.0, round(pick.uniform(-1, 1), 3), 0.5]) for _ in range(50)]
    rows += [(301 + i, [round(pick.uniform(-3, 3), 3) for _ in range(3)]) for i in range(80)] + [(450, [2.0, 2.0, 2.0])] * 30
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    want = plain_top(exact, 10)
    assert Counter(tuple(r) for r in knn.top_k(df).collect()) == want
    # without the other hot id, the copies alone would fill the guaranteed places
    few = [r for r in exact if r[0] != 200]
    got = knn.top_k(df.where("vec_id <> 200"))
    assert Counter(tuple(r) for r in got.collect()) == plain_top(few, 10)
    monkeypatch.setattr(knn, "BLOCK", 8)
    assert Counter(tuple(r) for r in knn.top_k(df).collect()) == want


def test_top_k_of_huge_components(spark):
    """Ranks are by exact scores, also where these don't fit a long or a double."""
    pick = random.Random(12)
    rows = [(i, [pick.uniform(-1, 1) * 2.0 ** pick.choice((3, 45, 60, 120, 600)) for _ in range(3)]) for i in range(0, 1200, 4)]
    want = Counter()
    whole = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows]
    for q, v in whole:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q)
            want.update((q, rank, i, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, i) in enumerate(scored[:10], 1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in knn.top_k(df).collect()) == want


def test_bounds_leave_out_far_groups():
    pick = np.random.default_rng(5)
    centres = np.array([[1000.0, 0], [0, 1000.0], [-1000.0, 0]])
    cells = np.array([[i, 50, 5.0, 1005.0] for i in range(3)])
    wanted = knn.wanted_cells(centres[0], 0, centres, cells, 10)
    assert wanted.tolist() == [True, False, False]
    assert knn.wanted_cells(centres[0], 0, centres, cells, 120).tolist() == [True, True, True]
    big = pick.integers(-(2**40), 2**40, (2, 3)).astype(float)
    assert knn.products(big, big)[0, 1] == max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(*big, strict=True))))


def test_pipeline(spark):
    """Each stage on what the one before kept, against plain versions where there are some."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = "/root/testdata/sf0.001"
    kept = corpus_pipeline.quality(spark, docs, folder)
    assert kept.columns == docs.columns
    kept = spark.createDataFrame(kept.collect(), kept.schema)
    assert 0 < kept.count() < docs.count()
    alone = corpus_pipeline.near_duplicates(spark, kept, folder)
    alone = spark.createDataFrame(alone.collect(), alone.schema)
    assert alone.columns == docs.columns and alone.select("doc_id").distinct().count() == alone.count() <= kept.count()
    clean = corpus_pipeline.repeated_passages(spark, alone, folder)
    clean = spark.createDataFrame(clean.collect(), clean.schema)
    removed = {r.doc_id: r for r in substrings.without_repeats(alone).collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, r in removed.items() if r.n_words > r.n_removed}
    assert all(len(r.text.encode().split()) == removed[r.doc_id].n_words - removed[r.doc_id].n_removed and r.n_chars == len(r.text) for r in clean.collect())
    mix = corpus_pipeline.mix(spark, clean, folder)
    mix = spark.createDataFrame(mix.collect(), mix.schema)
    assert mix.columns == docs.columns and mix.count() <= clean.count()
    pieces = corpus_pipeline.pack(spark, mix, folder).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in mix.collect()}
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    whole = corpus_pipeline.run(spark, folder)
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in whole.collect()) == Counter(
        (r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces
    )


def test_pipeline_on_edges(spark, edge_docs, no_docs, clashing_docs):
    for docs in (edge_docs, clashing_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            docs_of_stage = spark.createDataFrame(out.collect(), out.schema)
            assert docs_of_stage.count() <= max(docs.count(), 1) or "sequence_id" in out.columns
    once = corpus_pipeline.near_duplicates(spark, edge_docs, "")
    assert Counter(r.doc_id for r in once.collect()) == Counter([1, 3, None, 6, -7])


