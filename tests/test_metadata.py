import datetime as dt

import pytest

from pagewinnow.functions.dates import publication_day
from pagewinnow.operators import language as L
from pagewinnow.operators import metadata as M
from pagewinnow.options import ExtractOptions
from pagewinnow.plans.extract import process
from tests.conftest import article, by_page, page, PARAGRAPHS

HEAD = (
    '<link rel="license" href="https://licences.example.net/by"><meta content="2025-11-04" name="dc.date">'
    '<meta property="article:section" content="Coast"><meta name="twitter:image" content="/cover.png">'
    '<meta name="news_keywords" content="tides, harbours"><meta property="og:url" content="https://gazette.example.com/a">'
    '<meta name="application-name" content="The Gazette"><meta name="dc.creator" content="Mary Somerville">'
)


def meta_of(pages, **options):
    return {r.page_id: r.metadata for r in M.metadata_fields(pages, ExtractOptions.of(options)).collect()}


def test_every_field_in_its_own_slot(pages_of):
    meta = meta_of(pages_of(article("", HEAD)))[0].asDict()
    assert meta.pop("date") == dt.date(2025, 11, 4)
    assert (meta.pop("categories"), meta.pop("tags")) == (["Coast"], ["tides", "harbours"])
    assert meta == {
        "title": "A small story",
        "author": "Mary Somerville",
        "url": "https://gazette.example.com/a",
        "hostname": "gazette.example.com",
        "description": None,
        "sitename": "The Gazette",
        "license": "https://licences.example.net/by",
        "language": "en",
        "image": "https://gazette.example.com/cover.png",
        "page_type": None,
    }


def test_empty_is_absent_and_lists_are_never_null(pages_of):
    blank = page("<p>x</p>", '<meta name="author" content="  "><meta name="keywords" content=" , ,">', lang="")
    meta = meta_of(pages_of(blank, "<title></title>", "", None))
    for i in range(4):
        assert meta[i].author is None and meta[i].tags == [] and meta[i].categories == []
    assert meta[1].title is None


def test_source_precedence(pages_of):
    ld = '<script type="application/ld+json">{"@type":"News","headline":"From LD","author":[{"name":"L. D."}],"datePublished":"2020-02-02"}</script>'
    both = page("<h1>From h1</h1>", ld + '<meta property="og:title" content="From og">')
    only_ld = page("<h1>From h1</h1>", ld)
    untitled = "<html><body><h1>From <b>h1</b> &amp; more</h1></body></html>"
    broken = page("<p>x</p>", '<script type="application/ld+json">{"headline": </script>')
    meta = meta_of(pages_of(both, only_ld, untitled, broken))
    assert [meta[i].title for i in range(4)] == ["From og", "From LD", "From h1 & more", "A small story"]
    assert (meta[1].author, meta[1].date, meta[1].page_type) == ("L. D.", dt.date(2020, 2, 2), "News")


def test_several_linked_data_blocks(pages_of):
    block = '<script type="application/ld+json">{}</script>'
    first = block.format('{"@type": "Organization", "name": "Publisher Inc."}')
    second = block.format('[{"@type": "Article", "headline": "Of interest", "author": "A. Writer"}]')
    graph = block.format('{"@graph": [{"@type": "Article", "headline": "In a graph", "publisher": {"name": "P"}}]}')
    meta = meta_of(pages_of(page("", first + second), page("", graph), page("", first), page("", block.format("{"))))
    assert [meta[i].title for i in range(4)] == ["Of interest", "In a graph", "A small story", "A small story"]
    assert meta[0].author == "A. Writer" and meta[1].sitename == "P"


def test_url_from_the_page_wins_over_the_supplied_one(pages_of):
    pages = pages_of(article(), article("", HEAD), article("", '<link rel="canonical" href="/c">'))
    assert meta_of(pages)[0].url is None and meta_of(pages)[0].hostname is None
    given = meta_of(pages, original_url="https://press.example.com/story")
    assert (given[0].url, given[0].hostname) == ("https://press.example.com/story", "press.example.com")
    assert given[1].url == "https://gazette.example.com/a"
    assert given[2].url == "https://press.example.com/c"
    column = meta_of(pages_of(article(), urls={0: "https://col.example.net/x"}))
    assert column[0].hostname == "col.example.net"


@pytest.mark.parametrize(
    "written,day",
    [
        ("2020-01-21T02:00:00+05:30", dt.date(2020, 1, 21)),
        ("2020-01-20T20:30:00-06:00", dt.date(2020, 1, 20)),
        ("2020-01-20T09:49:32Z", dt.date(2020, 1, 20)),
        ("20190405", dt.date(2019, 4, 5)),
        ("2019/04/05 10:00", dt.date(2019, 4, 5)),
        ("1234567é9", None), ("2020-1", None), ("2020-02-30", None), ("1990-01-01", None),
        ("2990-01-01", None), ("", None), ("123456789", None),
    ],
)
def test_publication_day(spark, written, day):
    df = spark.createDataFrame([(written,)], "v STRING")
    assert df.selectExpr(f"{publication_day('v')} AS d").first().d == day


def test_junk_date_is_passed_over_and_the_body_stays(pages_of):
    head = '<meta property="article:published_time" content="1234567é9"><meta name="date" content="2021-01-02">'
    row = process(pages_of(article("", head), article("", head[:70]))).collect()
    assert {r.metadata.date for r in row} == {dt.date(2021, 1, 2), None}
    assert all("Opening" in r.content_text for r in row)


def test_date_override_and_authors(pages_of):
    two = '<meta name="author" content="Mary Somerville; Emmy Noether">'
    pages = pages_of(article("", HEAD), article("", two))
    assert meta_of(pages, html_date_override=dt.date(2001, 2, 3))[0].date == dt.date(2001, 2, 3)
    without = meta_of(pages, excluded_authors=["mary SOMERVILLE"])
    assert without[0].author is None and without[1].author == "Emmy Noether"


def test_essential_metadata_order(pages_of):
    url = '<meta property="og:url" content="https://e.org/a">'
    date = '<meta name="date" content="2020-01-01">'
    bare = f"<html><body><article>{PARAGRAPHS}</article></body></html>"
    rows = by_page(process(pages_of(bare, article(), article("", url), article("", url + date)), has_essential_metadata=True))
    assert [rows[i].reason_detail for i in range(4)] == ["title", "url", "date", None]
    assert rows[3].outcome == "ok"


def test_meta_pairs_in_any_attribute_order(pages_of):
    head = "<meta content='b &amp; c' name=KEY><META property='og:x' content=\"1 > 0\"><!-- <meta name=no content=no> --><meta charset=utf-8>"
    rows = M.meta_pairs(pages_of(page("", head))).orderBy("pos").collect()
    assert [(r.key, r.value) for r in rows] == [("key", "b & c"), ("og:x", "1 > 0")]


def test_language(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog"), (2, "der Hund und die Katze"), (3, "xyz"), (4, ""), (5, "el perro y los gatos")],
        "page_id BIGINT, text STRING",
    )
    found = {r.page_id: r.detected for r in L.detect_language(docs).collect()}
    assert found == {1: "en", 2: "de", 3: None, 4: None, 5: "es"}
    own = L.detect_language(docs, profiles={"zz": ["xyz"]}, min_hits=1)
    assert {r.page_id: r.detected for r in own.collect()}[3] == "zz"
    gate = L.language_gate(L.detect_language(docs).selectExpr("*", "CASE WHEN page_id = 1 THEN 'fr' END AS declared"), "en")
    assert {r.page_id: (r.refused, r.detail) for r in gate.collect()} == {
        1: (True, None), 2: (True, "de"), 3: (False, None), 4: (False, None), 5: (True, "es"),
    }
    assert not any(r.refused for r in L.language_gate(gate.drop("refused", "detail"), None).collect())


def test_detection_agrees_with_the_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.detect_language(docs, "text").where("detected IS NOT NULL").selectExpr("avg(cast(lang = detected AS int)) AS ok", "count(*) AS n").first()
    assert rows.n > 950 and rows.ok > 0.98
