"""Shapes of head elements and linked data that real pages have."""

import datetime as dt

from pagewinnow.operators import metadata as M
from pagewinnow.options import ExtractOptions


def fields(spark, *documents, **options):
    rows = spark.createDataFrame(list(enumerate(documents)), "page_id BIGINT, html STRING")
    return [r.metadata for r in M.metadata_fields(rows, ExtractOptions.of(options)).orderBy("page_id").collect()]


def linked(*blocks):
    return "<title>t</title>" + "".join(f"<SCRIPT type='application/ld+json'>{b}</SCRIPT>" for b in blocks)


GRAPH = """{"@context": "x", "@graph": [
  {"@type": "WebSite", "name": "Site", "description": "about the site"},
  {"@type": ["Thing", "NewsArticle"], "headline": "[Update] Bridge reopens", "datePublished": "2024-05-06T07:08:09Z",
   "author": [{"@type": "Person", "name": "Ida Noddack"}, "Emmy Noether", {"name": "Ida Noddack"}],
   "keywords": ["rivers", "bridges"], "articleSection": ["Local", "Transport"],
   "image": [{"url": "https://n.example/1.png"}, "https://n.example/2.png"], "publisher": {"name": "The Herald"}}]}"""


def test_graphs_lists_and_article_items_first(spark):
    organization = '{"@type": "Organization", "headline": "Not this"}'
    (m,) = fields(spark, linked(organization, GRAPH))
    assert (m.title, m.author, m.date) == ("[Update] Bridge reopens", "Ida Noddack; Emmy Noether", dt.date(2024, 5, 6))
    assert (m.tags, m.categories) == (["rivers", "bridges"], ["Local", "Transport"])
    assert (m.image, m.sitename, m.description) == ("https://n.example/1.png", "The Herald", "about the site")
    assert "NewsArticle" in linked(GRAPH) and m.page_type == "Thing"


def test_broken_and_odd_blocks(spark):
    listed = '[{"@type": "Person"}, 5, null, {"@type": "BlogPosting", "headline": " ", "author": "One, Two"}]'
    m = fields(spark, linked("{"), linked("[]", "3", '"x"'), linked(listed), linked('{"author": {"url": "u"}}'))
    assert [x.title for x in m] == ["t"] * 4
    assert [x.author for x in m] == [None, None, "One, Two", None]


def test_several_authors_and_names_in_values(spark):
    two = '<meta content="the name=of it" name="author"><meta name=\'author\' content=\'Q "Quill" Roe\'>'
    late = "<title>t</title></head><body><p>x</p><meta name=author content=Late></body>"
    hidden = "<!-- <meta name=author content=Gone> --><script>'</head><meta name=author content=Gone>'</script>" + two
    m = fields(spark, two, late, hidden)
    assert [x.author for x in m] == ['the name=of it; Q "Quill" Roe', "Late", 'the name=of it; Q "Quill" Roe']
    (one,) = fields(spark, two, excluded_authors=["THE NAME=OF IT"])
    assert one.author == 'Q "Quill" Roe'


def test_tags_with_very_many_attributes(spark):
    for n in (40, 400, 20_000):
        many = " ".join(f'data-{i}="a > b = {i}"' for i in range(n))
        (m,) = fields(spark, f'<html {many} lang="pt-BR"><meta {many} name="keywords" {many} content="x,y">')
        assert (m.language, m.tags) == ("pt", ["x", "y"])


def test_references_of_the_whole_standard(spark):
    (m,) = fields(spark, "<title>&Uuml;ber &Ouml;l &frac12; &ograve; &rarr; &iquest; &#00000000233; &lt&amp;lt;</title>")
    assert m.title == "Über Öl ½ ò → ¿ é &lt&lt;"


def graph(*items):
    return linked('{"@graph": [' + ", ".join(items) + "]}")


def test_names_are_found_by_reference(spark):
    story = '{"@type": "NewsArticle", "author": {"@id": "#ann"}, "publisher": {"@id": "#org"}, "image": {"@id": "#pic"}}'
    ann, org = '{"@id": "#ann", "@type": "Person", "name": "Ann Lee"}', '{"@id": "#org", "name": {"@value": "The Org"}}'
    pic = '{"@id": "#pic", "@type": "ImageObject", "contentUrl": "https://n.example/p.png"}'
    inside = '{"@type": "WebPage", "isPartOf": {"@id": "#site", "name": "x"}, "about": [{"@id": "#ann", "name": "Ann Lee"}]}'
    m = fields(
        spark,
        graph(story, ann, org, pic),
        # in other blocks, and as a value of another item
        linked(story, org, ann),
        graph(inside, story),
        linked('{"author": [{"@id": "#a"}, "Plain", {"@id": "#b"}]}', '[{"@id": "#a", "name": "One"}, {"@id": "#b", "name": "Two"}]'),
    )
    assert [x.author for x in m] == ["Ann Lee", "Ann Lee", "Ann Lee", "One; Plain; Two"]
    assert [x.sitename for x in m[:3]] == ["The Org", "The Org", None]
    assert [x.image for x in m[:3]] == ["https://n.example/p.png", "#pic", "#pic"]


def test_references_that_lead_nowhere_or_in_circles(spark):
    story = '{"@type": "NewsArticle", "headline": "H", "author": {"@id": "#0"}}'
    ring = [f'{{"@id": "#{i}", "name": {{"@id": "#{(i + 1) % 5}"}}}}' for i in range(5)]
    chain = [f'{{"@id": "#{i}", "name": {{"@id": "#{i + 1}"}}}}' for i in range(700)] + ['{"@id": "#700", "name": "Far"}']
    m = fields(
        spark,
        graph(story),
        graph(story, *ring),
        graph(story, '{"@id": "#0", "name": {"@id": "#0"}}'),
        graph(story, *reversed(chain)),
        graph(story, '{"@id": "#0"}', '{"@id": "#0", "name": "Second"}', '{"@id": "#0", "name": "Third"}'),
        graph(story, '{"@id": "#0", "name": ""}', '{"@id": "", "name": "No"}', '{"@id": "#0", "name": "Late"}', "5", "null", '{"@id": 7}'),
    )
    assert [x.author for x in m] == [None, None, None, "Far", "Second", "Late"]
    assert {x.title for x in m} == {"H"}


def test_days_spelled_out(spark):
    shapes = {
        "March 9, 2020": "2020-03-09", "Mon, Mar. 9th 2020 at noon": "2020-03-09", "9 March 2020": "2020-03-09", "Montag, 9. März 2020": "2020-03-09",
        "le 1er août 2019": "2019-08-01", "9 de marzo de 2020": "2020-03-09", "lunes, 9 de Marzo del 2020": "2020-03-09", "31 décembre 1999 23:59": "1999-12-31",
        "2020-03-09T23:00:00-08:00": "2020-03-09", "20200309": "2020-03-09", "March 32, 2020": None, "Foo 9, 2020": None, "9 of 2020": None,
        "March 9, 20201": None, "March 9, 1890": None, "1234567é9": None, "yesterday": None, "May 2020": None, "": None,
    }
    for found in (
        fields(spark, *[f'<meta name="date" content="{x}">' for x in shapes]),
        fields(spark, *[f"<title>t</title><p>By A. <time>{x}</time> <time>1 May 2001</time></p>" for x in shapes]),
        fields(spark, *[f'<p><time class="x" datetime="{x}">1 May 2001</time></p>' for x in shapes if x]),
    ):
        assert [m.date and m.date.isoformat() for m in found] == list(shapes.values())[: len(found)]


def test_ranks_of_dates(spark):
    rows = [
        ("https://n.example/2019/3/9/story?x=/2001/01/01", "<p>x</p>"),
        ("https://n.example/news/2019-03-09-story.html", "<p>x</p>"),
        ("https://n.example/2019/03/09", "<time datetime='2018-01-02'>x</time>"),
        ("https://n.example/2019/03/09", "<meta name=date content='junk'><time>soon</time>"),
        ("https://n.example/2019/13/09/", "<p>x</p>"),
        ("https://n.example/120190309/20/1/2/?d=/2019/03/09", "<p>x</p>"),
        ("https://n.example/2019/03/091", "<p>x</p>"),
        (None, "<time datetime='2018-01-02'>x</time><meta name=date content='3 May 2017'>"),
    ]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id BIGINT, url STRING, html STRING")
    found = [r.metadata.date for r in M.metadata_fields(pages, ExtractOptions()).orderBy("page_id").collect()]
    assert [d and d.isoformat() for d in found] == ["2019-03-09", "2019-03-09", "2018-01-02", "2019-03-09", None, None, None, "2017-05-03"]
