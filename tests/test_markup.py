"""Token, region and block rules on hostile and ordinary markup."""

import time

import pytest

from pagewinnow.operators import blocks as B
from pagewinnow.operators import markup as M
from pagewinnow.operators.profiles import page_depth
from pagewinnow.plans.extract import content_blocks, process
from pagewinnow.options import ExtractOptions
from tests.conftest import article, by_page, page


def texts(df):
    return [r.text for r in content_blocks(df, ExtractOptions()).where("n_chars > 0").orderBy("block_no").collect()]


def test_tokens_cover_the_markup(pages_of):
    html = '<p class="a > b">x < y<br/>z</p><!-- c --><script>"</p>"</script>tail'
    rows = M.markup_tokens(pages_of(html)).orderBy("pos").collect()
    assert "".join(r.token for r in rows) == '<p class="a > b">x < y<br/>z</p>tail'
    assert [r.tag for r in rows if r.is_tag] == ["p", "br", "p"]


def test_attribute_values_may_hold_brackets(pages_of):
    html = "<body><p data-x='{\"a\":\"<p>no</p>\"}'>yes</p><a title=\"1 > 0\">go</a></body>"
    assert texts(pages_of(html)) == ["yes", "go"]


@pytest.mark.parametrize(
    "html,expected",
    [
        ("<p>a &amp;lt; b &#8217;&#x41;&eacute; &unknown; &#99999999; AT&T</p>", ["a &lt; b ’Aé &unknown; &#99999999; AT&T"]),
        ("<p>one<br>two</p>three", ["one two", "three"]),
        ("<p>open <!-- never closed <p>hidden", ["open"]),
        ("<p>x</p><script>if (a < b) { '<p>no</p>' }", ["x"]),
        ("<P>Upper</P><DIV\n class='c'>Case</DIV>", ["Upper", "Case"]),
        ("<p>  spaced \t\n out </p>", ["spaced out"]),
        ("", []),
    ],
)
def test_block_text(pages_of, html, expected):
    assert texts(pages_of(html)) == expected


def test_nested_containers_end_at_their_own_tag(pages_of):
    html = (
        '<div class="sidebar">a<div>b<div>c</div></div>d</div>e'
        "</div></div><nav>f</nav>g<nav>h"
    )
    rows = content_blocks(pages_of(html), ExtractOptions()).where("n_chars > 0").collect()
    inside = {r.text: r.in_chrome for r in rows}
    assert inside == {"a": True, "b": True, "c": True, "d": True, "e": False, "f": True, "g": False, "h": True}


def test_anchor_across_blocks_counts_as_link(pages_of):
    html = '<a href="/x"><div>all of this</div><p>and this</p></a><p>not <a>some</a> this</p>'
    rows = {r.text: r.link_chars for r in content_blocks(pages_of(html), ExtractOptions()).where("n_chars > 0").collect()}
    assert rows == {"all of this": 11, "and this": 8, "not some this": 4}


def test_focus_is_monotone_before_smoothing(spark, pages_of):
    from pagewinnow.catalog.fixtures import injected

    features = B.block_features(content_blocks(injected(spark, "/root/testdata/sf0.001"), ExtractOptions()))
    kept = {}
    for focus in B.THRESHOLDS:
        rows = B.classify_blocks(features, ExtractOptions(focus=focus)).where("label = 'good'")
        kept[focus] = {(r.page_id, r.block_no) for r in rows.select("page_id", "block_no").collect()}
    assert kept["favor_recall"] >= kept["balanced"] >= kept["favor_precision"] > set()


def test_depth_of_deep_markup_is_linear(pages_of):
    deep = "<div>" * 20000 + "x" + "</div>" * 20000
    started = time.time()
    rows = by_page(page_depth(pages_of(deep, "<p><b>x<br>", "</div><div>")))
    assert [rows[i].depth for i in range(3)] == [20000, 2, 1]
    assert time.time() - started < 30


@pytest.mark.parametrize("unit", ["<", "<a ", '<a b="', "<!--", "<script ", "&#", "<div>", "</div>", '<a x= y="1" ', "<h1>", "<title>", '<script type="application/ld+json">'])
def test_hostile_repetition_stays_linear(pages_of, unit):
    html = page("<article><p>kept</p></article>") + unit * (200_000 // len(unit))
    started = time.time()
    assert process(pages_of(html)).first() is not None
    assert time.time() - started < 60


def test_one_exchange_from_scan_to_page_row(spark, pages_of):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for options in ({}, {"enable_fallback": True}, {"prune_selector": ".x"}, {"target_language": "en"}):
            plan = process(pages_of(article()), **options)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1, options
            assert "Python" not in plan and "Join" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
