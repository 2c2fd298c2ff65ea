"""Which container counts, and HTML streams that are well nested."""

import random
from html.parser import HTMLParser

import pytest

from pagewinnow.functions import patterns as P
from pagewinnow.operators import blocks as B
from pagewinnow.plans.extract import content_blocks, process
from pagewinnow.options import ExtractOptions
from tests.conftest import article, page

STORY = "<p>" + "A sentence of the story that is long enough to stay, word after word. " * 6 + "</p>"


def texts(pages_of, *bodies, **options):
    rows = process(pages_of(*[page(b) for b in bodies]), **options).orderBy("page_id").collect()
    return [(r.outcome, r.content_text) for r in rows]


def test_the_innermost_container_decides(pages_of):
    bodies = [
        f'<div class="sidebar-right layout"><p>beside</p><article>{STORY}</article></div>',
        f'<div class="widget-area"><article>{STORY}<nav><p>inner menu</p></nav></article></div>',
        f'<article>{STORY}<div class="related"><p>see also</p><div class="entry-content"><p>deep</p></div></div></article>',
        f'<section id="promo"><main><div class="share-box"><p>pass on</p></div>{STORY}</main><p>behind it</p></section>',
        f'<article class="widget">{STORY}</article>',
    ]
    found = texts(pages_of, *bodies)
    assert [o for o, _ in found] == ["ok", "ok", "ok", "ok", "ok"]
    for _, text in found:
        assert "A sentence of the story" in text
    assert all(x not in found[i][1] for i, x in enumerate(["beside", "inner menu", "see also", "pass on"]))
    assert "deep" in found[2][1] and "behind it" not in found[3][1]


def test_furniture_by_tag_never_holds_content(pages_of):
    found = texts(pages_of, *[f"<{t}><article>{STORY}</article></{t}>" for t in ("aside", "nav", "footer", "menu", "dialog")])
    assert [o for o, _ in found] == ["refused"] * 5


def test_a_page_in_one_wrapper_is_rescued_and_a_short_one_is_not(pages_of):
    long, short = f'<div class="widget layout">{STORY}<nav>menu</nav></div>', '<div class="widget layout"><p>Few words.</p></div>'
    beside = f'<p>Plain words.</p><div class="sidebar">{STORY}</div>'
    found = texts(pages_of, long, short, beside)
    assert found[0][0] == "ok" and "menu" not in found[0][1]
    assert found[1][0] == "refused" and found[2] == ("ok", "Plain words.")


def test_wrappers_in_wrappers_and_crossing_ends(pages_of):
    deep = '<div class="widget">' * 7 + f"<article>{STORY}</article>" + "<p>out</p>" + "</div>" * 7
    crossed = f'<article>{STORY}<div class="sidebar"></article><p>out</p></div><p>out too</p>'
    stray = f'</div></article><div class="widget"></div></div><article>{STORY}</article>'
    found = texts(pages_of, deep, crossed, stray)
    assert [o for o, _ in found] == ["ok"] * 3
    assert all("out" not in t.replace("without", "") for _, t in found)


def test_brackets_in_attribute_values_are_no_link_text(pages_of):
    body = f'<article><p>Go <a title="{"x > " * 100}" href="/a">here</a> to read what the others of the town have said about it.</p></article>'
    rows = content_blocks(pages_of(page(body)), ExtractOptions()).where("n_chars > 0").collect()
    assert max(r.link_chars for r in rows if "Go here" in r.text) == 4


def test_without_fallback_the_second_pass_is_never_chosen(pages_of):
    body = f'<article><p><a href="/a" title="{"x > " * 90}">Only a link</a></p></article>'
    row = process(pages_of(page(body))).first()
    assert row.content_text == "Only a link" and row.content_html == "<p>Only a link</p>"
    linked = process(pages_of(page(body), urls={0: "https://h.org/"}), include_links=True).first()
    assert linked.content_html.startswith("<p><a ") and linked.content_html.endswith("</a></p>")


class Nesting(HTMLParser):
    def __init__(self):
        super().__init__()
        self.open, self.faults = [], 0

    def handle_starttag(self, tag, attrs):
        if tag not in P.VOID_TAGS:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if self.open and self.open[-1] == tag:
            self.open.pop()
        else:
            self.faults += 1


def well_nested(html):
    parser = Nesting()
    parser.feed(html)
    parser.close()
    return not parser.open and not parser.faults


TAGS = ("ul", "ol", "dl", "table", "tr", "td", "li", "dd", "blockquote", "p", "div", "h2", "pre", "article", "nav", "b", "sup", "em", "I", "a", "span", "code", "br")


def soup(pick):
    out = []
    for _ in range(pick.randint(1, 60)):
        kind, tag = pick.random(), pick.choice(TAGS)
        if kind < 0.4:
            attrs = pick.choice(["", "", ' class="x"', ' href="/y?a=1"', ' title="a > b"', ' id="comments"', ' class="related"', "/"])
            out.append(f"<{tag}{attrs}>")
        elif kind < 0.7:
            out.append(f"</{tag}{pick.choice(['', '', ' '])}>")
        else:
            out.append(pick.choice(["word ", "a few words that go on for some time ", "x &lt; y", "&amp;", "\n"]))
    return "".join(out)


@pytest.mark.parametrize("options", [{}, {"include_links": True, "include_images": True}, {"enable_fallback": True}, {"prune_selector": "ul, .x, b"}])
def test_every_stream_is_well_nested(pages_of, options):
    pick = random.Random(7)
    bodies = [page(f"<article>{soup(pick)}{STORY}{soup(pick)}</article>{soup(pick)}") for _ in range(300)]
    rows = process(pages_of(*bodies), **options).collect()
    assert sum(r.content_html != "" for r in rows) > 150 and any(r.comments_html for r in rows)
    for r in rows:
        assert well_nested(r.content_html), (r.content_html, bodies[r.page_id])
        assert well_nested(r.comments_html), (r.comments_html, bodies[r.page_id])


def test_structure_stays(pages_of):
    body = (
        "<ul><li>one</li><li>two<ol><li>inner</li></ol></li></ul><table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>"
        "<p>x<sup>2</sup> and H<sub>2</sub>O, <B class=k>bold <i>both</i></B>, <b>lost, <i>crossing</b></i></p>"
        "<blockquote><p>said</p></blockquote><dl><dt>t</dt><dd>d</dd></dl><ul class='share'><li>pass on</li></ul><ul><nav><li>menu</li></nav></ul>"
    )
    html = process(pages_of(page(f"<article>{STORY}{body}</article>"))).first().content_html
    assert html.split("</p>", 1)[1] == (
        "<ul><li>one</li><li>two</li><ol><li>inner</li></ol></ul>"
        "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>"
        "<p>x<sup>2</sup> and H<sub>2</sub>O, <B>bold <i>both</i></B>, lost, crossing</p>"
        "<blockquote><p>said</p></blockquote><dl><dt>t</dt><dd>d</dd></dl>"
    )


def test_hostile_nesting_stays_linear(pages_of):
    """A hundred thousand open lists, marks and wrappers; quadratic work would not end here."""
    n = 100_000
    for piece in ("<ul>", "<b>", "<b>x</i>", '<div class="widget">', "<article>", "</ul>", "<tr></tr>", "<b><i>", "<table><tr>"):
        row = process(pages_of(page(f"<article>{STORY}{piece * n}</article>"))).first()
        assert row.outcome == "ok" and "A sentence" in row.content_text


def test_focus_still_widens(pages_of):
    body = article('<div class="teaser"><p>A hint of another story told elsewhere</p></div>')
    kept = [process(pages_of(body), focus=f).first().content_text for f in ("favor_precision", "balanced", "favor_recall")]
    assert "hint" in kept[2] and "hint" not in kept[0] + kept[1]
    assert set(B.THRESHOLDS) == {"favor_precision", "balanced", "favor_recall"}
