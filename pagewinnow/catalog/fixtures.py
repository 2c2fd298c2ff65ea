"""Derived inputs for operators whose markup the page table does not contain.

Every fixture is one expression over all rows of the page table, decided by
``page_id`` alone and written in SQL that Spark and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewinnow.functions.text import plain_text, quoted
from pagewinnow.sources.pages import read_pages

_ID = "cast(page_id AS varchar(20))"


def _when(test: str, *parts: str) -> str:
    body = ", ".join(p if p.startswith("cast(") else f"'{p}'" for p in parts)
    return f"CASE WHEN {test} THEN concat({body}) ELSE '' END"


_HEAD = ", ".join(
    [
        _when("page_id % 4 = 2", '<meta name="author" content="Mary Somerville">'),
        _when("page_id % 4 = 0", '<meta content="Mary Somerville; Emmy Noether" name="author">'),
        _when("page_id % 3 = 0", '<meta property="og:site_name" content="The Harbour Gazette">'),
        _when("page_id % 5 <> 0", '<meta property="og:url" content="https://gazette.example.com/p/', _ID, '">'),
        _when("page_id % 7 < 5", '<meta property="og:image" content="/img/cover', _ID, '.png">'),
        _when("page_id % 3 = 1", '<meta name="keywords" content="tides, harbours , Spark &amp; SQL">'),
        _when("page_id % 4 = 3", '<meta content="What   the story says" property="og:description">'),
        _when("page_id % 6 = 0", '<meta property="article:published_time" content="2020-03-09">'),
        _when("page_id % 6 = 1", '<meta property="article:published_time" content="2020-01-21T02:00:00+05:30">'),
        _when("page_id % 6 = 2", '<meta property="article:published_time" content="2020-01-20T20:30:00-06:00">'),
        _when("page_id % 6 = 3", '<meta property="article:published_time" content="20190405">'),
        _when("page_id % 6 = 4", '<meta property="article:published_time" content="1234567é9">'),
        _when("page_id % 12 = 10", '<meta name="date" content="Wednesday, March 9th, 2016">'),
        _when(
            "page_id % 16 = 5",
            '<script type="application/ld+json">{"@type": "NewsArticle", "headline": "Linked headline ',
            _ID,
            '", "author": {"name": "Linus Data"}, "datePublished": "2021-05-06"}</script>',
        ),
        # the author is named in another item, and that item's name in a third one
        _when(
            "page_id % 16 = 13",
            '<script type="application/ld+json">{"@graph": [{"@type": "Person", "@id": "#writer", "name": {"@id": "#name"}}, '
            '{"@type": "NewsArticle", "headline": "Linked headline ',
            _ID,
            '", "author": [{"@id": "#nobody"}, {"@id": "#writer"}], "datePublished": "2021-05-06"}, '
            '{"@id": "#name", "name": "Linus Data"}]}</script>',
        ),
        # names that lead to each other
        _when(
            "page_id % 16 = 3",
            '<script type="application/ld+json">{"@graph": [{"@id": "#a", "name": {"@id": "#b"}}, {"@id": "#b", "name": {"@id": "#a"}}, '
            '{"@type": "Article", "headline": "In a circle ',
            _ID,
            '", "author": {"@id": "#a"}}]}</script>',
        ),
    ]
)
_BODY = ", ".join(
    [
        _when("page_id % 4 = 1", "<table><tr><td>Figures of row ", _ID, "</td></tr></table>"),
        _when("page_id % 10 = 7", '<p><img src="/img/', _ID, '.png" alt="A harbour"></p>'),
        _when("page_id % 10 = 2", '<p>Seen here <img src="data:image/png;base64,AAAA"></p>'),
        _when("page_id % 10 = 4", '<p><img src="/static/logo.png" alt="Logo"> Mark ', _ID, "</p>"),
        _when("page_id % 6 = 0", '<div class="teaser"><p>A hint at another story ', _ID, "</p></div>"),
        _when("page_id % 6 = 3", '<div class="bottom-links"><p>More to see at the end ', _ID, "</p></div>"),
        _when(
            "page_id % 3 = 2",
            '<p>Read <a href="/more/', _ID, '">more here</a>, <a href="//cdn.example.net/x">there</a>'
            ' or <a href="https://other.example.org/y?a=1">further on</a>.</p>',
        ),
        _when("page_id % 9 = 0", "<p>A line both streams carry ", _ID, "</p>"),
        _when("page_id % 6 = 5", '<p>Out on <time datetime="2018-11-30T23:00:00-08:00">the last of the month</time>, page ', _ID, "</p>"),
        _when("page_id % 12 = 4", "<p>Out on <time>9. März 2017</time>, page ", _ID, "</p>"),
        _when(
            "page_id % 5 = 1",
            "<ul><li>First of ", _ID, "<li>Second <ol><li>inner <b>one</b></li></ol></li></ul><p>Area x<sup>2</sup> of "
            "<em class=\"e\">all <strong>parts</strong></em>, <b>cross <i>ing</b> marks</i> and <u>open</p>",
        ),
        _when(
            "page_id % 5 = 3",
            "<table><tr><td>Cell ", _ID, "</td><td><code>b</code></td></tr><tr><td>next</td></tr></table>"
            "<blockquote><p>Quoted in ", _ID, "</p></blockquote></ol><dl><dt>Term</dt><dd>Meaning<ul><li>Left open ", _ID, "</dl>",
        ),
        _when(
            "page_id % 7 = 3",
            '<p>From <a title="page > part > ', _ID, '" href="/part">here</a> on the text goes further than the link.</p>',
        ),
    ]
)
_AFTER = ", ".join(
    [
        _when(
            "page_id % 3 = 0",
            '<div id="comments"><div class="comment"><p>Someone remarks on ', _ID, "</p></div>",
        ),
        _when("page_id % 9 = 0", '<div class="comment"><p>A line both streams carry ', _ID, "</p></div>"),
        _when("page_id % 3 = 0", "</div>"),
        _when("page_id % 4 = 2", "<div><span>Loose text of page ", _ID, " outside the article.</span></div>"),
    ]
)
INJECTED = (
    f"replace(replace(html, '</head>', concat({_HEAD}, '</head>')), "
    f"'</article>', concat({_BODY}, '</article>', {_AFTER}))"
)
# A third of the pages lose their article element and become anonymous markup.
# Of others the article is little more than one link whose attributes hold brackets.
UNSTRUCTURED = (
    "CASE WHEN page_id % 3 = 0 THEN "
    "replace(replace(html, '<article>', '<div>'), '</article>', '</div>') "
    "WHEN page_id % 3 = 1 THEN concat(split_part(html, '<article>', 1), '<article><p>', "
    f"'<a href=\"/all\" title=\"', repeat('one > ', 60), '\">All of it ', {_ID}, '</a></p></article>') "
    "ELSE html END"
)
# Articles in wrappers that sound like furniture, furniture in articles, furniture by tag around
# articles, and pages that are one such wrapper without an article.
_OPENED = ", ".join(
    [
        _when("page_id % 6 = 0", '<div class="sidebar-right layout"><p>Beside the story of ', _ID, "</p><article>"),
        _when("page_id % 6 = 1", '<div class="widget-area"><main id="share-page"><article>'),
        _when("page_id % 6 = 2", '<aside class="box"><article>'),
        _when("page_id % 6 = 3", '<section class="promo"><div class="post-content"><article>'),
        _when("page_id % 6 = 4", '<div class="related layout">'),
        _when("page_id % 6 = 5", '<article><div class="related"><p>Also read about ', _ID, '</p></div>'),
    ]
)
_CLOSED = ", ".join(
    [
        _when("page_id % 6 = 0", "</article></div>"),
        _when("page_id % 6 = 1", '<nav><a href="/in">Within the story ', _ID, "</a></nav></article><p>After it ", _ID, "</p></main></div>"),
        _when("page_id % 6 = 2", "</article></aside>"),
        _when("page_id % 6 = 3", '</article><div class="share-bar"><p>Pass on ', _ID, "</p><article><p>Inner piece ", _ID, "</p></article></div></div></section>"),
        _when("page_id % 6 = 4", "</div>"),
        _when("page_id % 6 = 5", "</article>"),
    ]
)
WRAPPED = f"replace(replace(html, '<article>', concat({_OPENED})), '</article>', concat({_CLOSED}))"
# One byte that no UTF-8 sequence starts with, put in front of the article.
BAD_BYTE = "unhex('93')"
STREAM_TIME = "timestamp '2024-01-01 00:00:00'"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet", min_partitions=spark.sparkContext.defaultParallelism)


def injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).withColumn("html", F.expr(INJECTED))


def unstructured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).withColumn("html", F.expr(UNSTRUCTURED))


def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).withColumn("html", F.expr(WRAPPED))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as bytes, a tenth of them with one bad byte inside."""
    damaged = (
        "concat(cast(substring_index(html, '<article>', 1) AS binary), "
        f"{BAD_BYTE}, cast(substr(html, length(substring_index(html, '<article>', 1)) + 1) AS binary))"
    )
    whole = "cast(html AS binary)"
    return pages(spark, sf_dir).withColumn(
        "html", F.expr(f"CASE WHEN page_id % 10 = 3 THEN {damaged} ELSE {whole} END")
    )


def odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as bytes, each seventh with another oddity: marks, a bad byte, a NUL."""
    data = "cast(html AS binary)"
    return pages(spark, sf_dir).withColumn(
        "html",
        F.expr(
            f"CASE page_id % 7 WHEN 0 THEN concat(X'EFBBBF', {data}) WHEN 1 THEN concat(X'FFFE', {data}) "
            f"WHEN 2 THEN concat({data}, X'00') WHEN 3 THEN concat({data}, {BAD_BYTE}) ELSE {data} END"
        ),
    )


def marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fourth of the pages start with a byte-order mark."""
    return pages(spark, sf_dir).withColumn(
        "html", F.expr("CASE WHEN page_id % 4 = 1 THEN concat('﻿', html) ELSE html END")
    )


def with_time(pages: DataFrame) -> DataFrame:
    when = f"timestampadd(SECOND, cast(page_id AS int), {STREAM_TIME}) AS ingest_ts"
    return pages.selectExpr("*", when)


#: page ids in thirds, one a batch; some rows come ten minutes late
BATCH = "cast(floor(page_id * 3 / (top + 1)) AS int)"
LATE_TIME = f"timestampadd(MINUTE, cast(CASE WHEN page_id % 9 = 8 THEN -10 ELSE 0 END AS int), timestampadd(SECOND, cast(page_id * 4 AS int), {STREAM_TIME}))"


def batches(pages: DataFrame) -> list[DataFrame]:
    (top,) = pages.agg(F.max("page_id")).first()
    numbered = pages.withColumn("batch", F.expr(BATCH.replace("top", str(top or 0))))
    return [numbered.where(f"batch = {k}").drop("batch") for k in range(3)]


# A later state of stored results: lines in another order, new, gone or put at the end, titles
# with an addition, and a tenth of the pages under another id.
EDITED_TEXT = (
    "CASE page_id % 5 WHEN 0 THEN array_join(reverse(lines), '\\n') "
    "WHEN 1 THEN concat('Added to page ', page_id, '\\n', content_text, '\\n', lines[0]) "
    "WHEN 2 THEN array_join(concat(slice(lines, 1, 1), slice(lines, 3, 1000000)), '\\n') "
    "WHEN 3 THEN array_join(concat(slice(lines, 2, 1000000), slice(lines, 1, 1)), '\\n') ELSE content_text END"
)


def edited(processed: DataFrame) -> DataFrame:
    title = "CASE WHEN page_id % 7 = 0 THEN concat(metadata.title, ' (2)') ELSE metadata.title END"
    return (
        processed.withColumn("lines", F.split("content_text", "\n"))
        .withColumn("content_text", F.expr(EDITED_TEXT))
        .withColumn("metadata", F.col("metadata").withField("title", F.expr(title)))
        .withColumn("page_id", F.expr("CASE WHEN page_id % 10 = 4 THEN page_id + 1000000000 ELSE page_id END"))
        .drop("lines")
    )


# Truth is cut by pattern straight from the document: paragraphs of all articles, marked up
# or not, without headings; links, notices and footers outside of them.
ARTICLE = r"(?s)<article>(.*?)</article>"
HEADING = r"(?s)<h[1-6](?:\s[^<>]*)?>.*?</h[1-6]>"
BREAKS = r"</?(?:p|ul|ol|li|div|table|tr|td|th|blockquote|pre|section)(?:\s[^<>]*)?>"
OUTSIDE = (r"(?s)<a(?:\s[^<>]*)?>(.*?)</a>", r"""(?s)<(?:div class="ad"|footer)>(.*?)</(?:div|footer)>""")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, kind, snippet`` for scoring, as reading text.

    The scored classifiers, some of which never look at containers, are not
    judged by their own rules.
    """
    inside = (
        f"flatten(transform(regexp_extract_all(html, {quoted(ARTICLE)}, 1), "
        f"a -> split(regexp_replace(a, {quoted(HEADING)}, '<p>'), {quoted(BREAKS)})))"
    )
    others = ", ".join(f"regexp_extract_all(html, {quoted(pattern)}, 1)" for pattern in OUTSIDE)
    found = pages(spark, sf_dir).selectExpr(
        "page_id",
        f"inline(concat(transform({inside}, s -> struct('with' AS kind, s AS markup)), "
        f"transform(concat({others}), s -> struct('without' AS kind, s AS markup))))",
    )
    read = plain_text(found, "markup", "snippet").select("page_id", "kind", "snippet")
    return read.where("snippet <> ''").distinct()
