"""Kept blocks back to one row per page: text and HTML streams.

One aggregate on ``page_id`` collects the blocks of a page once, each tagged
with the passes that keep it; a page is bounded by the input size cap.  The
aggregate reuses the hash partitioning of the block rows, so nothing is
exchanged here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions import patterns as P
from pagewinnow.functions.text import listed, quoted, squash
from pagewinnow.functions.urls import absolutize
from pagewinnow.operators import blocks as B

# Below this many characters the baseline pass is tried (our choice of value).
MIN_EXTRACTED_CHARS = 250
STREAMS = ("content_text", "comments_text", "content_html", "comments_html")
# Passes whose HTML keeps lists and tables around blocks.
NEST_PASSES = ("main", "comment", "second")
PASSES = ("main", "base", "loose", "comment", "second")


def block_html(rows: DataFrame, options, base: str | None = None, where: str = "true") -> DataFrame:
    """Add ``inner``: a block's inline markup, balanced.

    Emphasis, scripts above and below the line and code stay, without their
    attributes; anchors and images stay when asked for, with their targets made
    absolute against ``base``.  Tags are matched inside the block, innermost
    pairs first; a tag without a partner goes, and of two pairs that cross the
    one that is matched last.  All other tags go.  Only blocks ``where`` holds
    for are worked on.
    """
    rows = rows.withColumn("inner", F.expr(f"CASE WHEN {where} THEN body END"))
    kept = "inner"
    links, images = options.sql("include_links"), options.sql("include_images")
    marked = quoted(f"{P.MARK_OPEN}$1{P.MARK_CLOSE}")
    if options.possible("include_links") or options.possible("include_images"):
        if base is not None:
            absolute = f"CASE WHEN ({links} OR {images}) AND contains(inner, '=') THEN {absolutize('inner', base)} ELSE inner END"
            rows = rows.withColumn("inner", F.expr(absolute))
        keep_as = quoted(f"{P.KEEP_OPEN}$1{P.KEEP_CLOSE}")
        rows = rows.withColumn(
            "inner",
            F.expr(f"CASE WHEN {links} AND contains(inner, '<') THEN regexp_replace(inner, {quoted(P.KEPT_LINK)}, {marked}) ELSE inner END"),
        )
        rows = rows.withColumn(
            "inner",
            F.expr(f"CASE WHEN {images} AND contains(inner, '<') THEN regexp_replace(inner, {quoted(P.KEPT_IMAGE)}, {keep_as}) ELSE inner END"),
        )
    spaced = f"regexp_replace({kept}, {quoted(P.LINE_BREAK)}, ' ')"
    both = quoted(f"{P.MARK_OPEN}$1$2{P.MARK_CLOSE}")
    bare = f"regexp_replace(regexp_replace({spaced}, {quoted(P.MARK_TAG)}, {both}), {quoted(P.ANY_TAG)}, '')"
    rows = rows.withColumn("inner", F.expr(f"CASE WHEN contains({kept}, '<') OR contains({kept}, {quoted(P.MARK_OPEN)}) THEN {bare} ELSE {kept} END"))
    pair = quoted(f"{P.KEEP_OPEN}$1$2{P.KEEP_CLOSE}$3{P.KEEP_OPEN}/$1{P.KEEP_CLOSE}")
    matched = "inner"
    for _ in range(P.MARK_DEPTH):
        matched = f"regexp_replace({matched}, {quoted(P.MARK_PAIR)}, {pair})"
    matched = f"regexp_replace({matched}, {quoted(P.MARKED)}, '')"
    rows = rows.withColumn("inner", F.expr(f"CASE WHEN contains(inner, {quoted(P.MARK_OPEN)}) THEN {matched} ELSE inner END"))
    restored = f"translate(inner, {quoted(P.KEEP_OPEN + P.KEEP_CLOSE)}, '<>')"
    # line breaks of preformatted text are part of it
    in_lines = f"regexp_replace({restored}, {quoted(r'^[ \t]*\r?\n|[ \t\r\n]+$')}, '')"
    return rows.withColumn("inner", F.expr(f"CASE WHEN tag = 'pre' THEN {in_lines} ELSE {squash(restored)} END"))


def label_passes(
    block_rows: DataFrame, options, keys: Sequence[str] = ("page_id",), featured: bool = False
) -> DataFrame:
    """Add one boolean per pass: ``k_main``, ``k_base``, ``k_loose``, ``k_comment``, ``k_second``.

    The second pass (statistical) is only worked out when fallback can be on;
    ``featured`` rows have the features it needs already.
    """
    labelled, second = block_rows, "false"
    if options.possible("enable_fallback"):
        rows = block_rows if featured else B.block_features(block_rows)
        labelled = B.smooth_blocks(B.classify_blocks(rows, options), keys)
        second = (
            f"keep AND NOT in_comments AND {B.allowed_by_options(options)} "
            f"AND {options.sql('enable_fallback')}"
        )
    return labelled.selectExpr(
        *block_rows.columns,
        f"{B.structural_label(options)} AS k_main",
        f"{B.baseline_label(options)} AS k_base",
        f"{B.loose_label(options)} AS k_loose",
        f"{B.comment_label(options)} AS k_comment",
        f"{second} AS k_second",
    )


def assemble(
    labelled: DataFrame,
    options,
    carry: Sequence[str] = (),
    keys: Sequence[str] = ("page_id",),
    base: str | None = None,
    min_chars: int = MIN_EXTRACTED_CHARS,
) -> DataFrame:
    """One row per page: the four streams, which pass won, and the carried columns.

    Main pass first; with fallback, the second pass replaces it when the main
    pass is poor and the second scores better; a result shorter than
    ``min_chars`` is rescued by the baseline pass when that finds more.  Where
    neither finds a character, the text outside elements that are furniture by
    their tag is taken, if it has at least ``min_chars``.
    """
    rows = labelled if "mark_step" in labelled.columns else labelled.selectExpr(
        "*", "0 AS mark_step", "0 AS mark_level", "CASE WHEN block_no = 0 THEN 1 ELSE 0 END AS mark_copies"
    )
    if base is not None:
        page = f"PARTITION BY {', '.join(keys)} ORDER BY block_no"
        rows = rows.withColumn(
            "_base", F.expr(f"first({base}, true) OVER ({page} ROWS UNBOUNDED PRECEDING)")
        )
    flags = [f"k_{p}" for p in PASSES]
    rows = block_html(rows, options, "_base" if base is not None else None, " OR ".join(flags))
    kept = (
        f"CASE WHEN {' OR '.join(flags)} THEN struct(block_no AS pos, text, "
        f"{element('inner')} AS html, {', '.join(flags)}) END"
    )
    # characters outside links; an anchor's text can be longer than the block's, where marks are dropped
    around = " AND ".join(["mark_step > 0", *["NOT in_pruned"][: "in_pruned" in rows.columns]])
    nests = ", ".join(f"{around} AND {test} AS k_{p}" for p, test in B.nest_labels(options).items())
    mark = f"CASE WHEN mark_step <> 0 THEN struct(mark_level AS level, block_no AS pos, mark_step AS step, tag AS name, {nests}) END"
    score = "greatest(coalesce(sum(CASE WHEN k_{} THEN n_chars - link_chars END), 0), 0)"
    pages = rows.groupBy(*keys).agg(
        F.expr(f"array_sort(collect_list({kept})) AS _kept"),
        F.expr(f"array_sort(collect_list({mark})) AS _sorted"),
        F.expr(f"{score.format('main')} AS main_score"),
        F.expr(f"{score.format('second')} AS second_score"),
        F.expr(f"max({options.sql('enable_fallback')}) AS _second_on"),
        F.expr("sum(mark_copies) AS copies"),
        *[F.expr(f"first({c}, true) AS {c}") for c in carry],
    )
    pages = fallback_select(pages, "_second_on", min_chars)
    pages = pages.withColumn("_marks", F.expr(paired_marks("_sorted")))
    won = "CASE WHEN chosen = 'second' THEN {} ELSE {} END"
    pages = pages.selectExpr(
        *keys,
        *carry,
        "chosen",
        "copies",
        won.format(stream("second", "text"), stream("main", "text")) + " AS _text",
        won.format(stream("second", "html"), stream("main", "html")) + " AS _html",
        f"{stream('base', 'text')} AS _base_only",
        f"{stream('loose', 'text')} AS _loose_text",
        f"{stream('comment', 'text')} AS comments_text",
        f"{stream('comment', 'html')} AS comments_html",
    )
    return rescue_short_pages(pages, min_chars).select(
        *keys, *STREAMS, "chosen", "rescued", "copies", *carry
    )


def element(inner: str) -> str:
    """A block's HTML."""
    name = f"CASE WHEN tag IN ({listed(P.OUTPUT_TAGS)}) THEN tag ELSE 'div' END"
    return f"concat('<', {name}, '>', {inner}, '</', {name}, '>')"


def paired_marks(marks: str) -> str:
    """Each opening or end tag with the one before and after it on its level.

    Sorted by level and place, brackets of one level alternate: an end tag
    belongs to the opening tag before it, and one without does not count.
    """
    beside = lambda i: f"CASE WHEN get({marks}, {i}).level = m.level THEN get({marks}, {i}) END"
    return f"transform({marks}, (m, i) -> struct(m AS m, {beside('i - 1')} AS before, {beside('i + 1')} AS after))"


def stream(name: str, field: str, keeps: str | None = None, html: str = "b.html") -> str:
    """Text joined by newlines, or HTML joined as is, of one pass.

    ``keeps`` tells of a block or an element, put in for ``{}``, whether the
    pass keeps it, ``html`` where a block's HTML is.

    In HTML, lists, tables, rows and quotations stay around their blocks: an
    element that the pass may keep is closed by the end tag of its level, under
    its own name, or at the end of the page; those left empty go.  Any choice of
    such pairs is properly nested, so every stream is.
    """
    keeps = keeps or f"{{}}.k_{name}"
    kept = f"filter(_kept, b -> {keeps.format('b')})"
    if field == "text":
        return f"array_join(filter(transform({kept}, b -> b.text), v -> v <> ''), '\\n')"
    event = "struct({} AS pos, {} AS part, {} AS level, {} AS html)".format
    blocks = f"transform({kept}, b -> {event('b.pos', 1, 0, html)})"
    if name not in NEST_PASSES:
        return f"array_join(transform({blocks}, e -> e.html), '')"
    opens = f"m.m.step > 0 AND {keeps.format('m.m')}"
    ends = f"m.m.step < 0 AND m.before.step > 0 AND {keeps.format('m.before')}"
    tag = lambda mark, of: f"concat('{mark}', {of}.name, '>')"
    opened = f"transform(filter(_marks, m -> {opens}), m -> {event('m.m.pos', 0, 0, tag('<', 'm.m'))})"
    ended = f"transform(filter(_marks, m -> {ends}), m -> {event('m.m.pos', 0, 0, tag('</', 'm.before'))})"
    unended = f"transform(filter(_marks, m -> {opens} AND m.after IS NULL), m -> {event(2147483647, 0, '-m.m.level', tag('</', 'm.m'))})"
    events = f"CASE WHEN size(_marks) = 0 THEN {blocks} ELSE array_sort(concat({blocks}, {opened}, {ended}, {unended})) END"
    joined = f"array_join(transform({events}, e -> e.html), '')"
    for _ in range(3):
        joined = f"regexp_replace({joined}, {quoted(P.EMPTY_NEST)}, '')"
    return joined


def fallback_select(pages: DataFrame, enabled: str, min_chars: int = MIN_EXTRACTED_CHARS) -> DataFrame:
    """Choose between the main and the second pass of the same page.

    ``enabled`` tells whether there is a second pass at all.

    Both passes are columns of one row, so no union or second shuffle is
    needed.  Scores are kept characters outside links.  The second pass is
    considered when the main one is short or less than half as rich.
    """
    poor = f"(main_score < {min_chars} OR second_score > 2 * main_score)"
    return pages.selectExpr(
        "*",
        f"CASE WHEN {enabled} AND {poor} AND second_score > main_score THEN 'second' ELSE 'main' END AS chosen",
    )


def rescue_short_pages(pages: DataFrame, min_chars: int = MIN_EXTRACTED_CHARS) -> DataFrame:
    """Replace a result under the minimum by the longer baseline text.

    The baseline knows no structure, so its HTML is a single paragraph.
    """
    nothing = f"_text = '' AND _base_only = '' AND length(_loose_text) >= {min_chars}"
    pages = pages.selectExpr("*", f"CASE WHEN {nothing} THEN _loose_text ELSE _base_only END AS _base_text")
    short = f"length(_text) < {min_chars} AND length(_base_text) > length(_text)"
    return pages.selectExpr("*", f"{short} AS rescued").selectExpr(
        "*",
        "CASE WHEN rescued THEN _base_text ELSE _text END AS content_text",
        f"CASE WHEN rescued THEN {paragraph('_base_text')} ELSE _html END AS content_html",
    )


def paragraph(text: str) -> str:
    escaped = f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"concat('<p>', replace({escaped}, '\\n', ' '), '</p>')"
