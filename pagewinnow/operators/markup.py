"""Markup to ordered token rows, and the container each row sits in.

Two grains share one shape.  ``markup_tokens`` gives one row per tag or text
run; ``block_tokens`` gives one row per block-level tag together with the
inline markup that follows it, so a row *is* a text block and blocks need no
regrouping.  Rows of one page are never collected: they stream through windows
over one hash partitioning on ``page_id``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions import patterns as P
from pagewinnow.functions.text import attribute, listed, quoted
from pagewinnow.functions.utf8 import without_bom
from pagewinnow.options import OptionError

# What an open container says about the rows inside it, one bit each.  ``furniture``
# is an element that is page furniture by its tag, ``wrapper`` one that is by its words.
REGIONS = ("content", "furniture", "header", "table", "comments", "teaser", "bottom", "wrapper", "pruned")
BIT = {name: 1 << i for i, name in enumerate(REGIONS)}
# What rows are told: ``chrome`` follows from furniture, wrappers and content.
FLAGS = ("content", "chrome", "furniture", "header", "table", "comments", "teaser", "bottom")
# Wrappers nested deeper than this count as one level.
_WRAPPER_LEVELS = 4

_CONTENT_TAGS = ("article", "main")
_CHROME_TAGS = ("nav", "footer", "aside", "menu", "dialog")
# Only elements that are normally closed explicitly can carry a region.
_UNPAIRED = listed((*P.VOID_TAGS, "html", "body", "head", ""))
_ROWS_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def clean_markup(html: str) -> str:
    """Drop our own marks, the byte-order mark, comments, scripts and styles."""
    text = without_bom(f"coalesce({html}, '')")
    unmarked = (
        f"CASE WHEN {html} RLIKE {quoted(f'[{P.MARKS}]')} "
        f"THEN translate({text}, {quoted(P.MARKS)}, '') ELSE {text} END"
    )
    return f"regexp_replace(concat({unmarked}, {quoted(P.CLOSING_TAIL)}), {quoted(P.DROPPED)}, '')"


def _spread(pages: DataFrame, co_located: bool) -> DataFrame:
    """Hash pages on ``page_id`` while they are still one row each.

    The windows and the page aggregate downstream all reuse this partitioning.
    A source already bucketed on ``page_id`` needs no exchange at all.
    """
    return pages if co_located else pages.repartition("page_id")


def _attribute_columns(attrs: str) -> list[str]:
    spaced = f"concat(' ', {attrs})"
    return [
        f"CASE WHEN contains({attrs}, '=') THEN lower({attribute(spaced, name)}) ELSE '' END AS {alias}"
        for name, alias in (("class", "css_class"), ("id", "css_id"), ("role", "role"))
    ]


def markup_tokens(pages: DataFrame, co_located: bool = False) -> DataFrame:
    """``page_id, pos, token, is_tag, closing, tag, css_class, css_id, role``."""
    clean = pages.selectExpr("page_id", f"{clean_markup('html')} AS markup")
    return (
        _spread(clean, co_located)
        .selectExpr(
            "page_id",
            f"posexplode(regexp_extract_all(markup, {quoted(P.TOKEN)}, 0)) AS (pos, token)",
        )
        .selectExpr("page_id", "pos", "token", "token RLIKE '^<[a-zA-Z/!?]' AS is_tag")
        .selectExpr("*", "CASE WHEN is_tag THEN token ELSE '' END AS _tag")
        .selectExpr(
            "page_id",
            "pos",
            "token",
            "is_tag",
            "is_tag AND token LIKE '</%' AS closing",
            "lower(regexp_extract(_tag, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag",
            *_attribute_columns("_tag"),
        )
    )


def block_tokens(
    pages: DataFrame,
    carry: Sequence[str] = (),
    every_tag: bool = False,
    co_located: bool = False,
) -> DataFrame:
    """One row per block-level tag with the inline markup after it.

    ``carry`` names page-level columns; they ride on the first row of the page
    only, so a wide record is not copied to every row that gets sorted.
    ``every_tag`` also cuts at inline tags (``prune_blocks`` joins them again).
    """
    pattern = P.block_tag(None if every_tag else P.BLOCK_TAGS)
    marks = f"{P.SEGMENT}$1{P.PART}$2{P.PART}$3{P.PART}"
    marked = (
        f"concat({quoted(P.PART * 3)}, "
        f"regexp_replace({clean_markup('html')}, {quoted(pattern)}, {quoted(marks)}))"
    )
    spread = _spread(pages.selectExpr("page_id", f"{marked} AS marked", *carry), co_located)
    return (
        spread.selectExpr(
            "page_id", *carry, f"posexplode(split(marked, {quoted(P.SEGMENT)})) AS (pos, segment)"
        )
        .selectExpr("page_id", "pos", *carry, f"split(segment, {quoted(P.PART)}) AS parts")
        .selectExpr(
            "page_id",
            "pos",
            "get(parts, 0) = '/' AS closing",
            "lower(get(parts, 1)) AS tag",
            *_attribute_columns("get(parts, 2)"),
            "get(parts, 3) AS body",
            *(["get(parts, 2) AS attrs"] if every_tag else []),
            *[f"CASE WHEN pos = 0 THEN {c} END AS {c}" for c in carry],
        )
    )


def selector_predicate(selector: str) -> str:
    """A comma list of ``tag``, ``.class``, ``#id`` and joins such as ``div.ad#x``."""
    matches = []
    for simple in (part.strip() for part in selector.split(",")):
        if not simple or not re.fullmatch(r"(?:[a-zA-Z][a-zA-Z0-9]*|\*)?(?:[.#][\w\-]+)*", simple):
            raise OptionError(f"prune_selector: unsupported selector {simple!r}")
        tag = re.match(r"[a-zA-Z0-9*]*", simple).group().lower()
        tests = [] if tag in ("", "*") else [f"tag = {quoted(tag)}"]
        for mark, name in re.findall(r"([.#])([\w\-]+)", simple):
            if mark == "#":
                tests.append(f"css_id = {quoted(name.lower())}")
            else:
                tests.append(f"contains(concat(' ', css_class, ' '), {quoted(f' {name.lower()} ')})")
        matches.append("(" + (" AND ".join(tests) or "true") + ")")
    return " OR ".join(matches)


def _opened_regions(selector: str | None) -> str:
    """Bits an opening tag sets for everything inside its element."""
    words = "concat(' ', css_class, ' ', css_id, ' ')"

    def named(pattern: str) -> str:
        return f"(css_class <> '' OR css_id <> '') AND {words} RLIKE {quoted(pattern)}"

    tests = {
        "content": f"tag IN ({listed(_CONTENT_TAGS)}) OR role = 'main' OR {named(P.CONTENT_WORDS)}",
        "furniture": f"tag IN ({listed(_CHROME_TAGS)})",
        "wrapper": named(P.CHROME_WORDS),
        "header": "tag = 'header'",
        "table": "tag = 'table'",
        "comments": named(P.COMMENT_WORDS),
        "teaser": named(P.TEASER_WORDS),
        "bottom": named(P.BOTTOM_WORDS),
    }
    if selector is not None:
        tests["pruned"] = selector_predicate(selector)
    bits = " + ".join(f"CASE WHEN {test} THEN {BIT[name]} ELSE 0 END" for name, test in tests.items())
    return f"CASE WHEN closing OR tag IN ({_UNPAIRED}) THEN 0 ELSE {bits} END"


def region_state(tokens: DataFrame, selector: str | None = None, nested: bool = False) -> DataFrame:
    """Add ``in_<region>`` flags: is this row inside an open element of a kind.

    ``nested`` adds ``mark_step`` and ``mark_level`` too (see ``_marks``).

    An element ends at its own end tag: opening and closing tags of one name
    alternate within one nesting level, so the tag before a closing tag on the
    same level is the one it closes.

    ``in_chrome`` is page furniture: inside an element that is furniture by its
    tag, or inside one that is by its class or id words (a wrapper), unless a
    content container lies between.  A content container opens and closes at one
    wrapper depth, so the innermost of both kinds is a content container where
    one that opened at the present wrapper depth is still open.  An element that
    is both counts as a wrapper.

    All windows partition by ``page_id`` first and reuse the hash partitioning
    of the tokens.
    """
    by_name = f"OVER (PARTITION BY page_id, tag ORDER BY pos {_ROWS_SO_FAR})"
    step = f"CASE WHEN tag IN ({_UNPAIRED}) THEN 0 WHEN closing THEN -1 ELSE 1 END"
    # nesting level that stray end tags cannot push below zero; an end tag
    # belongs to the level it leaves
    depth = "_sum - least(0, _low)"
    level = (
        f"CASE WHEN tag IN ({listed(P.OPTIONAL_END_TAGS)}) THEN 1 "
        f"WHEN closing THEN {depth} + 1 ELSE {depth} END"
    )
    page = f"OVER (PARTITION BY page_id ORDER BY pos {_ROWS_SO_FAR})"

    def still_open(name: str, test: str = "true") -> str:
        return f"sum(CASE WHEN {test} THEN (_opened & {BIT[name]}) - (_ended & {BIT[name]}) ELSE 0 END) {page} > 0"

    counted = [n for n in FLAGS if n != "chrome"] + (["pruned"] if selector is not None else [])
    wrapper = BIT["wrapper"]
    wrappers = f"sum((_opened & {wrapper}) - (_ended & {wrapper})) {page} / {wrapper}"
    plain = f"((_opened | _ended) & {wrapper}) = 0"
    at_depth = " ".join(
        f"WHEN {n} THEN {still_open('content', f'_depth = {n} AND {plain}')}" for n in range(1, _WRAPPER_LEVELS + 1)
    )
    flags = [f"in_{n}" for n in FLAGS + (("pruned",) if selector is not None else ())]
    rows = (
        tokens.selectExpr("*", f"{_opened_regions(selector)} AS _opened", f"sum({step}) {by_name} AS _sum", *_marks(1))
        .selectExpr("*", f"min(_sum) {by_name} AS _low")
        .selectExpr("*", f"{level} AS _level")
        .selectExpr(
            "*",
            "coalesce(lag(_opened) OVER (PARTITION BY page_id, tag, _level ORDER BY pos), 0) AS _ended",
        )
        .selectExpr(
            "*",
            *[f"{still_open(n)} AS in_{n}" for n in counted],
            f"cast(least(greatest({wrappers}, 0), {_WRAPPER_LEVELS}) AS int) AS _depth",
            *_marks(2),
        )
    )
    inside = f"CASE _depth WHEN 0 THEN true {at_depth} END"
    rows = rows.selectExpr("*", f"in_furniture OR NOT ({inside}) AS in_chrome", *_marks(3))
    return rows.selectExpr(*tokens.columns, *flags, *(_marks(4) if nested else []))


def _marks(stage: int) -> list[str]:
    """Lists, tables, rows and quotations as one kind of bracket: ``mark_step`` and ``mark_level``.

    ``mark_copies`` is 1 on a page's first row: more in sum are pages of one id.

    A table row counts where it has an end tag of its own.  The level of an
    opening tag is its depth, that of an end tag the depth it leaves; stray end
    tags can't push the depth below zero.
    """
    alike = "OVER (PARTITION BY page_id, tag ORDER BY pos)"
    page = f"OVER (PARTITION BY page_id ORDER BY pos {_ROWS_SO_FAR})"
    named = listed(t for t in P.NESTING_TAGS if t != "tr")
    step = (
        f"CASE WHEN tag IN ({named}) THEN CASE WHEN closing THEN -1 ELSE 1 END "
        "WHEN tag <> 'tr' THEN 0 WHEN closing AND NOT _tag_before THEN -1 WHEN NOT closing AND _tag_after THEN 1 ELSE 0 END"
    )
    depth = "_mark_sum - least(0, min(_mark_sum) {page})".format(page=page)
    return {
        1: [f"lag(closing) {alike} AS _tag_before", f"lead(closing) {alike} AS _tag_after"],
        2: [f"coalesce({step}, 0) AS mark_step", f"sum(coalesce({step}, 0)) {page} AS _mark_sum"],
        3: [f"{depth} + CASE WHEN mark_step < 0 THEN 1 ELSE 0 END AS mark_level"],
        4: ["mark_step", "cast(mark_level AS int) AS mark_level", "CASE WHEN pos = 0 THEN 1 ELSE 0 END AS mark_copies"],
    }[stage]


def prune_blocks(
    pages: DataFrame, selector: str, carry: Sequence[str] = (), co_located: bool = False
) -> DataFrame:
    """Block rows with region flags, without anything inside a matching element.

    Cuts at every tag so that inline elements can be matched too, blanks the
    matches, and joins the pieces back into one row per block-level tag.  The
    aggregate groups within ``page_id``, so it needs no exchange of its own.
    """
    rows = region_state(
        block_tokens(pages, carry, every_tag=True, co_located=co_located), selector, nested=True
    )
    is_block = f"(tag IN ({listed(P.BLOCK_TAGS)}) OR pos = 0)"
    inline_tag = "concat('<', CASE WHEN closing THEN '/' ELSE '' END, tag, attrs, '>')"
    markup = (
        "CASE WHEN in_pruned THEN '' "
        f"ELSE concat(CASE WHEN {is_block} THEN '' ELSE {inline_tag} END, body) END"
    )
    page = f"OVER (PARTITION BY page_id ORDER BY pos {_ROWS_SO_FAR})"
    numbered = rows.selectExpr(
        "*",
        f"max(CASE WHEN {is_block} THEN pos END) {page} AS _block",
        f"struct(pos, {markup} AS markup) AS _piece",
        f"{is_block} AS _is_block",
    )
    flags = [f"in_{name}" for name in FLAGS]
    own = ["closing", "tag", "css_class", "css_id", "role", *flags, "mark_step", "mark_level", *carry]
    pieces = "array_join(transform(array_sort(collect_list(_piece)), p -> p.markup), '') AS body"
    return (
        numbered.groupBy("page_id", "_block")
        .agg(
            F.expr(pieces),
            *[F.expr(f"first(CASE WHEN _is_block THEN {c} END, true) AS {c}") for c in own],
            F.expr("coalesce(first(CASE WHEN _is_block THEN in_pruned END, true), false) AS in_pruned"),
            F.expr("cast(sum(mark_copies) AS int) AS mark_copies"),
        )
        .withColumnRenamed("_block", "pos")
    )


def page_blocks(
    pages: DataFrame,
    selector: str | None = None,
    carry: Sequence[str] = (),
    co_located: bool = False,
) -> DataFrame:
    """Block-grain rows of every page with their regions, pruned on request."""
    if selector is None:
        return region_state(block_tokens(pages, carry, co_located=co_located), nested=True)
    return prune_blocks(pages, selector, carry, co_located)
