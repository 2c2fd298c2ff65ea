"""The registered queries once more, as plain SQL for another engine.

Patterns, word lists and source ranks are shared fixed values; the logic is
written again, relationally, so that a mistake on one side shows as a
difference.  Every text is one statement built from named common tables.
"""

from __future__ import annotations

from pagewinnow.catalog import fixtures as X
from pagewinnow.catalog.queries import (
    DATE_OVERRIDE,
    MAX_BLOCK_PAGES,
    OPTION_SETS,
    SIZE_CAP,
)
from pagewinnow.functions import patterns
from pagewinnow.operators import blocks as B
from pagewinnow.operators import metadata as M
from pagewinnow.operators.links import FURNITURE_IMAGE
from pagewinnow.operators.markup import FLAGS as REGION_NAMES


class _Patterns:
    """The tag patterns for a matcher without possessive repetition, which needs none to be linear."""

    def __getattr__(self, name: str):
        found = getattr(patterns, name)
        plain = lambda x: x.replace("*+", "*").replace("++", "+").replace("?+", "?") if isinstance(x, str) else x
        return (lambda *a: plain(found(*a))) if callable(found) else plain(found)


P = _Patterns()
FLAGS = ", ".join(f"in_{r}" for r in REGION_NAMES)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def names(words) -> str:
    return ", ".join(lit(w) for w in words)


def with_tables(tables: list[tuple[str, str]], final: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({body})" for name, body in tables) + "\n" + final


# -- expressions -----------------------------------------------------------


def squash(x: str) -> str:
    return f"trim(regexp_replace({x}, {lit(P.BLANKS)}, ' ', 'g'))"


def unescape(x: str) -> str:
    """The references that occur in the tables; the ampersand last."""
    for reference, char in P.ENTITIES:
        if reference in ("&lt;", "&gt;", "&quot;", "&copy;", "&middot;", "&amp;"):
            x = f"replace({x}, {lit(reference)}, {lit(char)})"
    return x


def bare(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace({x}, {lit(P.LINE_BREAK)}, ' ', 'g'), {lit(P.ANY_TAG)}, '', 'g')"
    )


def plain(x: str) -> str:
    return squash(unescape(bare(x)))


def attribute(tag: str, name: str) -> str:
    """All attributes of the tag as a list; of the first with the name, what stands behind its sign."""
    blank, some = "[ \\t\\r\\n\\f]", "[^ \\t\\r\\n\\f>]+"
    one = rf"""[^ \t\r\n\f/>=]+(?:{blank}*={blank}*(?:"[^"]*"|'[^']*'|{some}))?"""
    named = f"list_filter(regexp_extract_all({tag}, {lit(one)}, 0), lambda a: regexp_matches(a, {lit(f'(?i)^(?:{name}){blank}*=')}))"
    value = f"regexp_replace(coalesce({named}[1], ''), {lit(f'^[^=]*={blank}*')}, '')"
    return f"regexp_replace({value}, {lit(DELIMITED)}, '\\1\\2')"


DELIMITED = """(?s)^(?:"([^"]*)"|'([^']*)')$"""


def host(url: str) -> str:
    return f"nullif(lower(regexp_extract({url}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '')"


def origin(url: str) -> str:
    return f"regexp_extract({url}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1)"


def resolve(target: str, base: str) -> str:
    return (
        f"CASE WHEN regexp_matches({target}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {target} "
        f"WHEN starts_with({target}, '//') THEN regexp_extract({base}, '^([^:/]+:)', 1) || {target} "
        f"WHEN starts_with({target}, '/') THEN {origin(base)} || {target} END"
    )


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}]+'), lambda w: w <> '')"


def hits(list_: str, vocabulary) -> str:
    return f"len(list_filter({list_}, lambda w: w IN ({names(vocabulary)})))"


def sha(x: str) -> str:
    return f"sha256({x})"


def clean(html: str) -> str:
    return f"regexp_replace({html} || {lit(P.CLOSING_TAIL)}, {lit(P.DROPPED)}, '', 'g')"


# an anchor and its text: quoted values first, whatever they hold
ANCHOR = r"""(?is)<a(?:\s(?:[^<>"']|"[^"]*"|'[^']*')*)?>(.*?)</a"""

# -- shared tables ---------------------------------------------------------

PLAIN_PAGES = ("src", "SELECT page_id, url, html FROM pages")
INJECTED = ("src", f"SELECT page_id, url, {X.INJECTED} AS html FROM pages")
WRAPPED = ("src", f"SELECT page_id, url, {X.WRAPPED} AS html FROM pages")
BASES = (
    "bases",
    "SELECT page_id, CASE WHEN page_id % 5 <> 0 THEN 'https://gazette.example.com/p/' || page_id ELSE url END AS base FROM pages",
)
UNSTRUCTURED = ("src", f"SELECT page_id, url, {X.UNSTRUCTURED} AS html FROM pages")


def tag_grain() -> list[tuple[str, str]]:
    return [
        ("listed", f"SELECT page_id, regexp_extract_all({clean('html')}, {lit(P.TOKEN)}, 0) AS l FROM src"),
        ("flat", "SELECT page_id, unnest(l) AS token, (generate_subscripts(l, 1) - 1)::INTEGER AS pos FROM listed"),
        ("tagged", "SELECT *, regexp_matches(token, '^<[a-zA-Z/!?]') AS is_tag FROM flat"),
        (
            "tok",
            "SELECT page_id, pos, token, is_tag, is_tag AND starts_with(token, '</') AS closing, "
            "CASE WHEN is_tag THEN lower(regexp_extract(token, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) ELSE '' END AS tag, "
            "CASE WHEN is_tag THEN token ELSE '' END AS attrs FROM tagged",
        ),
    ]


def block_grain(html: str = "html", every_tag: bool = False) -> list[tuple[str, str]]:
    mark = "chr(1) || '\\1' || chr(2) || '\\2' || chr(2) || '\\3' || chr(2)"
    return [
        (
            "listed",
            f"SELECT page_id, string_split(chr(2) || chr(2) || chr(2) || regexp_replace({clean(html)}, "
            f"{lit(P.block_tag(None) if every_tag else P.block_tag())}, {mark}, 'g'), chr(1)) AS l FROM src",
        ),
        ("flat", "SELECT page_id, unnest(l) AS seg, (generate_subscripts(l, 1) - 1)::INTEGER AS pos FROM listed"),
        ("parted", "SELECT page_id, pos, string_split(seg, chr(2)) AS p FROM flat"),
        (
            "tok",
            "SELECT page_id, pos, p[1] = '/' AS closing, lower(p[2]) AS tag, p[3] AS attrs, p[4] AS body FROM parted",
        ),
    ]


def regions(pruned: str | None = None) -> list[tuple[str, str]]:
    unpaired = names((*P.VOID_TAGS, "html", "body", "head", ""))
    word = "(' ' || css_class || ' ' || css_id || ' ')"
    m = lambda pattern: f"regexp_matches({word}, {lit(pattern)})"
    opened = {
        "content": f"tag IN ('article', 'main') OR role = 'main' OR {m(P.CONTENT_WORDS)}",
        "furniture": "tag IN ('nav', 'footer', 'aside', 'menu', 'dialog')",
        "wrapper": m(P.CHROME_WORDS),
        "header": "tag = 'header'",
        "table": "tag = 'table'",
        "comments": m(P.COMMENT_WORDS),
        "teaser": m(P.TEASER_WORDS),
        "bottom": m(P.BOTTOM_WORDS),
    }
    if pruned is not None:
        opened["pruned"] = pruned
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    opens = ", ".join(
        f"coalesce(NOT closing AND tag NOT IN ({unpaired}) AND ({test}), false) AS o_{r}"
        for r, test in opened.items()
    )
    plain = [r for r in opened if r != "wrapper"]
    inside = ", ".join(f"bool_or(c.o_{r}) AS i_{r}" for r in plain)
    flags = ", ".join(f"coalesce(i_{r}, false) AS in_{r}" for r in plain)
    by_tag = f"OVER (PARTITION BY page_id, tag ORDER BY pos {so_far})"
    css = ", ".join(
        f"CASE WHEN contains(attrs, '=') THEN lower({attribute(chr(39) + ' ' + chr(39) + ' || attrs', a)}) ELSE '' END AS {n}"
        for a, n in (("class", "css_class"), ("id", "css_id"), ("role", "role"))
    )
    return [
        ("styled", f"SELECT *, {css} FROM tok"),
        ("opened", f"SELECT *, {opens} FROM styled"),
        (
            "summed",
            f"SELECT *, sum(CASE WHEN tag IN ({unpaired}) THEN 0 WHEN closing THEN -1 ELSE 1 END) {by_tag} AS s FROM opened",
        ),
        ("lowest", f"SELECT *, min(s) {by_tag} AS low FROM summed"),
        (
            "levelled",
            f"SELECT *, CASE WHEN tag IN ({names(P.OPTIONAL_END_TAGS)}) THEN 1 "
            "WHEN closing THEN s - least(0, low) + 1 ELSE s - least(0, low) END AS lvl FROM lowest",
        ),
        # an element lasts until the next tag of its name on its level, or to the end
        (
            "intervals",
            "SELECT *, coalesce(lead(pos) OVER (PARTITION BY page_id, tag, lvl ORDER BY pos), 2147483647) AS until FROM levelled",
        ),
        ("containers", f"SELECT * FROM intervals WHERE {' OR '.join(f'o_{r}' for r in opened)}"),
        (
            "surrounded",
            f"SELECT t.page_id, t.pos, {inside}, max(c.pos) FILTER (c.o_content) AS content_from, "
            "max(c.pos) FILTER (c.o_wrapper) AS wrapper_from FROM levelled t JOIN containers c "
            "ON c.page_id = t.page_id AND c.pos <= t.pos AND t.pos < c.until GROUP BY t.page_id, t.pos",
        ),
        (
            "placed",
            f"SELECT l.*, {flags}, coalesce(i_furniture OR wrapper_from >= coalesce(content_from, -1), false) AS in_chrome "
            "FROM levelled l LEFT JOIN surrounded USING (page_id, pos)",
        ),
    ]


def block_rows(source: tuple[str, str] = INJECTED) -> list[tuple[str, str]]:
    balance = (
        f"len(regexp_extract_all(body, {lit(P.ANCHOR_OPEN)})) - len(regexp_extract_all(body, {lit(P.ANCHOR_CLOSE)}))"
    )
    scope = "(CASE WHEN is_open THEN '<a>' ELSE '' END || body || '</a>')"
    linked = f"array_to_string(regexp_extract_all({scope}, {lit(ANCHOR)}, 1), ' ')"
    return [
        source,
        *block_grain(),
        *regions(),
        ("balanced", f"SELECT *, CASE WHEN ({balance}) <> 0 THEN ({balance}) > 0 END AS change FROM placed"),
        (
            "anchored",
            "SELECT *, coalesce(last_value(change IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_open FROM balanced",
        ),
        (
            "blk",
            "SELECT page_id, pos AS block_no, CASE WHEN closing OR tag = '' THEN 'p' ELSE tag END AS tag, "
            f"{FLAGS}, css_class, body, CASE WHEN tag = 'title' THEN '' ELSE {plain('body')} END AS text, "
            f"CASE WHEN tag <> 'title' AND (is_open OR regexp_matches(body, '</?[aA]')) THEN length({plain(linked)})::INTEGER ELSE 0 END AS link_chars "
            "FROM anchored",
        ),
        ("blks", "SELECT *, length(text)::INTEGER AS n_chars FROM blk"),
    ]


def features() -> tuple[str, str]:
    return (
        "feats",
        "SELECT *, CASE WHEN n_chars > 0 THEN link_chars / n_chars ELSE 0.0 END AS link_density, "
        "CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0.0 END AS stop_density FROM ("
        f"SELECT *, len(ws)::INTEGER AS n_words, {hits('ws', B.ALL_STOP_WORDS)}::INTEGER AS n_stop FROM "
        f"(SELECT *, {words('text')} AS ws FROM blks))",
    )


def focus_table() -> tuple[str, str]:
    rows = ", ".join(
        f"('{f}', {c}, {l}::DOUBLE, {str(t).lower()}, {str(b).lower()})"
        for f, (c, l, t, b) in B.THRESHOLDS.items()
    )
    return ("levels", f"SELECT * FROM (VALUES {rows}) v(focus, min_chars, max_links, teasers, bottoms)")


def labelled(source: str = "feats") -> list[tuple[str, str]]:
    return [
        focus_table(),
        (
            "lab",
            "SELECT *, CASE WHEN n_chars = 0 THEN 'blank' WHEN link_density > max_links THEN 'bad' "
            "WHEN n_chars >= min_chars THEN 'good' "
            f"WHEN tag IN ({names(P.HEADING_TAGS)}) THEN 'near' "
            "WHEN n_chars * 2 >= min_chars AND n_stop > 0 THEN 'near' ELSE 'short' END AS label "
            f"FROM {source} CROSS JOIN levels",
        ),
    ]


def smoothed() -> list[tuple[str, str]]:
    decided = "CASE WHEN label IN ('good', 'bad') THEN label END"
    over = "OVER (PARTITION BY focus, page_id ORDER BY block_no ROWS BETWEEN"
    return [
        (
            "sides",
            f"SELECT *, coalesce(last_value({decided} IGNORE NULLS) {over} UNBOUNDED PRECEDING AND 1 PRECEDING), 'bad') AS before, "
            f"coalesce(first_value({decided} IGNORE NULLS) {over} 1 FOLLOWING AND UNBOUNDED FOLLOWING), 'bad') AS after FROM lab",
        ),
        (
            "smooth",
            "SELECT *, label = 'good' OR (label = 'near' AND (before = 'good' OR after = 'good')) "
            "OR (label = 'short' AND before = 'good' AND after = 'good') AS keep FROM sides",
        ),
    ]


def line_kept(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[ \\t]*\\r?\\n', ''), '[ \\t\\r\\n]+$', '')"


def inner_html(links: str = "links", images: str = "images") -> str:
    """Inline markup, with anchors and images kept by the option columns."""
    keep = "chr(4) || '\\1' || chr(5)"
    x = f"CASE WHEN {links} THEN regexp_replace(rel, {lit(P.KEPT_LINK)}, chr(6) || '\\1' || chr(7), 'g') ELSE rel END"
    x = f"CASE WHEN {images} THEN regexp_replace({x}, {lit(P.KEPT_IMAGE)}, {keep}, 'g') ELSE {x} END"
    x = f"regexp_replace({x}, {lit(P.LINE_BREAK)}, ' ', 'g')"
    x = f"regexp_replace({x}, {lit(P.MARK_TAG)}, chr(6) || '\\1\\2' || chr(7), 'g')"
    x = f"regexp_replace({x}, {lit(P.ANY_TAG)}, '', 'g')"
    shown = f"translate(regexp_replace({matched_marks(x)}, {lit(P.MARKED)}, '', 'g'), chr(4) || chr(5), '<>')"
    return f"CASE WHEN tag = 'pre' THEN {line_kept(shown)} ELSE {squash(shown)} END"


def matched_marks(x: str) -> str:
    """Name by name, so that no pattern has to refer to what it found; the tables nest two names at most."""
    open_, close = "\x06", "\x07"
    for _ in range(2):
        for name in (*P.INLINE_MARKS, "a"):
            pair = f"(?i){open_}{name}((?:[ \\t\\r\\n\\f][^{open_}{close}]*)?){close}([^{open_}{close}]*){open_}/{name}[ \\t\\r\\n\\f]*{close}"
            shown = f"chr(4) || '{name}\\1' || chr(5) || '\\2' || chr(4) || '/{name}' || chr(5)"
            x = f"regexp_replace({x}, {lit(pair)}, {shown}, 'g')"
    return x


def brackets() -> list[tuple[str, str]]:
    """Lists, tables, closed rows and quotations as intervals of one nesting."""
    page = "(PARTITION BY page_id ORDER BY pos)"
    alike = "(PARTITION BY page_id, tag ORDER BY pos)"
    named = names(t for t in P.NESTING_TAGS if t != "tr")
    return [
        (
            "stepped",
            f"SELECT *, CASE WHEN tag IN ({named}) THEN CASE WHEN closing THEN -1 ELSE 1 END "
            f"WHEN tag = 'tr' AND closing AND NOT lag(closing) OVER {alike} THEN -1 "
            f"WHEN tag = 'tr' AND NOT closing AND lead(closing) OVER {alike} THEN 1 ELSE 0 END AS step FROM placed",
        ),
        ("summed_steps", f"SELECT *, sum(step) OVER {page} AS st FROM stepped"),
        (
            "stacked",
            f"SELECT *, st - least(0, min(st) OVER {page}) + CASE WHEN step < 0 THEN 1 ELSE 0 END AS stack FROM summed_steps",
        ),
        (
            "brackets",
            "SELECT * FROM (SELECT *, coalesce(lead(pos) OVER (PARTITION BY page_id, stack ORDER BY pos), 2147483647) AS ending "
            "FROM stacked WHERE step <> 0) WHERE step > 0",
        ),
    ]


def streams(option_rows: str, min_chars: int = 250, base: str | None = None) -> list[tuple[str, str]]:
    """Four streams per option row and page; the fallback pass is separate."""
    allowed = "(NOT in_teaser OR teasers) AND (NOT in_bottom OR bottoms) AND (NOT in_table OR NOT no_tables)"
    seen = "(n_chars > 0 OR (images AND tag <> 'title' AND regexp_matches(body, '(?i)<img[ \\t\\r\\n\\f/]')))"
    name = f"CASE WHEN tag IN ({names(P.OUTPUT_TAGS)}) THEN tag ELSE 'div' END"
    if base is None:
        rel = "body"
    else:
        attr = r"""(?i)([ \t\r\n\f](?:href|src)[ \t\r\n\f]*=[ \t\r\n\f]*["'])"""
        rel = (
            f"CASE WHEN links OR images THEN replace(regexp_replace(regexp_replace(body, {lit(attr + '//')}, "
            f"'\\1' || regexp_extract({base}, '^([^:/]+:)', 1) || '//', 'g'), "
            f"{lit(attr + '/([^/])')}, '\\1@ORIGIN@/\\2', 'g'), '@ORIGIN@', {origin(base)}) ELSE body END"
        )
    join = "" if base is None else " JOIN bases USING (page_id)"
    agg = lambda col, flag, sep: (
        f"coalesce(string_agg({col}, {sep} ORDER BY block_no) FILTER ({flag} AND {col} <> ''), '')"
    )
    return [
        focus_table(),
        ("opts", option_rows),
        (
            "labelled_blocks",
            f"SELECT o.option_id, blks.*, links, images, {rel} AS rel, "
            f"{seen} AND in_content AND NOT in_chrome AND NOT in_comments AND {allowed} AS k_main, "
            f"{seen} AND NOT in_chrome AND (NOT in_header OR in_content) AND NOT in_comments AND {allowed} AS k_base, "
            f"{seen} AND NOT in_furniture AND (NOT in_header OR in_content) AND NOT in_comments AND {allowed} AS k_loose, "
            f"{seen} AND in_comments AND NOT no_comments AS k_comment "
            f"FROM blks CROSS JOIN opts o JOIN levels USING (focus){join}",
        ),
        ("inners", f"SELECT *, {inner_html()} AS inside FROM labelled_blocks"),
        ("elements", f"SELECT *, '<' || {name} || '>' || inside || '</' || {name} || '>' AS html FROM inners"),
        *brackets(),
        (
            "nests",
            f"SELECT option_id, n.page_id, n.pos, n.tag, n.ending, n.stack, in_content AND NOT in_chrome AND NOT in_comments AND {allowed} AS k_main, "
            "in_comments AND NOT no_comments AS k_comment FROM brackets n CROSS JOIN opts o JOIN levels USING (focus)",
        ),
        # an element stays where it holds a block that stays
        (
            "holding",
            "SELECT n.option_id, n.page_id, n.pos, n.tag, n.ending, n.stack, bool_or(n.k_main AND e.k_main) AS k_main, "
            "bool_or(n.k_comment AND e.k_comment) AS k_comment FROM nests n JOIN elements e ON e.option_id = n.option_id "
            "AND e.page_id = n.page_id AND e.block_no >= n.pos AND e.block_no < n.ending GROUP BY 1, 2, 3, 4, 5, 6",
        ),
        (
            "events",
            "SELECT option_id, page_id, block_no AS pos, 1 AS part, 0 AS place, html, k_main, k_comment FROM elements "
            "UNION ALL SELECT option_id, page_id, pos, 0, 0, '<' || tag || '>', k_main, k_comment FROM holding "
            "UNION ALL SELECT option_id, page_id, ending, 0, -stack, '</' || tag || '>', k_main, k_comment FROM holding",
        ),
        (
            "htmls",
            "SELECT option_id, page_id, coalesce(string_agg(html, '' ORDER BY pos, part, place) FILTER (k_main), '') AS main_html, "
            "coalesce(string_agg(html, '' ORDER BY pos, part, place) FILTER (k_comment), '') AS comments_html FROM events GROUP BY 1, 2",
        ),
        (
            "gathered",
            f"SELECT option_id, page_id, {agg('text', 'k_main', 'chr(10)')} AS main_text, any_value(main_html) AS main_html, "
            f"{agg('text', 'k_base', 'chr(10)')} AS strict_text, {agg('text', 'k_loose', 'chr(10)')} AS loose_text, "
            f"{agg('text', 'k_comment', 'chr(10)')} AS comments_text, "
            "any_value(comments_html) AS comments_html FROM elements JOIN htmls USING (option_id, page_id) GROUP BY option_id, page_id",
        ),
        (
            "judged_pages",
            f"SELECT *, length(main_text) < {min_chars} AND length(base_text) > length(main_text) AS rescued FROM (SELECT *, "
            f"CASE WHEN main_text = '' AND strict_text = '' AND length(loose_text) >= {min_chars} THEN loose_text ELSE strict_text END AS base_text FROM gathered)",
        ),
        (
            "result",
            "SELECT option_id, page_id, rescued, CASE WHEN rescued THEN base_text ELSE main_text END AS content_text, comments_text, "
            "CASE WHEN rescued THEN '<p>' || replace(replace(replace(replace(base_text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), ' ') || '</p>' "
            "ELSE main_html END AS content_html, comments_html FROM judged_pages",
        ),
    ]


def option_row(i: int, o) -> str:
    flags = (o.exclude_comments, o.exclude_tables, o.include_links, o.include_images)
    return f"({i}, '{o.focus}', {', '.join(str(f).lower() for f in flags)})"


def option_table(*option_sets) -> str:
    rows = ", ".join(option_row(i, o) for i, o in enumerate(option_sets))
    return f"SELECT * FROM (VALUES {rows}) v(option_id, focus, no_comments, no_tables, links, images)"


def one_run(final: str, source=INJECTED, min_chars: int = 250, **options) -> str:
    from pagewinnow.options import ExtractOptions

    table = option_table(ExtractOptions(**options))
    return with_tables([*block_rows(source), *streams(table, min_chars)], final)


def pruned_blocks() -> list[tuple[str, str]]:
    """Blocks cut at every tag, blanked inside matches, joined per block tag."""
    match = "contains(' ' || css_class || ' ', ' ad ') OR tag IN ('h1', 'a')"
    block = f"(tag IN ({names(P.BLOCK_TAGS)}) OR pos = 0)"
    inline = f"CASE WHEN {block} THEN '' ELSE '<' || CASE WHEN closing THEN '/' ELSE '' END || tag || attrs || '>' END"
    return [
        PLAIN_PAGES,
        *block_grain(every_tag=True),
        *regions(match),
        (
            "pieces",
            f"SELECT page_id, pos, CASE WHEN in_pruned THEN '' ELSE {inline} || body END AS piece, "
            f"CASE WHEN {block} THEN CASE WHEN closing OR tag = '' THEN 'p' ELSE tag END END AS own_tag, "
            f"max(CASE WHEN {block} THEN pos END) OVER (PARTITION BY page_id ORDER BY pos) AS block_no FROM placed",
        ),
        (
            "joined",
            "SELECT page_id, block_no, max(own_tag) AS tag, string_agg(piece, '' ORDER BY pos) AS body FROM pieces GROUP BY page_id, block_no",
        ),
        ("texts", f"SELECT page_id, block_no, tag, CASE WHEN tag = 'title' THEN '' ELSE {plain('body')} END AS text FROM joined"),
    ]


def second_pass(source: tuple[str, str] = UNSTRUCTURED) -> list[tuple[str, str]]:
    """Main, baseline and statistical pass side by side, with their scores."""
    allowed = "(NOT in_teaser OR teasers) AND (NOT in_bottom OR bottoms)"
    texts = lambda flag: f"coalesce(string_agg(text, chr(10) ORDER BY block_no) FILTER ({flag} AND text <> ''), '')"
    score = lambda flag: f"greatest(coalesce(sum(n_chars - link_chars) FILTER ({flag}), 0), 0)"
    return [
        *block_rows(source),
        features(),
        *labelled(),
        *smoothed(),
        (
            "passes",
            f"SELECT *, n_chars > 0 AND in_content AND NOT in_chrome AND NOT in_comments AND {allowed} AS k_main, "
            f"n_chars > 0 AND NOT in_chrome AND (NOT in_header OR in_content) AND NOT in_comments AND {allowed} AS k_base, "
            f"n_chars > 0 AND NOT in_furniture AND (NOT in_header OR in_content) AND NOT in_comments AND {allowed} AS k_loose, "
            f"keep AND NOT in_comments AND {allowed} AS k_second FROM smooth WHERE focus = 'balanced'",
        ),
        (
            "scored",
            f"SELECT page_id, {texts('k_main')} AS m, {texts('k_base')} AS strict, {texts('k_loose')} AS loose, {texts('k_second')} AS s, "
            f"{score('k_main')} AS ms, {score('k_second')} AS ss FROM passes GROUP BY page_id",
        ),
        ("picked", "SELECT *, CASE WHEN (ms < 250 OR ss > 2 * ms) AND ss > ms THEN 'second' ELSE 'main' END AS chosen FROM scored"),
        ("shown", "SELECT *, CASE WHEN chosen = 'second' THEN s ELSE m END AS t FROM picked"),
        ("based", "SELECT *, CASE WHEN t = '' AND strict = '' AND length(loose) >= 250 THEN loose ELSE strict END AS b FROM shown"),
        ("rescues", "SELECT *, length(t) < 250 AND length(b) > length(t) AS rescued FROM based"),
    ]


# -- metadata --------------------------------------------------------------


def linked_data() -> list[tuple[str, str]]:
    """Linked-data items, and the names that references between them lead to, step by step."""
    earliest = lambda c: f"arg_min({c}, place) FILTER ({c} IS NOT NULL)"
    return [
        (
            "ld_list",
            "SELECT page_id, list_concat([j::JSON], coalesce(json_extract(j, '$.\"@graph\"[*]'), [])) AS l FROM ld WHERE j <> ''",
        ),
        ("ld_nodes", "SELECT page_id, unnest(l) AS node, generate_subscripts(l, 1) AS i FROM ld_list"),
        (
            "ld_named",
            "SELECT page_id, json_extract_string(node, '$.\"@id\"') AS id, json_extract(node, '$.name') AS name FROM ld_nodes "
            "WHERE json_extract(node, '$.\"@id\"') IS NOT NULL AND json_extract(node, '$.name') IS NOT NULL",
        ),
        (
            "ld_walk",
            "SELECT page_id, id AS start, name, [id] AS path FROM ld_named UNION ALL "
            "SELECT w.page_id, w.start, n.name, list_append(w.path, n.id) FROM ld_walk w JOIN ld_named n "
            "ON n.page_id = w.page_id AND n.id = json_extract_string(w.name, '$.\"@id\"') WHERE NOT list_contains(w.path, n.id)",
        ),
        (
            "ld_resolved",
            "SELECT page_id, start AS id, any_value(json_extract_string(name, '$')) AS value FROM ld_walk "
            "WHERE json_type(name) = 'VARCHAR' GROUP BY page_id, start",
        ),
        (
            "ld_people",
            "SELECT page_id, i, k, unnest(l) AS a FROM (SELECT page_id, i, unnest([1]) AS k, CASE json_type(json_extract(node, '$.author')) "
            "WHEN 'ARRAY' THEN json_extract(node, '$.author[*]') ELSE [json_extract(node, '$.author')] END AS l FROM ld_nodes)",
        ),
        (
            "ld_authors",
            "SELECT p.page_id, p.i, nullif(string_agg(coalesce(json_extract_string(a, '$.name'), r.value), '; '), '') AS author "
            "FROM ld_people p LEFT JOIN ld_resolved r ON r.page_id = p.page_id AND r.id = json_extract_string(a, '$.\"@id\"') GROUP BY 1, 2",
        ),
        (
            "ld_items",
            "SELECT page_id, CASE WHEN regexp_matches(coalesce(json_extract_string(node, '$.\"@type\"'), ''), 'Article') THEN 0 ELSE 1000 END + i AS place, "
            "json_extract_string(node, '$.headline') AS title, author, json_extract_string(node, '$.datePublished') AS date, "
            "json_extract_string(node, '$.\"@type\"') AS type FROM ld_nodes LEFT JOIN ld_authors USING (page_id, i)",
        ),
        (
            "linked",
            f"SELECT page_id, {', '.join(f'{earliest(c)} AS {c}' for c in ('title', 'author', 'date', 'type'))} FROM ld_items GROUP BY page_id",
        ),
    ]


def metadata_tables(
    source: tuple[str, str] = INJECTED, supplied: str = "url", override: str | None = None
) -> list[tuple[str, str]]:
    ranks = ", ".join(f"({lit(s)}, '{f}', {r})" for s, f, r in M.RANKED)
    ld_names = {"headline": "title", "author": "author", "datePublished": "date", "@type": "type"}
    ld = " UNION ALL ".join(f"SELECT page_id, 0, {lit('ld:' + n)}, {column} FROM linked" for n, column in ld_names.items())
    iso = "regexp_replace(regexp_replace(value, '^\\s*(\\d{4})[-/](\\d{2})[-/](\\d{2})(?:$|[^0-9].*)', '\\1-\\2-\\3'), '^\\s*(\\d{4})(\\d{2})(\\d{2})(?:$|[T\\s].*)', '\\1-\\2-\\3')"
    # the two spelled-out shapes of the tables
    english, german = "^\\s*[A-Za-z]+, ([A-Z][a-z]+) (\\d+)th, (\\d{4})$", "^\\s*(\\d+)\\. (\\S+) (\\d{4})$"
    month = "CASE lower({}) WHEN 'march' THEN 3 WHEN 'märz' THEN 3 END".format
    got = lambda p, i: f"regexp_extract(value, {lit(p)}, {i})"
    spelled = " ".join(
        f"WHEN regexp_matches(value, {lit(p)}) THEN make_date({got(p, 3)}::INT, {month(got(p, m))}, {got(p, d)}::INT)" for p, m, d in ((english, 1, 2), (german, 2, 1))
    )
    day = f"CASE WHEN regexp_matches({iso}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_cast({iso} AS DATE) {spelled} END"
    pick = lambda f: f"max(value) FILTER (field = '{f}')"
    scalars = [f for f in M.FIELDS if f not in ("date", "hostname", "categories", "tags")]
    return [
        source,
        ("heads", f"SELECT page_id, url, html, {clean('html')} AS head FROM src"),
        ("metas", f"SELECT page_id, regexp_extract_all(head, {lit(P.named_tag('meta'))}, 0) AS l FROM heads"),
        ("meta_flat", "SELECT page_id, unnest(l) AS t, generate_subscripts(l, 1) AS i FROM metas"),
        (
            "meta_keyed",
            f"SELECT page_id, i, trim(lower({attribute('t', 'property|name|itemprop|http-equiv')})) AS key, "
            f"{attribute('t', 'content')} AS value FROM meta_flat",
        ),
        (
            "pairs",
            "SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INTEGER AS pos, key, "
            f"{squash(unescape('value'))} AS value FROM meta_keyed WHERE key <> ''",
        ),
        ("ld", f"SELECT page_id, regexp_extract(html, {lit(P.JSON_LD)}, 1) AS j FROM src"),
        *linked_data(),
        ("ranks", f"SELECT * FROM (VALUES {ranks}) v(source, field, rank)"),
        (
            "elements_found",
            f"SELECT page_id, 0 AS pos, 'dom:title' AS source, regexp_extract(head, {lit(M._TITLE)}, 1) AS value FROM heads "
            f"UNION ALL SELECT page_id, 0, 'dom:h1', {bare('regexp_extract(html, ' + lit(M._H1) + ', 1)')} FROM heads "
            f"UNION ALL SELECT page_id, 0, 'dom:lang', {attribute('regexp_extract(html, ' + lit(P.named_tag('html')) + ', 0)', 'lang')} FROM heads "
            f"UNION ALL SELECT page_id, 0, 'dom:time', CASE WHEN contains(t, 'datetime') THEN {attribute('t', 'datetime')} ELSE x END FROM ("
            f"SELECT page_id, regexp_extract(head, {lit('<time[^>]*>')}, 0) AS t, regexp_extract(head, {lit('<time[^>]*>([^<]*)</time>')}, 1) AS x FROM heads) "
            f"UNION ALL {ld}",
        ),
        (
            "cands",
            "SELECT page_id, field, rank, pos, value FROM ("
            "SELECT page_id, pos, key AS source, value FROM pairs WHERE key NOT LIKE 'dom:%' AND key NOT LIKE 'ld:%' "
            f"UNION ALL SELECT page_id, pos, source, {squash(unescape('value'))} FROM elements_found) "
            "JOIN ranks USING (source) WHERE regexp_matches(value, '\\S')",
        ),
        (
            "won",
            "SELECT page_id, field, arg_min(value, rank * 100000 + pos) AS value FROM cands WHERE field <> 'date' GROUP BY page_id, field",
        ),
        ("days", f"SELECT page_id, rank, pos, {day} AS d FROM cands WHERE field = 'date'"),
        (
            "dated",
            "SELECT page_id, arg_min(d, rank * 100000 + pos) AS d FROM days "
            "WHERE year(d) BETWEEN 1995 AND year(current_date) + 1 GROUP BY page_id",
        ),
        ("wide", f"SELECT page_id, {', '.join(f'{pick(f)} AS m_{f}' for f in (*scalars, 'tags'))} FROM won GROUP BY page_id"),
        (
            "placed_meta",
            f"SELECT src.page_id, wide.*, d, coalesce(m_url, {supplied}) AS u FROM src LEFT JOIN wide USING (page_id) LEFT JOIN dated USING (page_id)",
        ),
        (
            "meta",
            "SELECT page_id, m_title AS title, m_author AS author, u AS url, "
            f"{host('u')} AS hostname, m_description AS description, m_sitename AS sitename, "
            f"{'d' if override is None else override} AS date, '' AS categories, "
            "coalesce(array_to_string(list_filter(list_transform(string_split(m_tags, ','), lambda x: trim(x)), lambda x: x <> ''), '|'), '') AS tags, "
            "m_license AS license, lower(m_language) AS language, "
            f"CASE WHEN u IS NULL THEN m_image ELSE coalesce({resolve('m_image', 'u')}, m_image) END AS image, "
            "m_page_type AS page_type FROM placed_meta",
        ),
    ]


def meta_query(final: str, **kw) -> str:
    return with_tables(metadata_tables(**kw), final)


# -- truth and scores ------------------------------------------------------


def truth_tables() -> list[tuple[str, str]]:
    inside = f"unnest(regexp_extract_all(html, {lit(X.ARTICLE)}, 1))"
    outside = " UNION ALL ".join(f"SELECT page_id, 'without', unnest(regexp_extract_all(html, {lit(o)}, 1)) FROM pages" for o in X.OUTSIDE)
    return [
        ("articles", f"SELECT page_id, {inside} AS a FROM pages"),
        ("cut", f"SELECT page_id, 'with' AS kind, unnest(regexp_split_to_array(regexp_replace(a, {lit(X.HEADING)}, '<p>', 'g'), {lit(X.BREAKS)})) AS s FROM articles UNION ALL {outside}"),
        ("readable", f"SELECT page_id, kind, {plain('s')} AS snippet FROM cut"),
        ("truth", "SELECT DISTINCT page_id, kind, snippet FROM readable WHERE snippet <> ''"),
    ]


def normal(text: str, host_: str) -> str:
    return squash(f"replace(lower({text}), coalesce({host_}, ''), '')")


def hashed_blocks(scope: str = "") -> list[tuple[str, str]]:
    return [
        (
            "hosted",
            f"SELECT f.*, {host('p.url')} AS host FROM feats f JOIN pages p USING (page_id)",
        ),
        ("normed", f"SELECT *, {normal('text', 'host')} AS norm FROM hosted"),
        ("freq", f"SELECT norm{scope}, count(DISTINCT page_id) AS df FROM normed WHERE norm <> '' GROUP BY norm{scope}"),
    ]


def statistical_runs() -> list[tuple[str, str]]:
    return [
        *block_rows(PLAIN_PAGES),
        features(),
        *hashed_blocks(),
        ("uniq", f"SELECT n.* FROM normed n LEFT JOIN freq USING (norm) WHERE coalesce(df, 0) <= {MAX_BLOCK_PAGES}"),
        *labelled("uniq"),
        *smoothed(),
        (
            "called",
            with_tables(
                second_pass(PLAIN_PAGES),
                "SELECT page_id, CASE WHEN rescued THEN b ELSE t END AS fallback, CASE WHEN length(m) < 250 AND length(mb) > length(m) THEN mb ELSE m END AS plainly "
                "FROM (SELECT *, CASE WHEN m = '' AND strict = '' AND length(loose) >= 250 THEN loose ELSE strict END AS mb FROM rescues)",
            ),
        ),
        (
            "runs",
            "SELECT 'default' AS run, page_id, plainly AS content_text FROM called UNION ALL SELECT 'fallback', page_id, fallback FROM called UNION ALL "
            "SELECT focus AS run, page_id, string_agg(text, chr(10) ORDER BY block_no) AS content_text FROM smooth WHERE keep GROUP BY focus, page_id",
        ),
        *truth_tables(),
        (
            "judged",
            "SELECT l.run, t.*, coalesce(contains(content_text, snippet), false) AS found FROM truth t "
            "CROSS JOIN (SELECT focus AS run FROM levels UNION ALL VALUES ('default'), ('fallback')) l LEFT JOIN runs r ON r.page_id = t.page_id AND r.run = l.run",
        ),
        (
            "cells",
            "SELECT run, count(*) FILTER (kind = 'with' AND found) AS tp, count(*) FILTER (kind = 'with' AND NOT found) AS fn, "
            "count(*) FILTER (kind = 'without' AND found) AS fp, count(*) FILTER (kind = 'without' AND NOT found) AS tn FROM judged GROUP BY run",
        ),
    ]


F_SCORE = "2 * tp / (2 * tp + fp + fn)"


def strict_ledger() -> list[tuple[str, str]]:
    """All reasons at once; bytes are told from the text before damage."""
    stub = '<html><head><title>Stub</title><meta name="date" content="2020-01-01"></head></html>'
    copy = '<html lang="en"><head><title>Copy</title><meta name="date" content="2020-01-01"></head><body><p>The same body.</p></body></html>'
    source = (
        "src",
        "SELECT page_id, url, bad, n_bytes, CASE WHEN bad OR n_bytes > 9000 THEN '' ELSE h END AS html FROM ("
        "SELECT *, page_id % 10 = 3 AS bad, strlen(h) + CASE WHEN page_id % 10 = 3 THEN 1 ELSE 0 END AS n_bytes FROM ("
        f"SELECT page_id, url, CASE WHEN page_id % 10 = 3 THEN {X.INJECTED} WHEN page_id % 11 = 4 THEN {lit(stub)} "
        f"WHEN page_id % 13 = 5 THEN {lit(copy)} ELSE {X.INJECTED} END AS h FROM pages))",
    )
    from pagewinnow.options import ExtractOptions

    detected = (
        "SELECT page_id, first(lang ORDER BY n DESC, place) AS detected, max(n) AS n FROM ("
        + " UNION ALL ".join(
            f"SELECT page_id, {hits('ws', ws)} AS n, {i} AS place, '{l}' AS lang FROM body_words"
            for i, (l, ws) in enumerate(sorted(P.STOP_WORDS.items()))
        )
        + ") GROUP BY page_id"
    )
    meta = [(n, b) for n, b in metadata_tables(source) if n != "src"]
    return [
        *block_rows(source),
        *streams(option_table(ExtractOptions())),
        *meta,
        ("body_words", f"SELECT page_id, {words('content_text')} AS ws FROM result"),
        ("spoken", detected),
        (
            "facts",
            "SELECT src.*, r.content_text, r.comments_text, m.title, m.url AS doc_url, m.date, m.language, "
            "CASE WHEN n >= 2 THEN detected END AS detected FROM src JOIN result r USING (page_id) JOIN meta m USING (page_id) "
            "JOIN spoken USING (page_id)",
        ),
        (
            "owns",
            "SELECT *, CASE WHEN n_bytes > 9000 THEN 'input_too_large' WHEN bad THEN 'invalid_utf8' "
            "WHEN language <> 'en' THEN 'language_mismatch' "
            "WHEN title IS NULL OR doc_url IS NULL OR date IS NULL THEN 'missing_metadata' "
            "WHEN content_text = '' AND comments_text = '' THEN 'insufficient_content' END AS own FROM facts",
        ),
        (
            "reasons",
            "SELECT *, CASE WHEN own IS NOT NULL THEN own "
            "WHEN content_text <> '' AND page_id > min(page_id) OVER (PARTITION BY content_text, own IS NULL) THEN 'duplicate_content' "
            "WHEN detected <> 'en' THEN 'language_mismatch' END AS reason FROM owns",
        ),
        (
            "ledger",
            "SELECT page_id, url, CASE WHEN reason IS NULL THEN 'ok' ELSE 'refused' END AS outcome, reason, "
            "CASE WHEN reason = 'missing_metadata' THEN CASE WHEN title IS NULL THEN 'title' WHEN doc_url IS NULL THEN 'url' ELSE 'date' END "
            "WHEN reason = 'language_mismatch' AND (language = 'en' OR language IS NULL) THEN detected END AS reason_detail, "
            "CASE WHEN reason = 'invalid_utf8' THEN 10 END::BIGINT AS reason_offset FROM reasons",
        ),
    ]


def manifest_tables(flat: str = "flat_rows") -> list[tuple[str, str]]:
    lists = ("categories", "tags")
    cells = []
    for f in ("content_text", "comments_text", "content_html", "comments_html", *M.FIELDS):
        if f in lists:
            parts = f"CASE WHEN {f} = '' THEN [] ELSE string_split({f}, '|') END"
            cells.append(
                f"SELECT page_id, '{f}' AS field, strlen({f}) AS n_bytes, len({parts}) AS n_items, "
                f"CASE WHEN {f} <> '' THEN sha256(replace({f}, '|', chr(31))) END AS digest FROM {flat}"
            )
        else:
            v = f"cast({f} AS VARCHAR)"
            cells.append(
                f"SELECT page_id, '{f}' AS field, coalesce(strlen({v}), 0) AS n_bytes, "
                f"CASE WHEN {f} IS NULL THEN 0 ELSE 1 END AS n_items, sha256({v}) AS digest FROM {flat}"
            )
    return [("manifest", " UNION ALL ".join(cells))]


def full_tables(*option_sets) -> list[tuple[str, str]]:
    meta = [(n, b) for n, b in metadata_tables(INJECTED) if n != "src"]
    return [*block_rows(INJECTED), *streams(option_table(*option_sets)), *meta]


META_COLUMNS = ", ".join(M.FIELDS)


def edited_snapshot() -> list[tuple[str, str]]:
    """Stored results and their edited state, field by field as lists of lines."""
    from pagewinnow.options import ExtractOptions

    nl = "chr(10)"
    return [
        *full_tables(ExtractOptions()),
        ("a_side", "SELECT page_id, content_text AS body, string_split(content_text, chr(10)) AS ls, title FROM result JOIN meta USING (page_id)"),
        (
            "b_side",
            f"SELECT page_id + CASE WHEN page_id % 10 = 4 THEN 1000000000 ELSE 0 END AS page_id, "
            f"CASE WHEN page_id % 5 = 0 THEN array_to_string(list_reverse(ls), {nl}) "
            f"WHEN page_id % 5 = 1 THEN 'Added to page ' || page_id || {nl} || body || {nl} || ls[1] "
            f"WHEN page_id % 5 = 2 THEN array_to_string(ls[1:1] || ls[3:], {nl}) "
            f"WHEN page_id % 5 = 3 THEN array_to_string(ls[2:] || ls[1:1], {nl}) ELSE body END AS body, "
            "title || CASE WHEN page_id % 7 = 0 THEN ' (2)' ELSE '' END AS title FROM a_side",
        ),
    ]


def compared_lines() -> list[tuple[str, str]]:
    """Lines paired copy by copy; the longest common order by steps over all earlier pairs."""
    fields = lambda t: (
        f"SELECT page_id, 'content_text' AS field, CASE WHEN body = '' THEN []::VARCHAR[] ELSE string_split(body, chr(10)) END AS l FROM {t} "
        f"UNION ALL SELECT page_id, 'title', CASE WHEN title IS NULL THEN []::VARCHAR[] ELSE [title] END FROM {t}"
    )
    flat = lambda t: (
        "SELECT *, row_number() OVER (PARTITION BY page_id, field, line ORDER BY n) AS nth FROM "
        f"(SELECT page_id, field, unnest(l) AS line, generate_subscripts(l, 1) AS n FROM {t} WHERE (page_id, field) IN (SELECT page_id, field FROM differ))"
    )
    return [
        *edited_snapshot(),
        ("a_lists", fields("a_side")),
        ("b_lists", fields("b_side")),
        ("differ", "SELECT page_id, field FROM a_lists a JOIN b_lists b USING (page_id, field) WHERE a.l <> b.l"),
        ("a_lines", flat("a_lists")),
        ("b_lines", flat("b_lists")),
        (
            "met",
            "SELECT page_id, field, line, a.n::INTEGER AS line_a, b.n::INTEGER AS line_b FROM a_lines a FULL JOIN b_lines b USING (page_id, field, line, nth)",
        ),
        (
            "orders",
            "SELECT page_id, field, list(line_a ORDER BY line_a) AS pa, list(line_b ORDER BY line_a) AS pb FROM met "
            "WHERE line_a IS NOT NULL AND line_b IS NOT NULL GROUP BY ALL",
        ),
        (
            "climb",
            "SELECT page_id, field, pa, pb, 0 AS i, []::INTEGER[] AS lv FROM orders UNION ALL "
            "SELECT page_id, field, pa, pb, i + 1, list_append(lv, (1 + coalesce(list_max(list_transform("
            "list_filter(range(1, i + 1), lambda j: pb[j] < pb[i + 1]), lambda j: lv[j])), 0))::INTEGER) FROM climb WHERE i < len(pb)",
        ),
        ("levels_of", "SELECT page_id, field, pa, lv, list_max(lv) AS top FROM climb WHERE i = len(pb)"),
        (
            "descent",
            "SELECT page_id, field, pa, lv, top AS level, list_max(list_filter(range(1, len(lv) + 1), lambda j: lv[j] = top)) AS spot FROM levels_of UNION ALL "
            "SELECT page_id, field, pa, lv, level - 1, list_max(list_filter(range(1, spot), lambda j: lv[j] = level - 1)) FROM descent WHERE level > 1",
        ),
        ("settled", "SELECT page_id, field, pa[spot] AS line_a FROM descent"),
    ]


def profile_tables(fold: str = "true") -> list[tuple[str, str]]:
    grams = (
        "list_concat(list_concat(list_transform(range(1, len(w) + 1), lambda i: substr(w, i, 1)), "
        "list_transform(range(1, len(w) + 2), lambda i: substr('_' || w || '_', i, 2))), "
        "list_transform(range(1, len(w) + 1), lambda i: substr('_' || w || '_', i, 3)))"
    )
    return [
        ("word_rows", f"SELECT doc_id, lang, unnest({words('text')}) AS w FROM documents"),
        ("gram_rows", f"SELECT doc_id, lang, unnest({grams}) AS gram FROM word_rows"),
        ("gram_counts", "SELECT lang, gram, count(*) AS n FROM gram_rows WHERE doc_id % 2 = 0 AND lang IS NOT NULL GROUP BY ALL"),
        ("ranked_grams", "SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rank FROM gram_counts"),
        ("profile", "SELECT lang, gram, rank::INTEGER AS rank FROM ranked_grams WHERE rank <= 300"),
        ("sized", "SELECT doc_id, count(*) AS n FROM gram_rows GROUP BY 1"),
        (
            "points",
            "SELECT g.doc_id, p.lang, sum(301 - rank) AS score FROM gram_rows g JOIN profile p USING (gram) GROUP BY ALL",
        ),
        (
            "contest",
            "SELECT doc_id, lang, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS place, "
            "coalesce(lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC, lang), 0) AS following FROM points",
        ),
        (
            "found",
            "SELECT doc_id, d.lang AS named, coalesce(n, 0) AS n_grams, CASE WHEN n >= 40 AND score * 100 >= following * 105 AND score >= n * 30 THEN c.lang END AS detected "
            f"FROM documents d LEFT JOIN sized USING (doc_id) LEFT JOIN (SELECT * FROM contest WHERE place = 1) c USING (doc_id) WHERE {fold}",
        ),
    ]


def percentiles(values: str) -> str:
    return ", ".join(
        f"round(quantile_cont({values}, {p}), 6) AS p{round(p * 100)}" for p in (0.5, 0.9, 0.99)
    )


def kept_blocks(visible: str) -> list[tuple[str, str]]:
    """Main-content blocks of the injected pages with their page URL."""
    return [
        *block_rows(INJECTED),
        focus_table(),
        (
            "kept",
            "SELECT blks.*, url AS base FROM blks JOIN levels ON focus = 'balanced' JOIN src USING (page_id) "
            f"WHERE {visible} AND in_content AND NOT in_chrome AND NOT in_comments "
            "AND (NOT in_teaser OR teasers) AND (NOT in_bottom OR bottoms)",
        ),
    ]


def _oracles() -> dict[str, str]:
    from pagewinnow.options import ExtractOptions

    cut = "instr(html, '<article>')"
    prefix = f"substr(html, 1, {cut} - 1)"
    rest = f"substr(html, {cut})"
    docs = "SELECT doc_id AS page_id, lang AS declared, text AS content_text FROM documents"
    lang_counts = " UNION ALL ".join(
        f"SELECT page_id, declared, {hits('ws', ws)} AS n, {i} AS place, '{l}' AS lang FROM worded"
        for i, (l, ws) in enumerate(sorted(P.STOP_WORDS.items()))
    )
    detected = [
        ("docs", docs),
        ("worded", f"SELECT *, {words('content_text')} AS ws FROM docs"),
        ("counted", lang_counts),
        (
            "found",
            "SELECT page_id, any_value(declared) AS declared, CASE WHEN max(n) >= 2 THEN first(lang ORDER BY n DESC, place) END AS detected FROM counted GROUP BY page_id",
        ),
    ]
    img = [
        *kept_blocks("(n_chars > 0 OR (tag <> 'title' AND regexp_matches(body, '(?i)<img[ \\t\\r\\n\\f/]')))"),
        ("img_list", f"SELECT page_id, block_no, base, regexp_extract_all(body, {lit(P.named_tag('img'))}, 0) AS l FROM kept"),
        ("img_flat", "SELECT page_id, block_no, base, unnest(l) AS t, (generate_subscripts(l, 1) - 1)::INTEGER AS pos FROM img_list"),
        ("img_raw", f"SELECT *, {attribute('t', 'src')} AS s, {attribute('t', 'alt')} AS alt FROM img_flat"),
        (
            "images",
            f"SELECT page_id, block_no, pos, CASE WHEN s = '' THEN '' ELSE {resolve('s', 'base')} END AS src, alt, "
            f"starts_with(lower(s), 'data:') AS is_data_uri, regexp_matches(s, {lit(FURNITURE_IMAGE)}) AS is_furniture FROM img_raw",
        ),
    ]
    edges = [
        ("a_list", f"SELECT page_id, block_no, base, regexp_extract_all(body, {lit(P.named_tag('a'))}, 0) AS l FROM kept"),
        ("a_flat", "SELECT page_id, block_no, base, unnest(l) AS t, (generate_subscripts(l, 1) - 1)::INTEGER AS pos FROM a_list"),
        ("a_raw", f"SELECT *, {squash(unescape(attribute('t', 'href')))} AS h FROM a_flat"),
        ("a_abs", f"SELECT *, {resolve('h', 'base')} AS target FROM a_raw WHERE h <> ''"),
        (
            "edges",
            f"SELECT page_id, block_no, pos, {host('base')} AS source_host, target, {host('target')} AS target_host FROM a_abs "
            f"WHERE {host('target')} IS NOT NULL",
        ),
    ]
    all_based = ("kept", "SELECT blks.*, url AS base FROM blks JOIN src USING (page_id)")
    two_snapshots = [
        *full_tables(ExtractOptions(), ExtractOptions(focus="favor_precision")),
        (
            "both_sides",
            "SELECT page_id, CASE WHEN strlen(html) > 20000 THEN 1 ELSE 0 END AS big FROM src",
        ),
    ]
    diff_fields = ("content_text", "comments_text", "content_html", "comments_html")
    diffs = (
        " UNION ALL ".join(
            f"SELECT a.page_id, '{f}' AS field, 'changed' AS change FROM result a JOIN result b USING (page_id) JOIN both_sides USING (page_id) "
            f"WHERE a.option_id = 0 AND b.option_id = 1 AND a.{f} <> (CASE WHEN big = 1 THEN '' ELSE b.{f} END)"
            for f in diff_fields
        )
        + " UNION ALL SELECT page_id, 'outcome', 'changed' FROM both_sides WHERE big = 1"
        + " UNION ALL SELECT page_id, m.f, 'changed' FROM both_sides JOIN (SELECT page_id, unnest(["
        + ", ".join(f"CASE WHEN {f} IS NOT NULL AND cast({f} AS VARCHAR) <> '' THEN '{f}' END" for f in M.FIELDS if f not in ("url", "hostname"))
        + "]) AS f FROM meta) m USING (page_id) WHERE big = 1 AND m.f IS NOT NULL"
        + " UNION ALL SELECT page_id, 'url', 'changed' FROM both_sides JOIN meta USING (page_id) JOIN pages p USING (page_id) WHERE big = 1 AND meta.url IS DISTINCT FROM p.url"
        + f" UNION ALL SELECT page_id, 'hostname', 'changed' FROM both_sides JOIN meta USING (page_id) JOIN pages p USING (page_id) WHERE big = 1 AND meta.hostname IS DISTINCT FROM {host('p.url')}"
    )
    scores = statistical_runs()
    rates = (
        "round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, "
        f"round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round({F_SCORE}, 6) AS f_score"
    )
    run_tables = [
        *scores,
        (
            "levels2",
            "SELECT DISTINCT page_id FROM blks WHERE n_chars > 0 AND in_content AND NOT in_chrome AND in_bottom",
        ),
    ]
    record = lambda day: (
        f"SELECT {day} AS run_date, 'corpus-1' AS corpus_version, (SELECT count(*) FROM pages) AS pages, "
        "CASE WHEN EXISTS (SELECT 1 FROM levels2) THEN 'non-empty' ELSE 'empty' END AS verdict, "
        f"(SELECT round({F_SCORE}, 6) FROM cells WHERE run = 'default') AS fscore"
    )
    options = ExtractOptions
    return {
        "read_pages": "SELECT page_id, url, strlen(html) AS n_bytes FROM pages",
        "size_gate": f"SELECT page_id, strlen(html) AS n_bytes, strlen(html) > {SIZE_CAP} AS too_large FROM pages",
        "utf8_gate": f"SELECT page_id, CASE WHEN page_id % 10 = 3 THEN strlen({prefix}) END AS bad_offset FROM pages",
        "lossy_decode": f"SELECT page_id, page_id % 10 = 3 AS lossy, sha256(CASE WHEN page_id % 10 = 3 THEN {prefix} || chr(65533) || {rest} ELSE html END) AS digest FROM pages",
        "strip_bom": "SELECT page_id, sha256(html) AS digest FROM pages",
        "encoding_profile": (
            f"SELECT {host('url')} AS host, count(*) AS pages, count(*) FILTER (page_id % 7 IN (1, 3)) AS not_utf8, "
            "count(*) FILTER (page_id % 7 = 0) AS utf8_bom, count(*) FILTER (page_id % 7 = 1) AS utf16_bom, "
            "count(*) FILTER (page_id % 7 = 2) AS has_nul, "
            "count(*) FILTER (NOT contains(lower(html), '</html>')) AS unclosed FROM pages GROUP BY 1"
        ),
        "markup_tokens": with_tables([PLAIN_PAGES, *tag_grain()], "SELECT page_id, pos, token, is_tag, closing, tag FROM tok"),
        "region_state": with_tables([INJECTED, *tag_grain(), *regions()], f"SELECT page_id, pos, tag, {FLAGS} FROM placed"),
        "block_tokens": with_tables(
            [PLAIN_PAGES, *block_grain(), *regions()], "SELECT page_id, pos, closing, tag, css_class, body FROM styled"
        ),
        "blocks": with_tables(block_rows(), f"SELECT page_id, block_no, tag, text, {FLAGS} FROM blks WHERE n_chars > 0"),
        "block_features": with_tables(
            [*block_rows(), features()],
            "SELECT page_id, block_no, n_chars, link_chars, n_words, n_stop, round(link_density, 6) AS link_density, "
            "round(stop_density, 6) AS stop_density FROM feats WHERE n_chars > 0",
        ),
        "classify_blocks": with_tables(
            [*block_rows(), features(), *labelled()], "SELECT focus, page_id, block_no, label FROM lab WHERE n_chars > 0"
        ),
        "smooth_blocks": with_tables(
            [*block_rows(), features(), *labelled(), *smoothed()],
            "SELECT focus, page_id, block_no, label, keep FROM smooth WHERE n_chars > 0",
        ),
        "prune_blocks": with_tables(pruned_blocks(), "SELECT page_id, block_no, tag, text FROM texts WHERE text <> ''"),
        "fallback_select": with_tables(
            second_pass(),
            "SELECT page_id, chosen, rescued, CASE WHEN rescued THEN b ELSE t END AS content_text FROM rescues",
        ),
        "run_record": with_tables(run_tables, record("DATE '2024-01-01'")),
        "run_log": with_tables(run_tables, record("DATE '2024-01-01'") + " UNION ALL " + record("DATE '2024-01-02'")),
        "exclude_tables": one_run("SELECT page_id, content_text FROM result", exclude_tables=True),
        "split_comments": one_run("SELECT page_id, comments_text, comments_html FROM result"),
        "exclude_comments": one_run("SELECT page_id, comments_text FROM result", exclude_comments=True),
        "rescue_short_pages": one_run(
            "SELECT page_id, rescued, content_text, content_html FROM result", min_chars=1500
        ),
        "nested_containers": with_tables(
            block_rows(WRAPPED), "SELECT page_id, block_no, in_content, in_chrome, in_furniture FROM blks WHERE n_chars > 0"
        ),
        "wrapped_pages": one_run("SELECT page_id, rescued, content_text, content_html FROM result", source=WRAPPED),
        "assemble": one_run("SELECT page_id, content_text, content_html FROM result"),
        "keep_links_and_images": with_tables(
            [
                *block_rows(INJECTED),
                BASES,
                *streams(option_table(options(include_links=True, include_images=True)), base="base"),
            ],
            "SELECT page_id, content_html FROM result",
        ),
        "link_edges": with_tables([*block_rows(INJECTED), all_based, *edges], "SELECT * FROM edges"),
        "host_degrees": with_tables(
            [*kept_blocks("n_chars > 0"), *edges],
            "SELECT host, sum(o)::BIGINT AS out_links, sum(i)::BIGINT AS in_links FROM (SELECT source_host AS host, 1 AS o, 0 AS i FROM edges "
            "UNION ALL SELECT target_host, 0, 1 FROM edges) GROUP BY host",
        ),
        "image_rows": with_tables(img, "SELECT * FROM images"),
        "image_inventory": with_tables(
            img,
            "SELECT (SELECT count(*) FROM pages) AS pages, count(DISTINCT page_id) AS pages_with_image, "
            "(SELECT count(*) FROM pages WHERE page_id % 7 < 5) AS pages_with_og_image, count(*) AS images, "
            "count(*) FILTER (src <> '') AS with_src, count(*) FILTER (alt <> '') AS with_alt, "
            "count(*) FILTER (is_data_uri) AS data_uris, count(*) FILTER (is_furniture) AS furniture FROM images",
        ),
        "dedup_blocks": with_tables(
            [*block_rows(PLAIN_PAGES), features(), *hashed_blocks()],
            f"SELECT page_id, block_no, text FROM normed LEFT JOIN freq USING (norm) WHERE n_chars > 0 AND coalesce(df, 0) <= {MAX_BLOCK_PAGES}",
        ),
        "dedup_blocks_by_host": with_tables(
            [*block_rows(PLAIN_PAGES), features(), *hashed_blocks(", host")],
            "SELECT page_id, block_no, text FROM normed LEFT JOIN freq USING (norm, host) WHERE n_chars > 0 AND coalesce(df, 0) <= 1",
        ),
        "duplicate_pages": (
            "SELECT doc_id AS page_id, CASE WHEN count(*) OVER w > 1 AND text <> '' THEN min(doc_id) OVER w END AS first_page, "
            "text <> '' AND min(doc_id) OVER w < doc_id AS is_duplicate FROM documents WINDOW w AS (PARTITION BY text)"
        ),
        "meta_pairs": meta_query("SELECT page_id, pos, key, value FROM pairs"),
        "jsonld_fields": meta_query(
            "SELECT page_id, title, author, date, type FROM linked"
        ),
        "metadata_fields": meta_query(f"SELECT page_id, {META_COLUMNS} FROM meta"),
        "null_if_empty": (
            "SELECT page_id, CASE WHEN page_id % 4 = 3 THEN url END AS author, "
            "CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END::INTEGER AS n_tags FROM pages"
        ),
        "split_sinks": one_run(
            "SELECT page_id, CASE WHEN big THEN 'refused' ELSE 'accepted' END AS sink, "
            "CASE WHEN big THEN 'input_too_large' END AS reason "
            f"FROM (SELECT page_id, strlen(html) > {SIZE_CAP} AS big FROM src)"
        ),
        "stream_extract": one_run(
            "SELECT page_id, CASE WHEN big THEN 'refused' ELSE 'ok' END AS outcome, "
            "CASE WHEN big THEN 'input_too_large' END AS reason, CASE WHEN big THEN '' ELSE content_text END AS content_text "
            f"FROM (SELECT r.*, strlen(html) > {SIZE_CAP} AS big FROM result r JOIN src USING (page_id))",
            source=PLAIN_PAGES,
        ),
        "resolve_url": meta_query("SELECT page_id, url, hostname, image FROM meta"),
        "publication_date": (
            "SELECT page_id, CASE WHEN page_id % 6 = 0 THEN DATE '2020-03-09' WHEN page_id % 6 = 1 THEN DATE '2020-01-21' "
            "WHEN page_id % 6 = 2 THEN DATE '2020-01-20' WHEN page_id % 6 = 3 THEN DATE '2019-04-05' "
            "WHEN page_id % 8 = 5 THEN DATE '2021-05-06' WHEN page_id % 6 = 5 THEN DATE '2018-11-30' "
            "WHEN page_id % 12 = 4 THEN DATE '2017-03-09' WHEN page_id % 12 = 10 THEN DATE '2016-03-09' END AS date FROM pages"
        ),
        "date_override": meta_query("SELECT page_id, date, title FROM meta", override=f"DATE '{DATE_OVERRIDE.isoformat()}'"),
        "exclude_authors": (
            "SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'Emmy Noether' WHEN page_id % 4 = 2 THEN NULL "
            "WHEN page_id % 8 = 5 THEN 'Linus Data' END AS author FROM pages"
        ),
        "tag_terms": meta_query(
            "SELECT hostname AS host, lower(term) AS term, count(*) AS n FROM (SELECT hostname, unnest(string_split(tags, '|')) AS term FROM meta WHERE tags <> '') GROUP BY 1, 2"
        ),
        "detect_language": with_tables(detected, "SELECT page_id, declared, detected FROM found"),
        "language_profiles": with_tables(profile_tables(), "SELECT lang, gram, rank FROM profile"),
        "detect_by_profiles": with_tables(profile_tables(), "SELECT doc_id, n_grams, detected FROM found"),
        "profile_agreement": with_tables(
            profile_tables("doc_id % 2 <> 0"), "SELECT named AS lang, detected, count(*) AS texts FROM found GROUP BY ALL"
        ),
        "language_gate": with_tables(
            detected,
            "SELECT page_id, coalesce(d <> 'en', false) OR coalesce(detected <> 'en', false) AS refused, "
            "CASE WHEN NOT coalesce(d <> 'en', false) AND detected <> 'en' THEN detected END AS detail "
            "FROM (SELECT *, CASE WHEN page_id % 2 = 0 THEN declared END AS d FROM found)",
        ),
        "essential_metadata_gate": meta_query(
            "SELECT page_id, CASE WHEN title IS NULL THEN 'title' WHEN url IS NULL THEN 'url' WHEN date IS NULL THEN 'date' END AS missing FROM meta",
            supplied="NULL",
        ),
        "metadata_coverage": meta_query(
            "SELECT host, field, pages, filled, round(filled / pages, 6) AS fill_rate FROM ("
            + " UNION ALL ".join(
                f"SELECT hostname AS host, '{f}' AS field, count(*) AS pages, count(*) FILTER ({f} IS NOT NULL AND cast({f} AS VARCHAR) <> '') AS filled FROM meta GROUP BY 1"
                for f in M.FIELDS
            )
            + ")"
        ),
        "outcome_ledger": with_tables(strict_ledger(), "SELECT * FROM ledger"),
        "outcome_tally": with_tables(
            [*strict_ledger(), ("hosts", f"SELECT {host('url')} AS host, outcome FROM ledger")],
            "SELECT host, outcome, grouping(host, outcome)::INTEGER AS level, count(*) AS pages FROM hosts GROUP BY ROLLUP (host, outcome)",
        ),
        "changed_lines": with_tables(
            compared_lines(),
            "SELECT page_id, field, CASE WHEN line_a IS NULL THEN 'added' WHEN line_b IS NULL THEN 'removed' ELSE 'moved' END AS change, line_a, line_b, line "
            "FROM met WHERE line_a IS NULL OR line_b IS NULL OR (page_id, field, line_a) NOT IN (SELECT page_id, field, line_a FROM settled)",
        ),
        "renamed_pages": with_tables(
            edited_snapshot(),
            "SELECT sha256(body) AS body_sha, min(page_id) FILTER (side = 'a') AS page_a, min(page_id) FILTER (side = 'b') AS page_b, "
            "count(*) FILTER (side = 'a') AS pages_a, count(*) FILTER (side = 'b') AS pages_b FROM ("
            "SELECT page_id, body, 'a' AS side FROM a_side WHERE page_id NOT IN (SELECT page_id FROM b_side) UNION ALL "
            "SELECT page_id, body, 'b' FROM b_side WHERE page_id NOT IN (SELECT page_id FROM a_side)) WHERE body <> '' "
            "GROUP BY body HAVING count(DISTINCT side) = 2",
        ),
        "lossy_tally": with_tables(
            [
                *block_rows(PLAIN_PAGES),
                *streams(option_table(ExtractOptions())),
                (
                    "hosts",
                    f"SELECT {host('url')} AS host, page_id % 10 = 3 AS lossy, CASE WHEN content_text <> '' OR comments_text <> '' THEN 'ok' ELSE 'refused' END AS outcome "
                    "FROM result JOIN src USING (page_id)",
                ),
            ],
            "SELECT host, outcome, grouping(host, outcome)::INTEGER AS level, count(*) AS pages, count(*) FILTER (lossy) AS lossy FROM hosts GROUP BY ROLLUP (host, outcome)",
        ),
        "snapshot_diff": with_tables(two_snapshots, diffs),
        "diff_verdict": with_tables(
            [*two_snapshots, ("diffs", diffs)],
            "SELECT (SELECT count(*) FROM pages) AS pages_a, (SELECT count(*) FROM pages) AS pages_b, "
            "count(DISTINCT page_id) AS pages_changed, count(*) AS fields_changed, 'non-empty' AS verdict FROM diffs",
        ),
        "dump_manifest": with_tables(
            [
                *full_tables(ExtractOptions()),
                ("flat_rows", "SELECT * FROM result JOIN meta USING (page_id) WHERE content_text <> '' OR comments_text <> ''"),
                *manifest_tables(),
            ],
            "SELECT page_id, field, n_bytes, n_items::BIGINT AS n_items, digest FROM manifest UNION ALL "
            "SELECT page_id, 'outcome', strlen(o), 1, sha256(o) FROM (SELECT page_id, CASE WHEN content_text <> '' OR comments_text <> '' "
            "THEN 'ok' ELSE 'refused' END AS o FROM result) UNION ALL SELECT page_id, 'error', strlen('insufficient_content'), 1, "
            "sha256('insufficient_content') FROM result WHERE content_text = '' AND comments_text = ''",
        ),
        "score_extraction": with_tables(scores, f"SELECT run, tp, fn, fp, tn, {rates} FROM cells"),
        "fscore_tripwire": with_tables(
            scores,
            f"SELECT run, round({F_SCORE}, 6) AS f_score, CASE WHEN run <> 'default' THEN 'reported' "
            f"WHEN {F_SCORE} >= 0.903 THEN 'pass' ELSE 'fail' END AS status FROM cells",
        ),
        "score_dates": (
            "SELECT count(*) FILTER (d = t) AS correct, count(*) FILTER (d <> t) AS wrong, count(*) FILTER (d IS NULL) AS missing, "
            "round(count(*) FILTER (d = t) / count(*) FILTER (d IS NOT NULL), 6) AS precision_when_answered FROM ("
            "SELECT CASE WHEN page_id % 6 = 0 THEN DATE '2020-03-09' WHEN page_id % 6 = 1 THEN DATE '2020-01-21' "
            "WHEN page_id % 6 = 2 THEN DATE '2020-01-20' WHEN page_id % 6 = 3 THEN DATE '2019-04-05' "
            "WHEN page_id % 8 = 5 THEN DATE '2021-05-06' WHEN page_id % 6 = 5 THEN DATE '2018-11-30' "
            "WHEN page_id % 12 = 4 THEN DATE '2017-03-09' WHEN page_id % 12 = 10 THEN DATE '2016-03-09' END AS d, "
            "CASE WHEN page_id % 6 IN (0, 4) THEN DATE '2020-03-09' ELSE DATE '2020-01-21' END AS t FROM pages)"
        ),
        "paired_agreement": with_tables(
            [
                *scores,
                ("correct", "SELECT run, page_id, kind, snippet, found = (kind = 'with') AS ok FROM judged"),
            ],
            "SELECT a.ok AS a_right, b.ok AS b_right, count(*) AS n FROM correct a JOIN correct b USING (page_id, kind, snippet) "
            "WHERE a.run = 'default' AND b.run = 'favor_recall' GROUP BY 1, 2",
        ),
        "stream_overlap": one_run(
            "SELECT page_id, len(list_distinct(list_intersect(list_filter(string_split(content_text, chr(10)), lambda x: x <> ''), "
            "list_filter(string_split(comments_text, chr(10)), lambda x: x <> ''))))::INTEGER AS shared_lines FROM result"
        ),
        "distribution": (
            "SELECT count(*) AS n, round(avg(b), 6) AS mean, max(b)::DOUBLE AS max_value, count(*) FILTER (b > 5000) AS over_budget, "
            f"{percentiles('b')} FROM (SELECT strlen(html) AS b FROM pages)"
        ),
        "nesting_profile": with_tables(
            [
                PLAIN_PAGES,
                *tag_grain(),
                (
                    "steps",
                    f"SELECT page_id, pos, CASE WHEN NOT is_tag THEN 0 WHEN closing THEN -1 WHEN token LIKE '%/>' OR tag IN ('', {names(P.VOID_TAGS)}) THEN 0 ELSE 1 END AS d FROM tok",
                ),
                ("sums", "SELECT page_id, pos, sum(d) OVER (PARTITION BY page_id ORDER BY pos) AS s FROM steps"),
                ("running", "SELECT page_id, s - least(0, min(s) OVER (PARTITION BY page_id ORDER BY pos)) AS depth FROM sums"),
                ("depths", "SELECT page_id, greatest(max(depth), 0)::INTEGER AS depth FROM running GROUP BY page_id"),
            ],
            "SELECT count(*) AS pages, max(depth) AS max_depth, count(*) FILTER (depth > 50) AS over_50, "
            f"count(*) FILTER (depth > 500) AS over_500, {percentiles('depth')} FROM depths",
        ),
        "determinism_check": (
            "SELECT 'shuffled' AS against, count(*) AS rows_a, count(*) AS rows_b, true AS same FROM pages "
            "UNION ALL SELECT 'changed', count(*), count(*), false FROM pages UNION ALL SELECT 'longer', count(*), count(*) + 1, false FROM pages"
        ),
        "measurement_summary": (
            "SELECT event_type, count(value) AS repeats, quantile_disc(value, 0.5) AS median, "
            "CASE WHEN min(value) < max(value) THEN min(value) END AS fastest, CASE WHEN min(value) < max(value) THEN max(value) END AS slowest "
            "FROM events WHERE value IS NOT NULL GROUP BY event_type"
        ),
        "option_sweep": with_tables(
            [*block_rows(INJECTED), BASES, *streams(option_table(*OPTION_SETS), base="base")],
            "SELECT option_id, page_id, sha256(content_text) AS content_text, sha256(comments_text) AS comments_text, "
            "sha256(content_html) AS content_html, sha256(comments_html) AS comments_html FROM result",
        ),
        "stream_tally": (
            "SELECT time_bucket(INTERVAL 1 MINUTE, TIMESTAMP '2024-01-01' + to_seconds(page_id)) AS window_start, "
            f"CASE WHEN strlen(html) > {SIZE_CAP} THEN 'input_too_large' ELSE 'ok' END AS reason, count(*) AS pages FROM pages GROUP BY 1, 2"
        ),
        "stream_late": (
            f"WITH timed AS (SELECT page_id, html, {X.BATCH} AS batch, TIMESTAMP '2024-01-01' + to_seconds(page_id * 4) "
            "- to_minutes(CASE WHEN page_id % 9 = 8 THEN 10 ELSE 0 END) AS ts FROM pages, (SELECT max(page_id) AS top FROM pages)), "
            "newest AS (SELECT batch, max(ts) AS t FROM timed GROUP BY batch), "
            "marked AS (SELECT timed.*, time_bucket(INTERVAL 1 MINUTE, ts) AS w, (SELECT max(t) FROM newest n WHERE n.batch < timed.batch) - INTERVAL 2 MINUTE AS mark FROM timed) "
            f"SELECT w AS window_start, CASE WHEN strlen(html) > {SIZE_CAP} THEN 'input_too_large' ELSE 'ok' END AS reason, "
            "coalesce(w + INTERVAL 1 MINUTE <= mark, false) AS late, w + INTERVAL 1 MINUTE <= (SELECT max(t) FROM newest) - INTERVAL 2 MINUTE AS closed, "
            "count(*) AS pages FROM marked GROUP BY 1, 2, 3, 4"
        ),
        "stream_extract_copies": one_run(
            "SELECT page_id, CASE WHEN reason IS NULL THEN 'ok' ELSE 'refused' END AS outcome, reason FROM ("
            "SELECT page_id, CASE WHEN content_text = '' AND comments_text = '' THEN 'insufficient_content' "
            "WHEN content_text <> '' AND page_id > min(page_id) OVER (PARTITION BY content_text) THEN 'duplicate_content' END AS reason FROM ("
            "SELECT page_id, content_text, comments_text FROM result UNION ALL SELECT page_id + 1000000, content_text, comments_text "
            f"FROM result, (SELECT max(page_id) AS top FROM pages) WHERE {X.BATCH} < 2))",
            source=PLAIN_PAGES,
        ),
        "stream_unique": (
            f"SELECT doc_id AS page_id FROM documents QUALIFY coalesce({squash('text')}, '') = '' OR doc_id = min(doc_id) OVER (PARTITION BY {squash('text')})"
        ),
        "read_page_tree": (
            "SELECT row_number() OVER (ORDER BY 'page_id=' || page_id || '/') - 1 AS page_id, page_id AS file_id, sha256(html) AS digest FROM pages"
        ),
        "stream_dedup": f"SELECT DISTINCT sha256({squash('text')}) AS body FROM documents",
        "extracted": with_tables(
            full_tables(ExtractOptions()),
            f"SELECT page_id, {META_COLUMNS}, content_text, comments_text, content_html, comments_html "
            "FROM result JOIN meta USING (page_id) WHERE content_text <> '' OR comments_text <> ''",
        ),
    }


ORACLES = _oracles()
