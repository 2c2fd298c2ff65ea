"""Block text, features, classification and smoothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pagewinnow.functions import patterns as P
from pagewinnow.functions.text import count_in, letter_words, listed, plain_text, quoted

# Classification thresholds per focus.  The numbers are ours; the teaser and
# bottom-links columns are contract.
#   focus: (min chars, max link density, keep teasers, keep bottom links)
THRESHOLDS = {
    "favor_precision": (40, 0.3, False, False),
    "balanced": (25, 0.5, False, True),
    "favor_recall": (10, 0.7, True, True),
}
ALL_STOP_WORDS = sorted({w for words in P.STOP_WORDS.values() for w in words})
_ROWS_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def threshold(focus: str, position: int) -> str:
    """A threshold as a ``CASE`` over the three focus levels; folds when literal."""
    arms = " ".join(
        f"WHEN '{name}' THEN {str(values[position]).lower()}" for name, values in THRESHOLDS.items()
    )
    return f"CASE {focus} {arms} END"


def blocks(rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Add ``text``, ``n_chars`` and ``link_chars`` to block-grain rows.

    An anchor left open in an earlier block keeps counting as a link until its
    end tag, found with a window over the page.  The title element is not text.
    """
    has_anchor = " OR ".join(f"contains(body, '{mark}')" for mark in ("<a", "<A", "</a", "</A"))
    balance = (
        f"regexp_count(body, {quoted(P.ANCHOR_OPEN)}) - regexp_count(body, {quoted(P.ANCHOR_CLOSE)})"
    )
    change = "CASE WHEN _balance <> 0 THEN _balance > 0 END"
    scope = "concat(CASE WHEN _open THEN '<a>' ELSE '' END, body, '</a>')"
    anchors = f"array_join(regexp_extract_all({scope}, {quoted(P.ANCHOR_TEXT)}, 1), ' ')"
    rows = (
        rows.selectExpr("*", f"{has_anchor} AS _anchor")
        .selectExpr("*", f"CASE WHEN _anchor THEN {balance} END AS _balance")
        .selectExpr(
            "*",
            f"coalesce(last({change}, true) OVER (PARTITION BY page_id ORDER BY pos {_ROWS_BEFORE}), "
            "false) AS _open",
        )
        .selectExpr(
            "*",
            "CASE WHEN tag = 'title' THEN '' ELSE body END AS _readable",
            f"CASE WHEN tag <> 'title' AND (_anchor OR _open) THEN {anchors} ELSE '' END AS _linked",
        )
    )
    rows = plain_text(plain_text(rows, "_readable", "text"), "_linked", "_linked")
    return rows.selectExpr(
        "page_id",
        "pos AS block_no",
        "CASE WHEN closing OR tag = '' THEN 'p' ELSE tag END AS tag",
        *[c for c in rows.columns if c.startswith(("in_", "mark_"))],
        "css_class",
        "css_id",
        "body",
        "text",
        "length(text) AS n_chars",
        "length(_linked) AS link_chars",
        *carry,
    )


def block_features(block_rows: DataFrame) -> DataFrame:
    """Add word and stop-word counts and densities; no shuffle, no explode."""
    return (
        block_rows.selectExpr("*", f"{letter_words('text')} AS _words")
        .selectExpr(
            *block_rows.columns,
            "size(_words) AS n_words",
            f"{count_in('_words', ALL_STOP_WORDS)} AS n_stop",
        )
        .selectExpr(
            "*",
            "CASE WHEN n_chars > 0 THEN link_chars / n_chars ELSE 0D END AS link_density",
            "CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0D END AS stop_density",
        )
    )


def allowed_by_options(options) -> str:
    """The option-driven drops: teasers, trailing links, tables."""
    focus = options.sql("focus")
    return (
        f"(NOT in_teaser OR {threshold(focus, 2)}) AND (NOT in_bottom OR {threshold(focus, 3)}) "
        f"AND (NOT in_table OR NOT {options.sql('exclude_tables')})"
    )


def visible(options) -> str:
    """Has text; an image alone counts as well when images are kept."""
    if not options.possible("include_images"):
        return "n_chars > 0"
    image = r"(?i)<img[ \t\r\n\f/]"
    return (
        f"(n_chars > 0 OR ({options.sql('include_images')} AND tag <> 'title' "
        f"AND body RLIKE {quoted(image)}))"
    )


def structural_label(options) -> str:
    """Main content: inside a content container and not page furniture."""
    return (
        f"{visible(options)} AND in_content AND NOT in_chrome AND NOT in_comments "
        f"AND {allowed_by_options(options)}"
    )


def baseline_label(options) -> str:
    """Rescue pass: all text that is neither page furniture nor a comment."""
    return (
        f"{visible(options)} AND NOT in_chrome AND (NOT in_header OR in_content) "
        f"AND NOT in_comments AND {allowed_by_options(options)}"
    )


def loose_label(options) -> str:
    """Last resort: as the rescue pass, but only tags make page furniture.

    For pages that lie in one wrapper whose class or id sounds like furniture.
    """
    return (
        f"{visible(options)} AND NOT in_furniture AND (NOT in_header OR in_content) "
        f"AND NOT in_comments AND {allowed_by_options(options)}"
    )


def comment_label(options) -> str:
    return f"{visible(options)} AND in_comments AND NOT {options.sql('exclude_comments')}"


def nest_labels(options) -> dict[str, str]:
    """Which lists and tables each pass may keep around its blocks."""
    allowed = allowed_by_options(options)
    return {
        "main": f"in_content AND NOT in_chrome AND NOT in_comments AND {allowed}",
        "comment": f"in_comments AND NOT {options.sql('exclude_comments')}",
        "second": f"NOT in_comments AND {allowed} AND {options.sql('enable_fallback')}",
    }


def statistical_label(options) -> str:
    """Blind to containers: good, near, short, bad or blank.

    Headings and blocks a little too short that read like prose are ``near``;
    the neighbour pass decides on them.
    """
    focus = options.sql("focus")
    min_chars, max_links = threshold(focus, 0), threshold(focus, 1)
    return (
        "CASE WHEN n_chars = 0 THEN 'blank' "
        f"WHEN link_density > {max_links} THEN 'bad' "
        f"WHEN n_chars >= {min_chars} THEN 'good' "
        f"WHEN tag IN ({listed(P.HEADING_TAGS)}) THEN 'near' "
        f"WHEN n_chars * 2 >= {min_chars} AND n_stop > 0 THEN 'near' "
        "ELSE 'short' END"
    )


def classify_blocks(features: DataFrame, options) -> DataFrame:
    """Add the statistical label as ``label``."""
    return features.selectExpr("*", f"{statistical_label(options)} AS label")


def smooth_blocks(labelled: DataFrame, keys: Sequence[str] = ("page_id",), labels: Sequence[str] = ("label",)) -> DataFrame:
    """Context pass: ``near`` follows either decided neighbour, ``short`` both.

    Adds ``keep`` for ``label`` (``keep_x`` for a column ``label_x``).  The
    nearest good or bad block on each side decides; the edge of the page counts
    as bad.  The following side is a descending running frame: one pass, where a
    frame open at the far end would be rescanned for every row.
    """
    page = f"PARTITION BY {', '.join(keys)} ORDER BY block_no"

    def sides(name: str) -> list[str]:
        decided = f"last(CASE WHEN {name} IN ('good', 'bad') THEN {name} END, true)"
        return [
            f"coalesce({decided} OVER ({page} {_ROWS_BEFORE}), 'bad') = 'good' AS _before_{name}",
            f"coalesce({decided} OVER ({page} DESC {_ROWS_BEFORE}), 'bad') = 'good' AS _after_{name}",
        ]

    kept = [
        f"{n} = 'good' OR ({n} = 'near' AND (_before_{n} OR _after_{n})) "
        f"OR ({n} = 'short' AND _before_{n} AND _after_{n}) AS {n.replace('label', 'keep')}"
        for n in labels
    ]
    return labelled.selectExpr("*", *[x for n in labels for x in sides(n)]).selectExpr(*labelled.columns, *kept)
