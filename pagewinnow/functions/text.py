"""Text expressions on built-in functions.

Each helper takes and returns SQL expression text, so that operators stay
declarative and a long expression reaches the JVM in one call.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions import patterns as P


def quoted(text: str) -> str:
    """A string as a SQL literal; patterns may hold quotes and backslashes."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(words: Iterable[str]) -> str:
    return ", ".join(quoted(w) for w in words)


_PAIRS = P.PART.join(f"{name.strip('&;')}{P.SEGMENT}{char}" for name, char in P.ENTITIES)
_ENTITY_TABLE = f"str_to_map({quoted(_PAIRS)}, {quoted(P.PART)}, {quoted(P.SEGMENT)})"
_REFERENCE = quoted("^(#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});")


_DELIMITED = """(?s)^(?:"([^"]*)"|'([^']*)')$"""


def squash(x: str) -> str:
    """Collapse runs of blanks to one space and trim both ends."""
    return f"trim(regexp_replace({x}, {quoted(P.BLANKS)}, ' '))"


def unescape(x: str) -> str:
    """Decode numeric references and the named ones of the fixed table.

    One pass over the pieces between ampersands, so nothing is decoded twice.
    Each ``transform`` over a one-element struct step names a value once.
    """
    name = f"regexp_extract(p, {_REFERENCE}, 1)"
    number = (
        "CASE WHEN r.name RLIKE '^#[xX]' THEN cast(conv(substr(r.name, 3), 16, 10) AS int) "
        "WHEN r.name LIKE '#%' THEN cast(substr(r.name, 2) AS int) END"
    )
    scalar = "n.code BETWEEN 1 AND 55295 OR n.code BETWEEN 57344 AND 1114111"
    character = (
        f"CASE WHEN {scalar} THEN decode(unhex(lpad(hex(n.code), 8, '0')), 'UTF-32') "
        f"ELSE try_element_at({_ENTITY_TABLE}, n.name) END"
    )
    pieces = f"transform(split({x}, '&'), (p, i) -> struct(p AS p, i AS i, {name} AS name))"
    numbered = f"transform({pieces}, r -> struct(r.p AS p, r.i AS i, r.name AS name, {number} AS code))"
    decoded = (
        f"transform({numbered}, n -> CASE WHEN n.i = 0 THEN n.p ELSE coalesce(concat({character}, "
        "substr(n.p, length(n.name) + 2)), concat('&', n.p)) END)"
    )
    return f"CASE WHEN contains({x}, '&') THEN array_join({decoded}, '') ELSE {x} END"


def strip_tags(x: str) -> str:
    """Remove every tag; a line break counts as a blank."""
    spaced = f"regexp_replace({x}, {quoted(P.LINE_BREAK)}, ' ')"
    bare = f"regexp_replace({spaced}, {quoted(P.ANY_TAG)}, '')"
    return f"CASE WHEN contains({x}, '<') THEN {bare} ELSE {x} END"


def plain_text(df: DataFrame, markup: str, target: str) -> DataFrame:
    """Add ``target``: the reading text of the inline markup in a column.

    Works in steps, because each step uses its input several times and a
    nested expression would work that input out again for every use.
    """
    return (
        df.withColumn(target, F.expr(strip_tags(markup)))
        .withColumn(target, F.expr(unescape(target)))
        .withColumn(target, F.expr(squash(target)))
    )


def attribute(tag: str, name: str) -> str:
    """Value of one attribute of a tag as written, ``''`` when it is missing.

    ``name`` may be an alternation such as ``name|property``.
    """
    raw = f"regexp_extract({tag}, {quoted(P.attribute(name))}, 1)"
    # one pair of delimiters goes; quotes inside it belong to the value
    return f"regexp_replace({raw}, {quoted(_DELIMITED)}, '$1$2')"


def letter_words(x: str) -> str:
    """Array of lower-cased words made of letters only."""
    return f"filter(split(lower({x}), {quoted(r'[^\p{L}]+')}), w -> w <> '')"


def count_in(words: str, vocabulary: Iterable[str]) -> str:
    """How many array elements belong to a fixed vocabulary."""
    return f"size(filter({words}, w -> w IN ({listed(vocabulary)})))"


def blank_to_null(x: str) -> str:
    """``''`` and blank strings mean absent."""
    return f"CASE WHEN {x} RLIKE {quoted(r'\S')} THEN trim({x}) END"
