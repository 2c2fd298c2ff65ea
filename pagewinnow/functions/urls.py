"""URL expressions (SQL text); junk gives NULL, never a failure."""

from __future__ import annotations

from pagewinnow.functions.text import quoted

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"
_ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]+)"
_PATH = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^?#]+)"
_FOLDER = r"^(.*://[^/]+/(?:.*/)?)"


def host_of(url: str) -> str:
    return f"lower(try_parse_url({url}, 'HOST'))"


def scheme_of(url: str) -> str:
    """Scheme with its colon."""
    return f"regexp_extract({url}, '^([^:/]+:)', 1)"


def origin_of(url: str) -> str:
    """Scheme and authority, such as ``https://example.com:8080``."""
    return f"nullif(regexp_extract({url}, {quoted(_ORIGIN)}, 1), '')"


def folder_of(url: str) -> str:
    """The URL up to its last path slash, without query or fragment."""
    path = f"regexp_extract({url}, {quoted(_PATH)}, 1)"
    return (
        f"coalesce(nullif(regexp_extract({path}, {quoted(_FOLDER)}, 1), ''), "
        f"concat({origin_of(url)}, '/'))"
    )


def resolve(target: str, base: str) -> str:
    """Absolute form of a link target; stays as written without a base."""
    return (
        f"coalesce(CASE WHEN {target} RLIKE {quoted(_SCHEME)} THEN {target} "
        f"WHEN {target} LIKE '//%' THEN concat({scheme_of(base)}, {target}) "
        f"WHEN {target} LIKE '/%' THEN concat({origin_of(base)}, {target}) "
        f"WHEN {target} LIKE '#%' OR {target} = '' THEN concat(substring_index({base}, '#', 1), {target}) "
        f"WHEN {target} LIKE '?%' THEN "
        f"concat(substring_index(substring_index({base}, '#', 1), '?', 1), {target}) "
        f"ELSE concat({folder_of(base)}, {target}) END, {target})"
    )


def absolutize(markup: str, base: str) -> str:
    """Rewrite quoted ``href`` / ``src`` values in markup against ``base``."""
    attr = r"""(?i)([ \t\r\n\f](?:href|src)[ \t\r\n\f]*=[ \t\r\n\f]*["'])"""
    # what is still relative after the first two rewrites has neither a colon
    # before its first slash nor a leading slash, hash or question mark
    relative = attr + r"""([^"'/#?:][^"':/?#]*[/?#"'])"""
    x = f"regexp_replace({markup}, {quoted(attr + '//')}, concat('$1', {scheme_of(base)}, '//'))"
    x = f"regexp_replace({x}, {quoted(attr + '/([^/])')}, concat('$1', {origin_of(base)}, '/$2'))"
    x = f"regexp_replace({x}, {quoted(relative)}, concat('$1', {folder_of(base)}, '$2'))"
    return f"CASE WHEN {origin_of(base)} IS NOT NULL THEN {x} ELSE {markup} END"
