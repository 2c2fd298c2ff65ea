"""Encoding checks on raw bytes (SQL text)."""

from __future__ import annotations

REPLACEMENT = "\ufffd"
# Another three-byte character, standing in for a genuine U+FFFD so that the
# first replacement character after repair is the first bad sequence.
STAND_IN = "\ue000"
BYTE_ORDER_MARK = "\ufeff"


def is_utf8(raw: str) -> str:
    return f"is_valid_utf8(cast({raw} AS string))"


def first_bad_byte(raw: str) -> str:
    """0-based byte offset of the first invalid sequence; NULL when valid."""
    masked = f"make_valid_utf8(replace(cast({raw} AS string), '{REPLACEMENT}', '{STAND_IN}'))"
    offset = f"octet_length(substring_index({masked}, '{REPLACEMENT}', 1))"
    return f"CASE WHEN NOT {is_utf8(raw)} THEN cast({offset} AS bigint) END"


def repaired(raw: str) -> str:
    """Invalid sequences replaced by U+FFFD."""
    return f"make_valid_utf8(cast({raw} AS string))"


def without_bom(text: str) -> str:
    return f"CASE WHEN startswith({text}, '{BYTE_ORDER_MARK}') THEN substr({text}, 2) ELSE {text} END"
