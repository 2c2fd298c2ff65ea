"""Extraction options: a frozen, validated, plan-time record.

Validation happens once on the driver and is the only thing that raises.
Nothing that arrives in page data can raise; it becomes a ledger reason.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields
from typing import Any

DEFAULT_MAX_INPUT_BYTES = 10 * 1024 * 1024
UNLIMITED = math.inf
FOCUS_LEVELS = ("favor_precision", "balanced", "favor_recall")

_BOOLEAN_KEYS = (
    "exclude_comments",
    "exclude_tables",
    "include_links",
    "include_images",
    "enable_fallback",
    "has_essential_metadata",
    "deduplicate",
)
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*:\S+")
_LANGUAGE = re.compile(r"[a-zA-Z]{2}")

# Options whose value may differ between the option sets of one sweep: they
# only act on block rows, after the shared tokenizing work is done.
SWEEPABLE_KEYS = (
    "focus",
    "exclude_comments",
    "exclude_tables",
    "include_links",
    "include_images",
    "enable_fallback",
)


class OptionError(ValueError):
    """The caller passed a wrong option; the message names the key."""


@dataclass(frozen=True)
class ExtractOptions:
    """The thirteen extraction keys, plus our cross-page ``deduplicate``."""

    focus: str = "balanced"
    exclude_comments: bool = False
    exclude_tables: bool = False
    include_links: bool = False
    include_images: bool = False
    enable_fallback: bool = False
    target_language: str | None = None
    has_essential_metadata: bool = False
    original_url: str | None = None
    prune_selector: str | None = None
    excluded_authors: tuple[str, ...] = ()
    html_date_override: dt.date | None = None
    max_input_bytes: int | float = DEFAULT_MAX_INPUT_BYTES
    deduplicate: bool = False

    def __post_init__(self) -> None:
        if self.focus not in FOCUS_LEVELS:
            raise OptionError(f"focus: expected one of {FOCUS_LEVELS}, got {self.focus!r}")
        for key in _BOOLEAN_KEYS:
            if not isinstance(getattr(self, key), bool):
                raise OptionError(f"{key}: expected a boolean, got {getattr(self, key)!r}")
        for key in ("target_language", "original_url", "prune_selector"):
            value = getattr(self, key)
            if value is not None and not isinstance(value, str):
                raise OptionError(f"{key}: expected a string or None, got {value!r}")
        language = self.target_language
        if language is not None and not _LANGUAGE.fullmatch(language):
            raise OptionError(f"target_language: expected a two-letter code such as 'en', got {language!r}")
        if self.original_url is not None and not _SCHEME.fullmatch(self.original_url):
            raise OptionError(
                f"original_url: expected an absolute URL with a scheme, got {self.original_url!r}"
            )
        authors = self.excluded_authors
        if not isinstance(authors, (list, tuple)) or not all(isinstance(a, str) for a in authors):
            raise OptionError(f"excluded_authors: expected a list of strings, got {authors!r}")
        object.__setattr__(self, "excluded_authors", tuple(authors))
        day = self.html_date_override
        if day is not None and (not isinstance(day, dt.date) or isinstance(day, dt.datetime)):
            raise OptionError(f"html_date_override: expected a date or None, got {day!r}")
        cap = self.max_input_bytes
        whole = isinstance(cap, int) and not isinstance(cap, bool) and cap > 0
        if not whole and not (isinstance(cap, float) and cap == UNLIMITED):
            raise OptionError(
                f"max_input_bytes: expected a positive integer or UNLIMITED, got {cap!r}"
            )

    @classmethod
    def of(
        cls,
        options: "ExtractOptions | Mapping[str, Any] | Iterable[tuple[str, Any]] | None" = None,
        **overrides: Any,
    ) -> "ExtractOptions":
        """Build options from a record, a mapping, or key/value pairs.

        Unknown and repeated keys raise, whatever their value.
        """
        if isinstance(options, cls) and not overrides:
            return options
        if isinstance(options, cls):
            pairs = [(f.name, getattr(options, f.name)) for f in fields(cls) if f.name not in overrides]
        elif options is None:
            pairs = []
        elif isinstance(options, Mapping):
            pairs = list(options.items())
        elif isinstance(options, (str, bytes)):
            raise TypeError("options must be a mapping or key/value pairs")
        else:
            pairs = list(options)
            if not all(isinstance(p, tuple) and len(p) == 2 for p in pairs):
                raise TypeError("expected key/value pairs")
        chosen: dict[str, Any] = {}
        known = {f.name for f in fields(cls)}
        for key, value in [*pairs, *overrides.items()]:
            if key not in known or key in chosen:
                fault = "given twice" if key in chosen else f"not an option; there are {', '.join(sorted(known))}"
                raise OptionError(f"{key}: {fault}")
            chosen[key] = value
        return cls(**chosen)

    @property
    def byte_cap(self) -> int | None:
        """The size cap as a table value: ``None`` means no cap."""
        return None if self.max_input_bytes == UNLIMITED else int(self.max_input_bytes)

    def sql(self, key: str) -> str:
        """The option as a SQL literal, so constant folding drops dead branches."""
        value = getattr(self, key)
        return str(value).lower() if isinstance(value, bool) else f"'{value}'"

    def possible(self, key: str) -> bool:
        """Whether a boolean option can be true anywhere in this run."""
        return bool(getattr(self, key))


@dataclass(frozen=True)
class SweptOptions:
    """Options read per row from a struct column, for many sets in one job."""

    struct_name: str = "opt"
    never: tuple[str, ...] = ()
    """Keys that no set of the sweep turns on."""

    def sql(self, key: str) -> str:
        if key not in SWEEPABLE_KEYS:
            raise OptionError(f"{key}: cannot differ between the option sets of a sweep")
        return f"{self.struct_name}.{key}"

    def possible(self, key: str) -> bool:
        return key in SWEEPABLE_KEYS and key not in self.never
