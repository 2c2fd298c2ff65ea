"""Publication dates: the publisher's own calendar day, plausible years only."""

from __future__ import annotations

from pagewinnow.functions.text import quoted

FIRST_PLAUSIBLE_YEAR = 1995
_DASHED = r"^\s*(\d{4})[-/](\d{2})[-/](\d{2})(?:$|[^0-9].*)"
_COMPACT = r"^\s*(\d{4})(\d{2})(\d{2})(?:$|[T\s].*)"
_DAY = r"^\d{4}-\d{2}-\d{2}$"


# Month first and day first, after up to two words such as a weekday; names are looked up below.
_MONTH_DAY = r"^\s*(?:\p{L}+[.,]*\s+)?(\p{L}{3,10})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})(?!\d)"
_DAY_MONTH = (
    r"^\s*(?:\p{L}+[.,]*\s+){0,2}(\d{1,2})(?:st|nd|rd|th|er|º|\.)?\s+(?:de\s+|of\s+)?"
    r"(\p{L}{3,10})\.?,?\s+(?:de\s+|del\s+)?(\d{4})(?!\d)"
)
# Month names and their short forms in English, German, French and Spanish.
MONTHS = {
    1: "january jan januar jänner janvier janv enero ene",
    2: "february feb februar février févr fevrier febrero",
    3: "march mar märz maerz mrz mars marzo",
    4: "april apr avril avr abril abr",
    5: "may mai mayo",
    6: "june jun juni juin junio",
    7: "july jul juli juillet juil julio",
    8: "august aug août aout agosto ago",
    9: "september sep sept septembre septiembre setiembre",
    10: "october oct oktober okt octobre octubre",
    11: "november nov novembre noviembre",
    12: "december dec dezember dez décembre déc decembre diciembre dic",
}
_MONTH_TABLE = "map({})".format(", ".join(f"{quoted(w)}, '{n:02}'" for n, words in MONTHS.items() for w in words.split()))
# A day in a path: /2020/03/09/ or /2020-03-09
_IN_PATH = r"^[^?#]*?/((?:19|20)\d{2})([-/])(\d{1,2})\2(\d{1,2})(?![^/?#.\-_])"


def publication_day(x: str) -> str:
    """Day of a date or timestamp string; junk and implausible years are NULL.

    Read are ISO dates, compact ones, and days with a month's name in one of
    four languages.  The day is read as written, so an offset never moves it.
    """
    written = (
        f"regexp_replace(regexp_replace(d, {quoted('(?s)' + _DASHED)}, '$1-$2-$3'), "
        f"{quoted('(?s)' + _COMPACT)}, '$1-$2-$3')"
    )

    def named(pattern: str, day: int, month: int) -> str:
        part = lambda i: f"regexp_extract(d, {quoted(pattern)}, {i})"
        return f"concat({part(3)}, '-', try_element_at({_MONTH_TABLE}, lower({part(month)})), '-', lpad({part(day)}, 2, '0'))"

    iso = f"CASE WHEN d RLIKE {quoted(_DAY)} THEN d WHEN d RLIKE '[0-9]{{4}}' AND d RLIKE '\\\\p{{L}}{{3}}' THEN "
    spelled = f"{iso} coalesce({named(_MONTH_DAY, 2, 1)}, {named(_DAY_MONTH, 1, 2)}) END"
    day = "try_cast(d AS date)"
    plausible = f"year(d) BETWEEN {FIRST_PLAUSIBLE_YEAR} AND year(current_date()) + 1"
    return (
        f"get(filter(transform(transform(transform(array({x}), d -> {written}), d -> {spelled}), d -> {day}), "
        f"d -> {plausible}), 0)"
    )


def day_in_path(url: str) -> str:
    """The first day that a URL's path spells out, as an ISO date, or ``''``."""
    part = lambda i: f"regexp_extract(u, {quoted(_IN_PATH)}, {i})"
    return (
        f"get(transform(array(coalesce({url}, '')), u -> CASE WHEN {part(1)} <> '' "
        f"THEN concat({part(1)}, '-', lpad({part(3)}, 2, '0'), '-', lpad({part(4)}, 2, '0')) ELSE '' END), 0)"
    )
