"""Regular expressions and fixed word lists for raw markup.

Patterns are linear on hostile input: a tag scan stops at the next angle
bracket unless it is inside a quoted attribute value, alternatives are told
apart by their first character, and repeated groups are possessive, which Java
runs as a loop, so the matcher neither backtracks nor recurses however many
attributes a tag has.
"""

from __future__ import annotations

from html.entities import html5

WS = r"[ \t\r\n\f]"
_ASSIGNED = rf"""={WS}*+(?:"[^"]*+"|'[^']*+'|[^<>"'= \t\r\n\f])[^<>=]*+"""
_ATTRS = rf"[^<>=]*+(?:{_ASSIGNED})*+"

# One tag of any name: quote-aware first, then up to the next bracket.
ANY_TAG = rf"<[a-zA-Z/!?]{_ATTRS}>|<[a-zA-Z/!?][^<>]*>"
# Tag, text run, or a lone bracket; covers every character of the markup.
TOKEN = rf"{ANY_TAG}|[^<]+|<"
LINE_BREAK = rf"(?i)<br(?:{WS}[^<>]*|/)?>"
BLANKS = "[ \\t\\r\\n\\f\u00a0]+"

# Marks that segment the markup; removed from the input first.
SEGMENT, PART, TAIL = "\x01", "\x02", "\x03"
KEEP_OPEN, KEEP_CLOSE = "\x04", "\x05"
MARK_OPEN, MARK_CLOSE = "\x06", "\x07"
MARKS = SEGMENT + PART + TAIL + KEEP_OPEN + KEEP_CLOSE + MARK_OPEN + MARK_CLOSE

# Elements whose whole content is dropped before tokenizing.
DROPPED_ELEMENTS = ("script", "style", "noscript", "template", "iframe", "svg")
# A tail that closes whatever a page left open, so an unclosed comment or
# script runs to the end of the page once instead of being rescanned.
CLOSING_TAIL = TAIL + "-->" + "".join(f"</{name}>" for name in DROPPED_ELEMENTS)
DROPPED = (
    r"(?is)<(?:!--.*?-->|"
    + "|".join(rf"{name}[ \t\r\n\f/>].*?</{name}[^<>]*>" for name in DROPPED_ELEMENTS)
    + rf")|{TAIL}.*"
)

BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd",
    "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option",
    "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "title", "tr", "ul",
)
# Elements that never have an end tag.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
)
# Elements whose end tag may be left out: the next tag of the same name ends them.
OPTIONAL_END_TAGS = (
    "dd", "dt", "li", "optgroup", "option", "p", "tbody", "td", "tfoot", "th", "thead", "tr",
)
HEADING_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6")
# Elements that stay around the blocks inside them in the HTML stream.
NESTING_TAGS = ("blockquote", "dl", "ol", "table", "tr", "ul")
# Inline elements that stay in the HTML stream, without attributes.
INLINE_MARKS = ("b", "code", "del", "em", "i", "ins", "kbd", "q", "s", "strong", "sub", "sup", "u")
# So many inline elements inside each other are kept; of more the outer ones go.
MARK_DEPTH = 4
# Block tags that keep their own name in the HTML stream; others become div.
OUTPUT_TAGS = (*HEADING_TAGS, "caption", "dd", "dt", "figcaption", "li", "p", "pre", "td", "th")


def block_tag(names: tuple[str, ...] | None = BLOCK_TAGS) -> str:
    """A tag of one of ``names`` (any name when ``None``): slash, name, attributes."""
    name = "[a-zA-Z][a-zA-Z0-9]*" if names is None else "|".join(names)
    return rf"(?i)<(/?)({name})((?:[ \t\r\n\f/]{_ATTRS}|[ \t\r\n\f/][^<>]*)?)>"


def named_tag(name: str) -> str:
    """An opening tag of one name, whole match."""
    return rf"(?i)<{name}(?:[ \t\r\n\f/]{_ATTRS}|[ \t\r\n\f/][^<>]*)?>"


def attribute(name: str) -> str:
    """Raw value (with its quotes) of the first attribute of one of the names, group 1.

    Read from the tag's start, attribute by attribute, so that neither the text
    nor the names inside another value can match.  The input begins with ``<``
    and the tag's name, or with a blank and the attributes.
    """
    value = rf"""(?:"[^"]*+"|'[^']*+'|[^ \t\r\n\f>]++)"""
    gap, equals = r"[ \t\r\n\f/]", rf"{WS}*+={WS}*+"
    wanted = rf"(?:{name}){equals}"
    other = rf"[^ \t\r\n\f/>=]++(?:{equals}{value}?+)?+"
    return rf"(?i)^(?:<[^ \t\r\n\f/>]*+)?+(?:{gap}++(?!{wanted})(?:{other}|=))*+{gap}++{wanted}({value})"


ANCHOR_TEXT = rf"(?is)<a(?:[ \t\r\n\f]{_ATTRS}|[ \t\r\n\f][^<>]*)?>(.*?)</a"
ANCHOR_OPEN = r"(?i)<a[ \t\r\n\f>]"
ANCHOR_CLOSE = r"(?i)</a[ \t\r\n\f>]"
# A tag of a kept inline element; and, of tags that are marked, two that match with no other one between them.
MARK_TAG = rf"(?i)<(/?)({'|'.join(INLINE_MARKS)})(?:[ \t\r\n\f]{_ATTRS}|[ \t\r\n\f][^<>]*)?/?>"
MARKED = f"{MARK_OPEN}[^{MARK_OPEN}{MARK_CLOSE}]*{MARK_CLOSE}"
MARK_PAIR = (
    rf"(?i){MARK_OPEN}({'|'.join((*INLINE_MARKS, 'a'))})(|[ \t\r\n\f][^{MARK_OPEN}{MARK_CLOSE}]*){MARK_CLOSE}"
    rf"([^{MARK_OPEN}{MARK_CLOSE}]*+){MARK_OPEN}/\1{WS}*{MARK_CLOSE}"
)
EMPTY_NEST = rf"<({'|'.join(NESTING_TAGS)})></\1>"
KEPT_LINK = rf"(?i)<(a(?:[ \t\r\n\f]{_ATTRS}|[ \t\r\n\f][^<>]*)?|/a{WS}*)>"
KEPT_IMAGE = rf"(?i)<(img(?:[ \t\r\n\f/]{_ATTRS}|[ \t\r\n\f/][^<>]*)?)>"
JSON_LD = r"""(?is)<script[^<>]*application/ld\+json[^<>]*>(.*?)</script"""

# Class / id words that mark page furniture and reader comments, matched
# against ' class id ' in lower case.  A furniture word has to begin a class or
# id: ``sidebar-left`` is one, ``has-sidebar`` only says that there is one.  The
# choice of words is ours.
CHROME_WORDS = (
    r" (?:ad|ads|advert|advertisement|banner|breadcrumbs?|cookie|newsletter|pagination"
    r"|popup|promo|promoted|related|share|sharing|sidebar|social|sponsored|subscribe|widget)[ _-]"
)
CONTENT_WORDS = (
    r"[ _-](?:article|entry|post|story|page|main)[_-]?(?:body|content|text)[ _-]| articlebody "
)
COMMENT_WORDS = r"[ _-]comments?[ _-]| comment-?(?:list|section|thread|area)s? | disqus"
TEASER_WORDS = r"[ _-]teasers?[ _-]"
BOTTOM_WORDS = r"[ _-]bottom[_-]?links?[ _-]"

# Named character references: all of the HTML standard that end in a semicolon.
ENTITIES = tuple(sorted((f"&{name}", char) for name, char in html5.items() if name.endswith(";")))

# Frequent function words per language; the choice of words is ours. Words
# that two of these languages share are left out.
STOP_WORDS = {
    "de": ("aber", "auch", "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für",
           "ich", "ist", "mit", "nicht", "sich", "sie", "und", "von", "werden", "wie", "zu"),
    "en": ("and", "are", "as", "at", "be", "by", "for", "from", "have", "is", "it", "not",
           "of", "on", "that", "the", "they", "this", "to", "was", "were", "with"),
    "es": ("como", "con", "del", "el", "ella", "esta", "las", "lo", "los", "más", "muy",
           "para", "pero", "por", "que", "se", "sin", "sobre", "su", "una", "y"),
    "fr": ("au", "aux", "avec", "ce", "dans", "du", "elle", "est", "et", "il", "le",
           "les", "nous", "ou", "pas", "pour", "qui", "sur", "une", "vous"),
}
