"""The thirteen metadata fields, as a narrow projection over the page row.

Sources are ranked in one table.  Candidates of a page are a small array of
``(field, rank, pos, value)``; the winner of a field is the smallest usable
candidate.  The page row already holds every source, so the job needs no
shuffle: the rank table is a literal map, not a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions import patterns as P
from pagewinnow.functions.dates import day_in_path, publication_day
from pagewinnow.functions.text import (
    attribute,
    blank_to_null,
    listed,
    quoted,
    squash,
    strip_tags,
    unescape,
)
from pagewinnow.functions.urls import host_of, resolve
from pagewinnow.operators.markup import clean_markup

FIELDS = (
    "title", "author", "url", "hostname", "description", "sitename", "date",
    "categories", "tags", "license", "language", "image", "page_type",
)
LIST_FIELDS = ("categories", "tags")

# Source precedence per field, best first; the order is ours.  ``ld:`` is a
# JSON-LD property, ``dom:`` an element and ``url:`` a part of the page's URL, the rest are meta keys.
SOURCES = {
    "title": ("og:title", "twitter:title", "dc.title", "ld:headline", "dom:title", "dom:h1"),
    "author": ("author", "article:author", "dc.creator", "ld:author"),
    "url": ("og:url", "dom:canonical"),
    "description": ("description", "og:description", "twitter:description", "dc.description", "ld:description"),
    "sitename": ("og:site_name", "application-name", "ld:publisher"),
    "date": ("article:published_time", "og:published_time", "datepublished", "date", "dc.date", "ld:datePublished", "dom:time", "url:path"),
    "categories": ("article:section", "ld:articleSection"),
    "tags": ("keywords", "news_keywords", "article:tag", "ld:keywords"),
    "license": ("dom:license", "dc.rights", "copyright"),
    "language": ("dom:lang", "content-language", "dc.language", "og:locale"),
    "image": ("og:image", "twitter:image", "ld:image"),
    "page_type": ("og:type", "ld:@type"),
}
RANKED = [
    (source, field, rank) for field, sources in SOURCES.items() for rank, source in enumerate(sources)
]
_TITLE = r"(?is)<title(?:[ \t\r\n\f][^<>]*)?>(.*?)</title"
_H1 = r"(?is)<h1(?:[ \t\r\n\f][^<>]*)?>(.*?)</h1"
_TIME = r"(?is)<time(?:[ \t\r\n\f][^<>]*)?>(.*?)</time"
_SOMETHING = r"\S"
_TEXT = "coalesce(html, '')"
_NAME_BREAK = r"\s*;\s*"
_PRIMARY_SUBTAG = r"^([a-zA-Z]{2,3})(?:$|[-_,; ])"
# Properties of a linked-data item, and where the plain value of an object lies.
_LD_INSIDE = {
    "headline": ("name",),
    "author": ("name",),
    "description": ("name",),
    "publisher": ("name",),
    "datePublished": ("@value",),
    "articleSection": ("name",),
    "keywords": ("name",),
    "image": ("url", "contentUrl", "@id"),
    "@type": ("@id",),
}
# Where the value of an object that is only named, by its ``@id``, lies in the object that has that name.
_LD_TARGET = {("name",): "name", ("url", "contentUrl", "@id"): "media"}
# Objects of a page that can be referred to, the first ones in document order; it bounds the work on
# hostile pages.  So many doublings follow any chain between them to its end.
MOST_TARGETS, _DOUBLINGS = 1000, 10
# Several values of these are kept, joined; of the others the first one counts.
_LD_JOINED = {"author": "; ", "articleSection": ",", "keywords": ","}
# Items that describe the page's own text come before those about its site.
_ARTICLE_TYPE = r"(?i)(?:article|posting|report|story|recipe|review|news)\b"


def head_of(html: str) -> str:
    """The markup that meta elements, links and the title are read from.

    All of the page: a meta element counts wherever it stands.  Comments,
    scripts and styles are out, so nothing inside them is taken for one.
    """
    return clean_markup(html)


def meta_array(head: str) -> str:
    """``array<struct<key, value>>`` of every meta element, in document order."""
    tags = f"regexp_extract_all({head}, {quoted(P.named_tag('meta'))}, 0)"
    key = f"trim(lower({attribute('t', 'property|name|itemprop|http-equiv')}))"
    pair = f"struct({key} AS key, {attribute('t', 'content')} AS value)"
    return f"filter(transform({tags}, t -> {pair}), m -> m.key <> '')"


def meta_pairs(pages: DataFrame) -> DataFrame:
    """All meta elements as long rows: ``page_id, pos, key, value``."""
    return pages.selectExpr(
        "page_id", f"posexplode({meta_array(head_of('html'))}) AS (pos, meta)"
    ).selectExpr("page_id", "pos", "meta.key", f"{squash(unescape('meta.value'))} AS value")


def _first_element(markup: str, pattern: str, name: str) -> str:
    """Content of the first element matching a pattern, to the end if unclosed.

    The end tag put behind the markup makes the first opening tag match, so an
    unclosed element is not searched for again from every later one.
    """
    return f"regexp_extract(concat({markup}, '</{name}>'), {quoted(pattern)}, 1)"


def _ld_blocks(html: str) -> str:
    """Array of the JSON-LD texts of a page, NULL without any."""
    found = f"regexp_extract_all(concat({html}, '</script>'), {quoted(P.JSON_LD)}, 1)"
    return f"CASE WHEN contains({html}, 'ld+json') THEN nullif({found}, cast(array() AS array<string>)) END"


def _ld_whole(blocks: str) -> str:
    """The JSON of the items of all blocks, lists and graphs, in document order."""
    some = lambda x: f"coalesce(from_json({x}, 'array<string>'), cast(array() AS array<string>))"
    top = f"flatten(transform({blocks}, j -> CASE WHEN ltrim(j) LIKE '[%' THEN {some('j')} ELSE array(j) END))"
    graph = quoted("$['@graph']")
    return f"flatten(transform({top}, j -> concat(array(j), {some(f'get_json_object(j, {graph})')})))"


def _ld_items(whole: str) -> str:
    """Items as one array, articles first, then in document order.

    Every property is kept as written: plain text, or the JSON of a list or object.
    """
    schema = ", ".join(f"`{name}` STRING" for name in _LD_INSIDE)
    parsed = f"transform({whole}, (j, i) -> struct(i AS i, from_json(j, {quoted(schema)}) AS item))"
    known = f"filter({parsed}, x -> x.item IS NOT NULL)"
    first = f"CASE WHEN coalesce(x.item.`@type`, '') RLIKE {quoted(_ARTICLE_TYPE)} THEN 0 ELSE 1 END"
    return f"transform(array_sort(transform({known}, x -> struct({first} AS later, x.i AS i, x.item AS item))), x -> x.item)"


def _json(x: str, key: str) -> str:
    path = quoted(f"$['{key}']")
    return f"trim(get_json_object({x}, {path}))"


def _is_object(x: str) -> str:
    return f"({x} LIKE '{{%' AND {x} LIKE '%}}')"


def _ld_targets(whole: str) -> str:
    """``map<@id, struct<name, media>>`` of the objects that a page refers to; NULL where nothing is referred to.

    Objects count where they are items, and one level below, as values of a
    property.  Of those with one ``@id`` each value is taken from the first that
    has it.  A value may be a reference again: names are followed from object to
    object, each round doubling the way, until every chain has ended.  A chain
    that leads back to itself, or to an object that the page lacks, has no value.
    """
    inner = (
        f"flatten(transform({whole}, j -> flatten(transform(filter(coalesce(map_values(from_json(j, 'map<string,string>')), "
        "cast(array() AS array<string>)), v -> contains(v, '@id')), v -> CASE WHEN ltrim(v) LIKE '[%' "
        "THEN coalesce(from_json(v, 'array<string>'), cast(array() AS array<string>)) ELSE array(v) END))))"
    )
    objects = f"filter(concat({whole}, {inner}), o -> contains(o, '@id'))"

    def known(value: str) -> str:
        """Plain text of a value, or where it leads."""
        leads = f"CASE WHEN {_is_object('v.v')} AND {_json('v.v', '@value')} IS NULL THEN {_json('v.v', '@id')} END"
        plain = f"CASE WHEN {_is_object('v.v')} THEN {_json('v.v', '@value')} ELSE v.v END"
        return f"get(transform(array(struct({value} AS v)), v -> struct(nullif({plain}, '') AS text, {leads} AS next)), 0)"

    named = (
        f"filter(transform({objects}, o -> struct({_json('o', '@id')} AS id, {known(_json('o', 'name'))} AS name, "
        f"{known('coalesce(' + _json('o', 'url') + ', ' + _json('o', 'contentUrl') + ')')} AS media)), "
        "x -> x.id <> '' AND (x.name.text IS NOT NULL OR x.name.next IS NOT NULL OR x.media.text IS NOT NULL OR x.media.next IS NOT NULL))"
    )
    # (id, value, next) of each kind; the first object of a name that has a value counts
    chains = (
        "flatten(transform(array('name', 'media'), k -> transform(filter(_named, x -> CASE k WHEN 'name' "
        "THEN coalesce(x.name.text, x.name.next) ELSE coalesce(x.media.text, x.media.next) END IS NOT NULL), "
        "x -> struct(concat(k, ' ', x.id) AS id, CASE k WHEN 'name' THEN x.name.text ELSE x.media.text END AS text, "
        "CASE k WHEN 'name' THEN concat(k, ' ', x.name.next) ELSE concat(k, ' ', x.media.next) END AS next))))"
    ).replace("_named", f"slice({named}, 1, {MOST_TARGETS})")
    fields = "struct(e.text AS text, e.next AS next)"
    first = (
        f"transform(array(struct({chains} AS c)), q -> transform(q.c, (e, i) -> struct(e.id AS id, {fields} AS value, "
        "array_position(transform(q.c, y -> y.id), e.id) = i + 1 AS first)))"
    )
    table = f"map_from_entries(transform(filter(get({first}, 0), e -> e.first), e -> struct(e.id, e.value)))"
    onward = "try_element_at(m, v.next)"
    step = (
        "transform_values(m, (k, v) -> CASE WHEN v.text IS NOT NULL OR v.next IS NULL THEN v "
        f"ELSE coalesce({onward}, struct(cast(NULL AS string) AS text, cast(NULL AS string) AS next)) END)"
    )
    settled = f"aggregate(sequence(1, {_DOUBLINGS}), {table}, (m, i) -> CASE WHEN exists(map_values(m), v -> v.text IS NULL AND v.next IS NOT NULL) THEN {step} ELSE m END)"
    return f"CASE WHEN exists({whole}, j -> contains(j, '@id')) THEN transform_values({settled}, (k, v) -> v.text) END"


def _ld_value(items: str, name: str, targets: str) -> str:
    """The property of the first item that has it; lists and named objects count with all their values.

    An object that has no value of its own but an ``@id`` has that of the object
    it refers to.
    """
    raw = f"filter(transform({items}, x -> trim(x.`{name}`)), v -> v <> '')"
    parts = "CASE WHEN v LIKE '[%' THEN coalesce(from_json(v, 'array<string>'), array(v)) ELSE array(v) END"
    keys = _LD_INSIDE[name]
    own = [_json("e", k) for k in keys if k != "@id" or len(keys) == 1]
    # a name can be an object again: its value, or where it leads
    own = [f"CASE WHEN {_is_object(x)} THEN {_json(x, '@value')} ELSE {x} END" if k == "name" else x for k, x in zip(keys, own)]
    if keys in _LD_TARGET:
        kind = _LD_TARGET[keys]
        leads = f"coalesce({_json(_json('e', 'name'), '@id')}, {_json('e', '@id')})" if kind == "name" else _json("e", "@id")
        own.append(f"CASE WHEN {targets} IS NOT NULL THEN try_element_at({targets}, concat('{kind} ', {leads})) END")
    own += [_json("e", "@id")] if "@id" in keys and len(keys) > 1 else []
    plain = f"CASE WHEN {_is_object('e')} THEN coalesce({', '.join(own)}, '') ELSE e END"
    values = f"transform({raw}, v -> filter(transform({parts}, e -> trim({plain})), e -> e <> ''))"
    found = f"get(filter({values}, l -> size(l) > 0), 0)"
    return f"array_join({found}, '{_LD_JOINED[name]}')" if name in _LD_JOINED else f"get({found}, 0)"


def jsonld_fields(pages: DataFrame) -> DataFrame:
    """``page_id, title, author, date, type`` of pages with JSON-LD blocks."""
    named = {"title": "headline", "author": "author", "date": "datePublished", "type": "@type"}
    return (
        pages.selectExpr("page_id", f"{_ld_blocks('html')} AS _ld")
        .where("_ld IS NOT NULL")
        .selectExpr("page_id", f"{_ld_whole('_ld')} AS _whole")
        .selectExpr("page_id", f"{_ld_items('_whole')} AS _items", f"{_ld_targets('_whole')} AS _targets")
        .selectExpr("page_id", *[f"{squash(_ld_value('_items', n, '_targets'))} AS {a}" for a, n in named.items()])
    )


def _link_href(head: str, rel: str) -> str:
    links = f"regexp_extract_all({head}, {quoted(P.named_tag('link'))}, 0)"
    named = f"filter({links}, t -> lower({attribute('t', 'rel')}) = '{rel}')"
    return attribute(f"get({named}, 0)", "href")


def metadata_candidates(pages: DataFrame, carry: list[str], fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Add ``_cands``: array of ``(field, rank, pos, value)`` for each page.

    Sources that only other fields have are not looked at.
    """
    elements = {
        "dom:title": _first_element("_head", _TITLE, "title"),
        "dom:h1": strip_tags("_h1"),
        "dom:canonical": _link_href("_head", "canonical"),
        "dom:license": _link_href("_head", "license"),
        "dom:lang": attribute("_root", "lang"),
        "dom:time": f"coalesce(nullif({attribute('_time', 'datetime')}, ''), {strip_tags('_time_text')})",
        "url:path": day_in_path("_supplied"),
        **{f"ld:{name}": _ld_value("_items", name, "_targets") for name in _LD_INSIDE},
    }
    from_elements = ", ".join(
        f"struct('{field}' AS field, {rank} AS rank, 0 AS pos, {elements[source]} AS value)"
        for source, field, rank in RANKED
        if source in elements and field in fields
    )
    ranks = ", ".join(
        f"'{source}', struct('{field}' AS field, {rank} AS rank)"
        for source, field, rank in RANKED
        if source not in elements and field in fields
    )
    from_meta = (
        "transform(transform(_metas, (m, i) -> struct(try_element_at(_ranks, m.key) AS r, i AS i, m.value AS v)), "
        "x -> struct(x.r.field AS field, x.r.rank AS rank, x.i AS pos, x.v AS value))"
    ).replace("_ranks", f"map({ranks})")
    usable = f"c -> c.field IS NOT NULL AND c.value RLIKE {quoted(_SOMETHING)}"
    return (
        pages.selectExpr(
            *carry,
            f"{head_of('html')} AS _head",
            f"CASE WHEN contains(html, 'ld+json') THEN {_ld_whole(_ld_blocks('html'))} END AS _ld",
            f"{_first_element(_TEXT, _H1, 'h1')} AS _h1",
            f"regexp_extract(coalesce(html, ''), {quoted(P.named_tag('html'))}, 0) AS _root",
        )
        .selectExpr(
            "*",
            f"regexp_extract(_head, {quoted(P.named_tag('time'))}, 0) AS _time",
            f"{_first_element('_head', _TIME, 'time')} AS _time_text",
        )
        .selectExpr("*", f"{meta_array('_head')} AS _metas", f"{_ld_items('_ld')} AS _items", f"{_ld_targets('_ld')} AS _targets")
        .selectExpr(*carry, f"filter(concat({from_meta}, array({from_elements})), {usable}) AS _cands")
    )


def _best(field: str) -> str:
    """Value of the best-ranked candidate of a field, earliest first."""
    found = f"filter(_cands, c -> c.field = {field})"
    return f"array_min(transform({found}, c -> struct(c.rank, c.pos, c.value AS value))).value"


def _of_best_source(field: str) -> str:
    """Values of the best-ranked source in document order."""
    found = f"filter(_cands, c -> c.field = '{field}')"
    best = f"array_min(transform({found}, c -> c.rank))"
    ordered = f"array_sort(transform(filter({found}, c -> c.rank = {best}), c -> struct(c.pos, c.value AS value)))"
    return f"transform({ordered}, c -> c.value)"


def _joined_authors() -> str:
    """All names of the best-ranked source, each once."""
    people = f"split(array_join({_of_best_source('author')}, '; '), {quoted(_NAME_BREAK)})"
    named = f"array_distinct(filter(transform({people}, a -> {squash(unescape('a'))}), a -> a <> ''))"
    return f"nullif(array_join({named}, '; '), '')"


def _all_of_best_source(field: str) -> str:
    """Values of the best-ranked source, split at commas, blanks dropped."""
    items = f"split(array_join({_of_best_source(field)}, ','), ',')"
    return f"filter(transform({items}, x -> {squash(unescape('x'))}), x -> x <> '')"


def _best_date() -> str:
    """Best-ranked candidate that is a plausible day; junk is passed over."""
    found = "filter(_cands, c -> c.field = 'date')"
    dated = f"transform({found}, c -> struct(c.rank, c.pos, {publication_day('c.value')} AS day))"
    return f"array_min(filter({dated}, c -> c.day IS NOT NULL)).day"


def exclude_authors(author: str, names: tuple[str, ...]) -> str:
    """Drop names, ignoring case; NULL when nobody is left."""
    if not names:
        return author
    lowered = listed(n.strip().lower() for n in names)
    people = f"split({author}, {quoted(_NAME_BREAK)})"
    return f"nullif(array_join(filter({people}, a -> lower(trim(a)) NOT IN ({lowered})), '; '), '')"


def supplied_url(pages: DataFrame, options) -> str:
    """The URL a page was fetched from: the option, else the table's column."""
    own = blank_to_null("url") if "url" in pages.columns else "cast(NULL AS string)"
    return own if options.original_url is None else quoted(options.original_url)


def document_url(pages: DataFrame, options, carry: tuple[str, ...] = ()) -> DataFrame:
    """Add ``base``: the URL that ``metadata_fields`` gives, without the other fields."""
    kept = list(dict.fromkeys(["page_id", *carry]))
    with_base = pages.withColumn("_supplied", F.expr(supplied_url(pages, options)))
    cands = metadata_candidates(with_base, [*kept, "_supplied"], ("url",))
    found = f"get(transform(array({_best(quoted('url'))}), v -> {blank_to_null(squash(unescape('v')))}), 0)"
    return cands.selectExpr(*kept, "_supplied", f"{found} AS _url").selectExpr(*kept, f"{_placed_url()} AS base")


def _placed_url() -> str:
    own = f"CASE WHEN _supplied IS NOT NULL THEN {resolve('_url', '_supplied')} ELSE _url END"
    return f"coalesce({own}, _supplied)"


def metadata_fields(pages: DataFrame, options, carry: tuple[str, ...] = ()) -> DataFrame:
    """Add ``metadata``: the thirteen-field struct, absent as NULL or ``[]``."""
    kept = list(dict.fromkeys(["page_id", *carry]))
    with_base = pages.withColumn("_supplied", F.expr(supplied_url(pages, options)))
    cands = metadata_candidates(with_base, [*kept, "_supplied"])
    scalars = [f for f in FIELDS if f not in (*LIST_FIELDS, "author", "date", "hostname")]
    override = options.html_date_override
    day = _best_date() if override is None else f"date'{override.isoformat()}'"
    # all scalar fields in one expression over the list of their names
    values = (
        f"transform(transform(transform(array({listed(scalars)}), f -> {_best('f')}), "
        f"v -> {squash(unescape('v'))}), v -> {blank_to_null('v')})"
    )
    decoded = cands.selectExpr(
        *kept,
        "_supplied",
        f"{values} AS _values",
        f"{day} AS _date",
        f"{_joined_authors()} AS _author",
        *[f"{_all_of_best_source(f)} AS _{f}" for f in LIST_FIELDS],
    ).selectExpr("*", *[f"get(_values, {i}) AS _{f}" for i, f in enumerate(scalars)])
    placed = decoded.withColumn("_url", F.expr(_placed_url()))
    special = {
        "author": exclude_authors("_author", options.excluded_authors),
        "hostname": host_of("_url"),
        "language": f"nullif(lower(regexp_extract(_language, {quoted(_PRIMARY_SUBTAG)}, 1)), '')",
        "image": f"CASE WHEN _url IS NOT NULL THEN {resolve('_image', '_url')} ELSE _image END",
    }
    record = ", ".join(f"{special.get(f, f'_{f}')} AS {f}" for f in FIELDS)
    return placed.selectExpr(*kept, f"struct({record}) AS metadata")


def null_if_empty(df: DataFrame, scalars: tuple[str, ...], lists: tuple[str, ...] = ()) -> DataFrame:
    """The absence rule on flat columns: blank scalars NULL, missing lists empty."""
    rule = {
        **{c: blank_to_null(f"`{c}`") for c in scalars},
        **{c: f"coalesce(`{c}`, cast(array() AS array<string>))" for c in lists},
    }
    return df.selectExpr(*[f"{rule[c]} AS `{c}`" if c in rule else f"`{c}`" for c in df.columns])


def missing_essential(metadata: str) -> str:
    """First absent of title, url, date, in that order."""
    return "CASE " + " ".join(
        f"WHEN {metadata}.{f} IS NULL THEN '{f}'" for f in ("title", "url", "date")
    ) + " END"


def metadata_coverage(extracted: DataFrame, by: str = "hostname") -> DataFrame:
    """Fill rate of every field per group, in long form."""
    record = F.col("metadata")
    filled = [
        F.count_if(F.size(record[f]) > 0 if f in LIST_FIELDS else record[f].isNotNull()).alias(f)
        for f in FIELDS
    ]
    wide = extracted.groupBy(record[by].alias("host")).agg(F.count(F.lit(1)).alias("pages"), *filled)
    return wide.unpivot(["host", "pages"], list(FIELDS), "field", "filled").withColumn(
        "fill_rate", F.col("filled") / F.col("pages")
    )


def tag_terms(extracted: DataFrame) -> DataFrame:
    """Keyword frequencies per host."""
    return (
        # the outer form, because the plain one would push its emptiness test
        # below the projection and work the tags out twice
        extracted.select(
            F.col("metadata.hostname").alias("host"),
            F.explode_outer(F.col("metadata.tags")).alias("term"),
        )
        .where(F.col("term").isNotNull())
        .groupBy("host", F.lower("term").alias("term"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
