"""Many option sets over one corpus in one job.

Tokenizing, regions, text, features and labels are worked out once per page.  A
block row carries one bitmap per pass, whose bits tell which option sets keep
it; rules that several sets share are evaluated once, labels of the statistical
pass once per focus, HTML once per choice of links and images.  The page
aggregate is that of the extraction job, and only finished page rows multiply.
Grouping by ``page_id`` is satisfied by the hash partitioning on it, so the
sweep exchanges nothing more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from pagewinnow.operators import assemble as A
from pagewinnow.operators import blocks as B
from pagewinnow.operators import ledger as Q
from pagewinnow.operators.intake import too_large
from pagewinnow.operators.metadata import document_url, metadata_fields
from pagewinnow.options import SWEEPABLE_KEYS, ExtractOptions, OptionError
from pagewinnow.plans.extract import EXTRACTED_COLUMNS, content_blocks, gated_pages

#: option sets of one word of a bitmap
WORD = 62


def _checked(option_sets: Sequence[ExtractOptions], also: Sequence[str] = ()) -> list[ExtractOptions]:
    if not option_sets:
        raise OptionError("a sweep takes at least one option set")
    for options in option_sets:
        for key in vars(option_sets[0]):
            if key not in (*SWEEPABLE_KEYS, *also) and getattr(options, key) != getattr(option_sets[0], key):
                raise OptionError(f"{key}: cannot differ between the option sets of a sweep")
    return list(option_sets)


def _bitmap(tests: Sequence[str]) -> str:
    """``array<bigint>`` with a bit for each test that holds; equal tests are made once."""
    owners: dict[str, list[int]] = {}
    for i, test in enumerate(tests):
        owners.setdefault(test, []).append(i)
    words = []
    for w in range(-(-len(tests) // WORD)):
        masks = {t: sum(1 << i % WORD for i in own if i // WORD == w) for t, own in owners.items() if t != "false"}
        bits = [f"CASE WHEN {t} THEN {m}L ELSE 0L END" for t, m in masks.items() if m]
        words.append(" + ".join(bits) or "0L")
    return f"array({', '.join(words)})"


def _index(values: Sequence) -> tuple[list, list[int]]:
    """Distinct values, and the place of each value among them."""
    distinct = list(dict.fromkeys(values))
    return distinct, [distinct.index(v) for v in values]


def _second(options: ExtractOptions) -> str:
    if not options.enable_fallback:
        return "false"
    return f"keep_{options.focus} AND NOT in_comments AND {B.allowed_by_options(options)}"


PASS_TESTS: dict[str, Callable[[ExtractOptions], str]] = {
    "main": B.structural_label,
    "base": B.baseline_label,
    "loose": B.loose_label,
    "comment": B.comment_label,
    "second": _second,
}


def swept_pages(rows: DataFrame, sets: list[ExtractOptions], base: str | None, min_chars: int, carry: Sequence[str] = ()) -> DataFrame:
    """One row per page: its kept blocks with their bitmaps, the scores of the sets that fall back, and the carried columns."""
    focuses = sorted({o.focus for o in sets if o.enable_fallback})
    if focuses:
        rows = B.block_features(rows)
        labels = [f"{B.statistical_label(ExtractOptions(focus=f))} AS label_{f}" for f in focuses]
        rows = B.smooth_blocks(rows.selectExpr("*", *labels), labels=[f"label_{f}" for f in focuses])
    if base is not None:
        rows = rows.withColumn("_base", F.expr(f"first({base}, true) OVER (PARTITION BY page_id ORDER BY block_no ROWS UNBOUNDED PRECEDING)"))
    bitmaps = {f"k_{p}": _bitmap([test(o) for o in sets]) for p, test in PASS_TESTS.items()}
    some = " OR ".join(f"exists({name}, w -> w <> 0)" for name in bitmaps)
    rows = rows.selectExpr("*", *[f"{x} AS {name}" for name, x in bitmaps.items()]).selectExpr("*", f"{some} AS _some")
    variants, _ = _index([(o.include_links, o.include_images) for o in sets])
    for i, (links, images) in enumerate(variants):
        shown = A.block_html(rows, ExtractOptions(include_links=links, include_images=images), base and "_base", "_some")
        rows = shown.withColumnRenamed("inner", f"_inner_{i}")
    html = ", ".join(A.element(f"_inner_{i}") for i in range(len(variants)))
    kept = f"CASE WHEN _some THEN struct(block_no AS pos, text, array({html}) AS html, {', '.join(bitmaps)}) END"
    outside = "NOT in_pruned AND " if "in_pruned" in rows.columns else ""
    nests = ", ".join(
        f"{_bitmap([outside + B.nest_labels(o)[p] if p != 'second' or o.enable_fallback else 'false' for o in sets])} AS k_{p}"
        for p in A.NEST_PASSES
    )
    mark = f"CASE WHEN mark_step <> 0 THEN struct(mark_level AS level, block_no AS pos, mark_step AS step, tag AS name, {nests}) END"
    score = "greatest(coalesce(sum(CASE WHEN {} THEN n_chars - link_chars END), 0), 0)".format
    falling = [o for o in sets if o.enable_fallback]
    scores = {
        "_main_scores": [score(t) for t in _index([B.structural_label(o) for o in falling])[0]],
        "_second_scores": [score(t) for t in _index([_second(o) for o in falling])[0]],
    }
    pages = rows.groupBy("page_id").agg(
        F.expr(f"array_sort(collect_list({kept})) AS _kept"),
        F.expr(f"array_sort(collect_list({mark})) AS _sorted"),
        *[F.expr(f"array({', '.join(x) or '0L'}) AS {name}") for name, x in scores.items()],
        F.expr("sum(mark_copies) AS copies"),
        *[F.expr(f"first({c}, true) AS {c}") for c in carry],
    )
    return pages.withColumn("_marks", F.expr(A.paired_marks("_sorted")))


def option_sweep(pages: DataFrame, option_sets: Sequence[ExtractOptions], co_located: bool = False) -> DataFrame:
    """``option_id, page_id`` and the four streams, for every option set; empty where pages share an id."""
    sets = _checked(option_sets)
    base = "base" if any(o.include_links or o.include_images for o in sets) else None
    if base:
        based = document_url(gated_pages(pages, sets[0]), sets[0], ("html",))
        rows = content_blocks(based, sets[0], ("base",), co_located)
    else:
        rows = content_blocks(gated_pages(pages, sets[0]), sets[0], co_located=co_located)
    finished = _finished(rows, sets, base).selectExpr("page_id", "copies", "inline_outer(_done)")
    return finished.selectExpr("option_id", "page_id", *[f"CASE WHEN copies > 1 THEN '' ELSE {c} END AS {c}" for c in A.STREAMS])


def _finished(rows: DataFrame, sets: list[ExtractOptions], base: str | None, carry: Sequence[str] = ()) -> DataFrame:
    """``page_id, copies``, the carried columns and ``_done``: ``option_id`` and the streams of every option set, in order."""
    min_chars = A.MIN_EXTRACTED_CHARS
    found = swept_pages(rows, sets, base, min_chars, carry)
    variant = _index([(o.include_links, o.include_images) for o in sets])[1]
    falling = [i for i, o in enumerate(sets) if o.enable_fallback]
    scored = [dict(zip(falling, _index([label(sets[i]) for i in falling])[1], strict=True)) for label in (B.structural_label, _second)]
    wanted = ", ".join(
        f"struct({i} AS option_id, {i // WORD} AS word, {i % WORD} AS bit, {variant[i]} AS variant, "
        f"{str(o.enable_fallback).lower()} AS falls, {scored[0].get(i, 0)} AS main, {scored[1].get(i, 0)} AS second)"
        for i, o in enumerate(sets)
    )

    def stream(name: str, field: str) -> str:
        return A.stream(name, field, f"getbit(get({{}}.k_{name}, o.word), o.bit) = 1", "get(b.html, o.variant)")

    of = ", ".join(f"o.{f}" for f in ("option_id", "word", "bit", "variant"))
    first, other = "get(_main_scores, o.main)", "get(_second_scores, o.second)"
    better = f"o.falls AND ({first} < {min_chars} OR {other} > 2 * {first}) AND {other} > {first}"
    chosen = f"transform(array({wanted}), o -> struct({of}, coalesce({better}, false) AS second))"
    texts = f"transform(_chosen, o -> struct({of}, o.second, CASE WHEN o.second THEN {stream('second', 'text')} ELSE {stream('main', 'text')} END AS text))"
    # the rescue passes are only put together where the text is short
    strict = f"transform(_texts, o -> struct({of}, o.second, o.text, CASE WHEN length(o.text) < {min_chars} THEN {stream('base', 'text')} END AS strict))"
    loose = f"CASE WHEN o.text = '' AND o.strict = '' THEN {stream('loose', 'text')} END"
    bases = f"transform(_strict, o -> struct({of}, o.second, o.text, o.strict, {loose} AS loose))"
    rescue = f"CASE WHEN length(o.loose) >= {min_chars} THEN o.loose WHEN length(o.strict) > length(o.text) THEN o.strict END"
    rescued = f"transform(_bases, o -> struct({of}, o.second, o.text, {rescue} AS rescue))"
    html = f"CASE WHEN o.rescue IS NOT NULL THEN {A.paragraph('o.rescue')} WHEN o.second THEN {stream('second', 'html')} ELSE {stream('main', 'html')} END"
    done = (
        f"transform(_rescued, o -> struct(o.option_id, coalesce(o.rescue, o.text) AS content_text, {stream('comment', 'text')} AS comments_text, "
        f"{html} AS content_html, {stream('comment', 'html')} AS comments_html))"
    )
    for name, x in (("_chosen", chosen), ("_texts", texts), ("_strict", strict), ("_bases", bases), ("_rescued", rescued), ("_done", done)):
        found = found.withColumn(name, F.expr(x))
    return found.select("page_id", "copies", *carry, "_done")


def process_sweep(pages: DataFrame, option_sets: Sequence[ExtractOptions], co_located: bool = False) -> DataFrame:
    """``option_id`` and the columns of ``process`` for every option set: each set's rows are those ``process`` gives.

    Metadata is worked out once as well.  The sets may differ in ``max_input_bytes`` too; what is over a set's
    cap is refused there, and read if another set takes it.  Store the result before it is read by option.
    """
    sets = _checked(option_sets, ("max_input_bytes",))
    for key in ("deduplicate", "target_language"):
        if getattr(sets[0], key):
            raise OptionError(f"{key}: cannot be set in a sweep")
    caps, cap_of = _index([o.max_input_bytes for o in sets])
    records = _capped_records(pages, sets[0], caps)
    base = "base" if any(o.include_links or o.include_images for o in sets) else None
    if base:
        records = records.withColumn("base", F.col("record.metadata.url"))
    carry = ("record", "base") if base else ("record",)
    rows = content_blocks(records, sets[0], carry, co_located)
    each = _finished(rows, sets, base, ("record",)).selectExpr("page_id", "copies", "record", "inline_outer(_done)")
    each = each.withColumn("_over", F.expr(f"get(record.over, get(array({', '.join(map(str, cap_of))}), option_id))"))
    own = {
        "url": "record.url",
        "gate_reason": "CASE WHEN _over THEN 'input_too_large' ELSE record.gate_reason END",
        "gate_offset": "CASE WHEN NOT _over THEN record.gate_offset END",
        "metadata": "CASE WHEN _over AND record.bare IS NOT NULL THEN record.bare ELSE record.metadata END",
    }
    each = each.selectExpr(
        "option_id",
        "page_id",
        "copies",
        *[f"CASE WHEN copies > 1 OR _over THEN '' ELSE {c} END AS {c}" for c in A.STREAMS],
        *[f"CASE WHEN copies = 1 THEN {x} END AS {name}" for name, x in own.items()],
    )
    each = each.withColumn("_own", F.expr(Q.own_refusal(sets[0]))).withColumn("_refusal", F.expr(Q.refusal(sets[0])))
    return each.selectExpr("option_id", *EXTRACTED_COLUMNS, *Q.OUTCOME_COLUMNS)


def _capped_records(pages: DataFrame, options: ExtractOptions, caps: list[int | float]) -> DataFrame:
    """``page_id, html, record``: page-level values under the highest cap, and which caps a page is ``over``.

    ``bare`` is the metadata without a document, for pages that a lower cap refuses alone.
    """
    highest = max(caps)
    over = [too_large(ExtractOptions(max_input_bytes=c).byte_cap) for c in caps]
    gated = gated_pages(pages, ExtractOptions.of(options, max_input_bytes=highest), [f"array({', '.join(over)}) AS over"])
    whole = ("url", "html", "gate_reason", "gate_offset", "over")
    records = metadata_fields(gated, options, carry=whole)
    bare = "CASE WHEN false THEN metadata END"
    if len(caps) > 1:
        own = f"struct({', '.join(whole[1:])}, metadata) AS own"
        records = metadata_fields(records.selectExpr("page_id", "url", "cast(NULL AS string) AS html", own), options, carry=("url", "own"))
        records = records.selectExpr("page_id", "url", "own.*", "metadata AS _bare")
        bare = f"CASE WHEN exists(over, x -> x) AND NOT get(over, {caps.index(highest)}) THEN _bare END"
    return records.selectExpr("page_id", "html", f"struct(url, gate_reason, gate_offset, over, metadata, {bare} AS bare) AS record")
