"""The extraction job: pages in, one row per page out.

Plan shape: scan -> gates, metadata, markup clean-up (narrow) -> ONE hash
exchange on ``page_id`` with a page still one row -> block rows -> region
windows -> labels -> page aggregate -> outcome.  Only cross-page options
(``deduplicate``) add exchanges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions import utf8
from pagewinnow.operators import assemble as A
from pagewinnow.operators import blocks as B
from pagewinnow.operators import ledger as Q
from pagewinnow.operators.intake import gate_reason
from pagewinnow.operators.language import detect_language
from pagewinnow.operators.markup import page_blocks
from pagewinnow.operators.metadata import FIELDS, metadata_fields
from pagewinnow.operators.repeats import body_hashes, with_firsts
from pagewinnow.options import ExtractOptions

EXTRACTED_COLUMNS = ("page_id", "url", *A.STREAMS, "metadata")


def gated_pages(pages: DataFrame, options: ExtractOptions, more: Sequence[str] = ()) -> DataFrame:
    """Pages with ``gate_reason`` / ``gate_offset``; refused bytes are let go.

    A refused page stays as a row for the ledger, without its document.  ``more``
    are further columns, worked out from the bytes as they came.
    """
    reason, offset = gate_reason(options.byte_cap)
    url = "url" if "url" in pages.columns else "cast(NULL AS string) AS url"
    gated = pages.selectExpr(
        "page_id", url, "html", f"{reason} AS gate_reason", f"{offset} AS gate_offset", *more
    )
    text = utf8.without_bom("cast(html AS string)")
    return gated.withColumn("html", F.expr(f"CASE WHEN gate_reason IS NULL THEN {text} END"))


def content_blocks(
    pages: DataFrame, options: ExtractOptions, carry: tuple[str, ...] = (), co_located: bool = False
) -> DataFrame:
    """Block rows of every page with text, counts and region flags."""
    rows = page_blocks(pages, options.prune_selector, carry, co_located)
    return B.blocks(rows, carry)


def page_records(pages: DataFrame, options: ExtractOptions) -> DataFrame:
    """``page_id, html, record``: all page-level values in one narrow struct."""
    gated = gated_pages(pages, options)
    carried = ("url", "html", "gate_reason", "gate_offset")
    with_meta = metadata_fields(gated, options, carry=carried)
    record = F.struct("url", "gate_reason", "gate_offset", "metadata")
    return with_meta.select("page_id", "html", record.alias("record"))


def process(
    pages: DataFrame,
    options: ExtractOptions | dict | None = None,
    co_located: bool = False,
    **overrides,
) -> DataFrame:
    """Every page once: streams, metadata, and ``outcome`` with its reason.

    Pages that share a ``page_id`` are one row, refused as ``duplicate_id`` with
    their number; their texts are not put together.  Set ``co_located`` when the
    table is bucketed on ``page_id`` to run without the exchange.
    ``deduplicate`` takes a second pass over the pages, whose only result is a
    hash per page.
    """
    return process_with_bodies(pages, ExtractOptions.of(options, **overrides), co_located)[0]


def process_with_bodies(
    pages: DataFrame, options: ExtractOptions, co_located: bool = False, seen: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """``process``, and with ``deduplicate`` the bodies that count, ``page_id, _body``.

    Bodies in ``seen(body, first_page)`` make later copies duplicates as well.
    """
    carry: tuple[str, ...] = ("record",)
    records = page_records(pages, options)
    needs_base = options.include_links or options.include_images
    if needs_base:
        # the metadata URL already falls back to the supplied one
        records = records.withColumn("base", F.col("record.metadata.url"))
        carry = ("record", "base")
    rows = content_blocks(records, options, carry, co_located)
    result = A.assemble(
        A.label_passes(rows, options), options, carry=carry, base="base" if needs_base else None
    )
    clear = [f"CASE WHEN copies > 1 THEN '' ELSE {c} END AS {c}" for c in A.STREAMS]
    own = ["CASE WHEN copies = 1 THEN record.{0} END AS {0}".format(c) for c in ("url", "gate_reason", "gate_offset", "metadata")]
    result = result.selectExpr("page_id", *clear, *own, "copies")
    if options.target_language is not None:
        result = detect_language(result, "content_text")
    result = result.withColumn("_own", F.expr(Q.own_refusal(options)))
    bodies = None
    if options.deduplicate:
        # a page refused for its own reasons does not make later copies duplicates
        bodies = body_hashes(result, among="_own IS NULL")
        result = with_firsts(result, bodies, seen)
    refusal = Q.refusal(options, seen is not None)
    done = result.withColumn("_refusal", F.expr(refusal)).selectExpr(*EXTRACTED_COLUMNS, *Q.OUTCOME_COLUMNS)
    return done, bodies


def extract(pages: DataFrame, options=None, **overrides) -> DataFrame:
    """Accepted pages only, in the output schema (streams and metadata)."""
    done = process(pages, options, **overrides)
    return done.where(F.col("outcome") == "ok").select(*EXTRACTED_COLUMNS)


def ledger(pages: DataFrame, options=None, **overrides) -> DataFrame:
    """Exactly one row per page: accepted, or the first reason it was refused."""
    return Q.outcome_ledger(process(pages, options, **overrides))


def flat_metadata(extracted: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Metadata as flat columns beside ``carry``, lists joined by ``|``, for reports."""
    record = F.col("metadata")
    lists = ("categories", "tags")
    return extracted.select(
        "page_id",
        *[
            (F.array_join(record[f], "|") if f in lists else record[f]).alias(f)
            for f in FIELDS
        ],
        *carry,
    )
