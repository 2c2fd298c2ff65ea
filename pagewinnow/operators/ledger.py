"""Outcome ledger: exactly one row per page, ``ok`` or the first refusal."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pagewinnow.operators.language import mismatch
from pagewinnow.operators.metadata import missing_essential

# The closed set of reasons; ``duplicate_id`` is ours and comes before all others, the last two only occur on imported snapshots.
REASONS = (
    "input_too_large", "invalid_utf8", "language_mismatch", "missing_metadata",
    "insufficient_content", "duplicate_content", "duplicate_id", "panic", "unknown",
)
LEDGER_COLUMNS = ("page_id", "url", "outcome", "reason", "reason_detail", "reason_offset")


def _because(reason: str, detail: str = "NULL", offset: str = "NULL") -> str:
    return (
        f"struct({reason} AS reason, cast({detail} AS string) AS detail, "
        f"cast({offset} AS bigint) AS offset)"
    )


def _first_failing(checks: list[tuple[str, str]]) -> str:
    """One ordered ``CASE``, because the optimizer may reorder a conjunction."""
    return "CASE " + " ".join(f"WHEN {test} THEN {why}" for test, why in checks) + " END"


def own_refusal(options) -> str:
    """First failing check a page can decide on its own, before the text checks.

    Expects ``copies, gate_reason, gate_offset, metadata, content_text, comments_text``.
    """
    target = options.target_language
    checks = [("copies > 1", _because("'duplicate_id'", "copies"))]
    checks += [("gate_reason IS NOT NULL", _because("gate_reason", offset="gate_offset"))]
    if target is not None:
        checks.append((mismatch("metadata.language", target), _because("'language_mismatch'")))
    if options.has_essential_metadata:
        missing = missing_essential("metadata")
        checks.append((f"{missing} IS NOT NULL", _because("'missing_metadata'", missing)))
    checks.append(("content_text = '' AND comments_text = ''", _because("'insufficient_content'")))
    return _first_failing(checks)


def refusal(options, seen: bool = False) -> str:
    """``struct(reason, detail, offset)`` of the first failing check, else NULL.

    Expects ``_own`` (``own_refusal``), plus ``first_page`` with deduplication
    (and ``seen_page`` with an index of bodies ``seen`` before) and ``detected`` with a target language.
    """
    target = options.target_language
    checks = [("_own IS NOT NULL", "_own")]
    if options.deduplicate:
        test = "first_page < page_id OR seen_page IS NOT NULL" if seen else "first_page < page_id"
        checks.append((test, _because("'duplicate_content'")))
    if target is not None:
        checks.append((mismatch("detected", target), _because("'language_mismatch'", "detected")))
    return _first_failing(checks)


OUTCOME_COLUMNS = (
    "CASE WHEN _refusal IS NULL THEN 'ok' ELSE 'refused' END AS outcome",
    "_refusal.reason AS reason",
    "_refusal.detail AS reason_detail",
    "_refusal.offset AS reason_offset",
)


def outcome_ledger(processed: DataFrame) -> DataFrame:
    return processed.select(*LEDGER_COLUMNS)


def outcome_tally(ledger: DataFrame, lossy: str | None = None) -> DataFrame:
    """Counts per host and outcome with subtotals; ``level`` is the grouping id.

    Expects ``host, outcome``; ``lossy`` names a flag to count as well.
    """
    extra = [] if lossy is None else [F.count_if(F.col(lossy)).alias("lossy")]
    return ledger.rollup("host", "outcome").agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("pages"), *extra
    )
