"""Gates and encoding jobs on pages, before any markup work.  No shuffles,
except the per-host profile, whose counts are combined map-side first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions import utf8
from pagewinnow.functions.urls import host_of
from pagewinnow.options import DEFAULT_MAX_INPUT_BYTES

N_BYTES = "cast(coalesce(octet_length(html), 0) AS bigint)"


def too_large(cap: int | None) -> str:
    return "false" if cap is None else f"{N_BYTES} > {int(cap)}"


def size_gate(pages: DataFrame, max_input_bytes: int | None = DEFAULT_MAX_INPUT_BYTES) -> DataFrame:
    """Add ``n_bytes`` and ``too_large``; a page exactly at the cap passes."""
    return pages.selectExpr(
        "*", f"{N_BYTES} AS n_bytes", f"{too_large(max_input_bytes)} AS too_large"
    )


def utf8_gate(pages: DataFrame) -> DataFrame:
    """Add ``bad_offset``: byte position of the first bad sequence, or NULL."""
    return pages.selectExpr("*", f"{utf8.first_bad_byte('html')} AS bad_offset")


def gate_reason(cap: int | None) -> tuple[str, str]:
    """``(reason, offset)`` of the two input gates: size first, then encoding.

    One ``CASE`` keeps the order; the offset is only worked out for a page
    that is within the cap and not valid UTF-8.
    """
    reason = (
        f"CASE WHEN {too_large(cap)} THEN 'input_too_large' "
        f"WHEN NOT {utf8.is_utf8('html')} THEN 'invalid_utf8' END"
    )
    offset = f"CASE WHEN {too_large(cap)} THEN NULL ELSE {utf8.first_bad_byte('html')} END"
    return reason, offset


def lossy_decode(pages: DataFrame) -> DataFrame:
    """Keep invalid pages by replacement, and say which ones were repaired."""
    others = [c for c in pages.columns if c != "html"]
    return pages.selectExpr(
        *others, f"{utf8.repaired('html')} AS html", f"NOT {utf8.is_utf8('html')} AS lossy"
    )


def strip_bom(pages: DataFrame) -> DataFrame:
    return pages.withColumn("html", F.expr(utf8.without_bom("cast(html AS string)")))


def encoding_profile(pages: DataFrame) -> DataFrame:
    """Per host: what the encoding of its pages looks like.

    NUL bytes are reported because UTF-16 without a byte-order mark is valid
    UTF-8 and passes the gate.
    """
    head = "hex(substring(cast(html AS binary), 1, 3))"
    text = "cast(html AS string)"
    flags = {
        "not_utf8": f"NOT {utf8.is_utf8('html')}",
        "utf8_bom": f"{head} LIKE 'EFBBBF%'",
        "utf16_bom": f"{head} LIKE 'FFFE%' OR {head} LIKE 'FEFF%'",
        "has_nul": f"contains({text}, char(0))",
        "unclosed": f"NOT contains(lower(make_valid_utf8({text})), '</html>')",
    }
    flagged = pages.selectExpr(
        f"{host_of('url')} AS host", *[f"{test} AS {name}" for name, test in flags.items()]
    )
    return flagged.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), *[F.count_if(name).alias(name) for name in flags]
    )
