"""Cross-page repetition: repeated blocks and repeated page bodies.

Both count by content hash with map-side combining, so a text on a third of all
pages is one partial row per task.  The way back to the pages is a plain join on
the hash, with one row per hash on one side: adaptive execution splits the
partition of a very common hash over tasks and repeats only that one row.
Blocks and pages themselves stay where they are, partitioned by page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions.text import squash
from pagewinnow.session import durable

#: bitmaps of the Bloom filter, and the bits that Spark gives each
FILTER_PARTS, FILTER_BITS = 1024, 32768


def normal_text(text: str, host: str) -> str:
    """Text as compared across pages: own host name out, case and blanks folded."""
    return squash(f"replace(lower({text}), coalesce(lower({host}), ''), '')")


def content_hash(text: str) -> str:
    """32 raw bytes, half the shuffle volume of the hexadecimal form; NULL when blank."""
    return f"CASE WHEN {text} <> '' THEN unhex(sha2({text}, 256)) END"


def with_block_hash(block_rows: DataFrame) -> DataFrame:
    """Add ``hash`` of the normalised text; expects ``host, text``."""
    return block_rows.withColumn("_norm", F.expr(normal_text("text", "host"))).selectExpr(
        *block_rows.columns, f"{content_hash('_norm')} AS hash"
    )


def page_hashes(block_rows: DataFrame, by_host: bool = False) -> DataFrame:
    """``page_id, [host,] hash, block_nos``: each text of a page once.

    Expects ``page_id, block_no, host, text``.  Block rows are already hashed
    on ``page_id``, so grouping within the page needs no exchange.
    """
    scope = ["host", "hash"] if by_host else ["hash"]
    return (
        with_block_hash(block_rows)
        .where("hash IS NOT NULL")
        .groupBy("page_id", *scope)
        .agg(F.collect_list("block_no").alias("block_nos"))
    )


def block_frequency(hashes: DataFrame, by_host: bool = False) -> DataFrame:
    """Pages per block text: ``[host,] hash, df``, combined map-side."""
    scope = ["host", "hash"] if by_host else ["hash"]
    return hashes.groupBy(*scope).agg(F.count(F.lit(1)).alias("df"))


def repeated_in_page(hashes: DataFrame, max_df: int, by_host: bool = False) -> DataFrame:
    """``page_id, repeated``: the numbers of its blocks on more than ``max_df`` pages."""
    scope = ["host", "hash"] if by_host else ["hash"]
    repeated = block_frequency(hashes, by_host).where(F.col("df") > max_df).drop("df")
    return (
        hashes.join(repeated, scope)
        .groupBy("page_id")
        .agg(F.flatten(F.collect_list("block_nos")).alias("repeated"))
    )


def dedup_blocks(block_rows: DataFrame, max_df: int, by_host: bool = False) -> DataFrame:
    """Drop blocks whose normalised text is on more than ``max_df`` pages.

    Blank blocks are kept as they are.  Only hashes travel, and they are worked
    out once: the repeated blocks of a page come back as one short list of
    numbers joined on ``page_id``, on which the block rows are already
    partitioned, so their text is not shuffled again.
    """
    hashes = durable(page_hashes(block_rows, by_host))
    hits = repeated_in_page(hashes, max_df, by_host)
    return (
        block_rows.join(hits, "page_id", "left")
        .where("repeated IS NULL OR NOT array_contains(repeated, block_no)")
        .drop("repeated")
    )


def duplicate_pages(
    extracted: DataFrame, text: str = "content_text", among: str = "true", seen: DataFrame | None = None
) -> DataFrame:
    """Add ``first_page``: smallest ``page_id`` with the same body.

    NULL for a body seen once or blank, and for pages outside the condition
    ``among``; a page is a duplicate when ``first_page < page_id``.  No ranking
    window, which would sort all copies of one body in a single task, and only
    ``page_id`` and the hash are shuffled, never the text.

    With ``seen(body, first_page)``, an index of bodies of earlier runs (see
    ``new_bodies``), ``seen_page`` is added: the page that a body was first seen
    on, NULL for new ones.
    """
    return with_firsts(extracted, body_hashes(extracted, text, among), seen)


def body_hashes(extracted: DataFrame, text: str = "content_text", among: str = "true") -> DataFrame:
    """``page_id, _body`` of the pages in question, worked out once."""
    return durable(extracted.where(among).selectExpr("page_id", f"{content_hash(text)} AS _body"))


def with_firsts(extracted: DataFrame, hashed: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    groups = hashed.join(body_firsts(hashed), "_body").select("page_id", "first_page")
    done = extracted.join(groups, "page_id", "left")
    if seen is None:
        return done
    hits = hashed.join(seen_bodies(hashed, seen), "_body").select("page_id", "seen_page")
    return done.join(hits, "page_id", "left")


def seen_bodies(hashed: DataFrame, seen: DataFrame) -> DataFrame:
    """Bodies of ``hashed`` that the index has: ``_body, seen_page``.

    A Bloom filter of the new bodies goes over the index first, where it lies,
    so that what is exchanged follows the new pages and not the index.  The
    filter is ``FILTER_PARTS`` bitmaps of 4 KB whatever the input.
    """
    place = "pmod(xxhash64({}), {})".format
    bits = FILTER_PARTS * FILTER_BITS
    new = hashed.where("_body IS NOT NULL").selectExpr(f"{place('_body', bits)} AS place")
    parts = new.groupBy(F.expr(f"place div {FILTER_BITS}").alias("part")).agg(
        F.expr(f"bitmap_construct_agg(place % {FILTER_BITS})").alias("bits")
    )
    placed = seen.selectExpr("body AS _body", "first_page", f"{place('body', bits)} AS place")
    byte = f"cast(conv(hex(substr(bits, cast(place % {FILTER_BITS} div 8 AS int) + 1, 1)), 16, 10) AS int)"
    # at most FILTER_PARTS rows of 4 KB
    maybe = placed.join(F.broadcast(parts), F.expr(f"place div {FILTER_BITS} = part")).where(
        f"(shiftright({byte}, cast(place % 8 AS int)) & 1) = 1"
    )
    return maybe.groupBy("_body").agg(F.min("first_page").alias("seen_page"))


def new_bodies(hashed: DataFrame, seen: DataFrame) -> DataFrame:
    """What an index lacks of the bodies of ``hashed``: ``body, first_page``."""
    firsts = hashed.where("_body IS NOT NULL").groupBy("_body").agg(F.min("page_id").alias("first_page"))
    return firsts.join(seen_bodies(hashed, seen), "_body", "left_anti").select(F.col("_body").alias("body"), "first_page")


def body_firsts(hashed: DataFrame) -> DataFrame:
    """Repeated bodies only: ``_body, first_page``."""
    return (
        hashed.where(F.col("_body").isNotNull())
        .groupBy("_body")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n")
    )
