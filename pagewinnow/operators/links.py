"""Link edges and image rows of kept blocks, and their corpus reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions import patterns as P
from pagewinnow.functions.text import attribute, quoted, squash, unescape
from pagewinnow.functions.urls import host_of, resolve

# Words in an image address that mark page furniture; the choice is ours.
FURNITURE_IMAGE = r"(?i)[/_.-](?:logo|icon|sprite|avatar|pixel|spacer|blank|badge|button)s?[/_.-]"


def _tag_rows(block_rows: DataFrame, name: str) -> DataFrame:
    tags = f"regexp_extract_all(body, {quoted(P.named_tag(name))}, 0)"
    return block_rows.where(F.lower("body").contains(f"<{name}")).selectExpr(
        "page_id", "block_no", "base", f"posexplode({tags}) AS (pos, tag)"
    )


def link_edges(block_rows: DataFrame) -> DataFrame:
    """``page_id, block_no, pos, source_host, target, target_host``.

    Expects ``page_id, block_no, body, base``.  Targets are absolute; anchors
    that name no host (``mailto:`` and the like) are not edges.
    """
    return (
        _tag_rows(block_rows, "a")
        .selectExpr("page_id", "block_no", "pos", "base", f"{attribute('tag', 'href')} AS _raw")
        .where("_raw <> ''")
        .selectExpr("page_id", "block_no", "pos", "base", f"{squash(unescape('_raw'))} AS _href")
        .selectExpr("page_id", "block_no", "pos", "base", f"{resolve('_href', 'base')} AS target")
        .selectExpr(
            "page_id",
            "block_no",
            "pos",
            f"{host_of('base')} AS source_host",
            "target",
            f"{host_of('target')} AS target_host",
        )
        .where("target_host IS NOT NULL")
    )


def host_degrees(edges: DataFrame) -> DataFrame:
    """Links out of and into every host, counted with map-side combining."""
    # both ends of an edge from one row, so the edges are worked out once
    ends = edges.selectExpr(
        "inline(array(struct(source_host AS host, 1 AS n_out, 0 AS n_in), "
        "struct(target_host AS host, 0 AS n_out, 1 AS n_in)))"
    )
    return ends.groupBy("host").agg(
        F.sum("n_out").alias("out_links"), F.sum("n_in").alias("in_links")
    )


def image_rows(block_rows: DataFrame) -> DataFrame:
    """``page_id, block_no, pos, src, alt, is_data_uri, is_furniture``."""
    return (
        _tag_rows(block_rows, "img")
        .selectExpr(
            "page_id",
            "block_no",
            "pos",
            "base",
            f"{attribute('tag', 'src')} AS _src",
            f"{squash(unescape(attribute('tag', 'alt')))} AS alt",
        )
        .selectExpr(
            "page_id",
            "block_no",
            "pos",
            f"CASE WHEN _src = '' THEN '' ELSE {resolve('_src', 'base')} END AS src",
            "alt",
            "lower(_src) LIKE 'data:%' AS is_data_uri",
            f"_src RLIKE {quoted(FURNITURE_IMAGE)} AS is_furniture",
        )
    )


def image_inventory(images: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row of corpus coverage: documents and images by kind.

    Pages are reduced to one flag row each before they are counted, so no
    distinct count runs over image rows.
    """
    per_page = images.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("src") != "").alias("with_src"),
        F.count_if(F.col("alt") != "").alias("with_alt"),
        F.count_if("is_data_uri").alias("data_uris"),
        F.count_if("is_furniture").alias("furniture"),
    )
    joined = metadata.selectExpr("page_id", "metadata.image AS og").join(per_page, "page_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return joined.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("n") > 0).alias("pages_with_image"),
        F.count_if(F.col("og").isNotNull()).alias("pages_with_og_image"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("images"),
        *[total(c) for c in ("with_src", "with_alt", "data_uris", "furniture")],
    )
