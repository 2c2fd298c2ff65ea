"""Snapshots of an extraction compared field by field, and line by line where they differ.

Only digests travel: a page is reduced to one digest per field before the
join, so comparing two corpora shuffles a few hundred bytes per page.  Lines
are read for those fields alone whose digests differ.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pagewinnow.operators.assemble import STREAMS
from pagewinnow.operators.metadata import FIELDS, LIST_FIELDS

SCALAR_FIELDS = tuple(f for f in FIELDS if f not in LIST_FIELDS)
ALL_FIELDS = (*STREAMS, *FIELDS)
# Separates list items inside a digest, so one item holding a line break
# differs from two items.
ITEM_BREAK = "\\u001f"


def _sized(field: str) -> str:
    """``struct(n_bytes, n_items, digest)``; absent has no digest."""
    if field in LIST_FIELDS:
        joined = f"array_join(metadata.{field}, '{ITEM_BREAK}')"
        items, text = f"size(metadata.{field})", f"CASE WHEN size(metadata.{field}) > 0 THEN {joined} END"
        size = f"octet_length({joined})"
    else:
        value = field if field in STREAMS else f"cast(metadata.{field} AS string)"
        items, text = f"CASE WHEN {value} IS NULL THEN 0 ELSE 1 END", value
        size = f"coalesce(octet_length({value}), 0)"
    return (
        f"struct('{field}' AS field, cast({size} AS bigint) AS n_bytes, "
        f"cast({items} AS bigint) AS n_items, sha2({text}, 256) AS digest)"
    )


def dump_manifest(processed: DataFrame) -> DataFrame:
    """One row per page and field: bytes, items, digest.  Narrow.

    Where the outcome is there, it is a row as well; a refused page has that row
    and one for the error (reason, detail and byte offset), none for its fields.
    """
    cells = ", ".join(_sized(f) for f in ALL_FIELDS)
    if "outcome" not in processed.columns:
        return processed.selectExpr("page_id", f"inline(array({cells}))")
    plain = lambda field, x: (
        f"struct('{field}' AS field, cast(octet_length({x}) AS bigint) AS n_bytes, 1L AS n_items, sha2({x}, 256) AS digest)"
    )
    error = "concat_ws(':', reason, reason_detail, cast(reason_offset AS string))"
    accepted = f"array({cells}, {plain('outcome', 'outcome')})"
    refused = f"array({plain('outcome', 'outcome')}, {plain('error', error)})"
    return processed.selectExpr("page_id", f"inline(CASE WHEN outcome = 'ok' THEN {accepted} ELSE {refused} END)")


def _digests(snapshot: DataFrame, side: str) -> DataFrame:
    """One digest column per field, and whether the page was accepted."""
    outcome = "outcome" if "outcome" in snapshot.columns else "'ok'"
    reason = "reason" if "reason" in snapshot.columns else "cast(NULL AS string)"
    more = ", ".join(c if c in snapshot.columns else f"cast(NULL AS string) AS {c}" for c in ("reason_detail", "reason_offset"))
    fields = [f"{_sized(f)}.digest AS {side}_{f}" for f in ALL_FIELDS]
    return snapshot.selectExpr(
        "page_id", f"to_json(struct({outcome} AS outcome, {reason} AS reason, {more})) AS {side}_outcome", *fields
    )


def _compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """``page_id, in_a, in_b, changes``: both snapshots side by side, once."""
    both = _digests(a, "a").join(_digests(b, "b"), "page_id", "full_outer")
    cells = ", ".join(
        f"CASE WHEN NOT (a_{n} <=> b_{n}) THEN struct('{n}' AS field, 'changed' AS change) END"
        for n in ("outcome", *ALL_FIELDS)
    )
    one_sided = "array(struct('page' AS field, CASE WHEN in_a THEN 'only_a' ELSE 'only_b' END AS change))"
    return both.selectExpr(
        "*", "a_outcome IS NOT NULL AS in_a", "b_outcome IS NOT NULL AS in_b"
    ).selectExpr(
        "page_id",
        "in_a",
        "in_b",
        f"CASE WHEN in_a AND in_b THEN filter(array({cells}), c -> c IS NOT NULL) ELSE {one_sided} END AS changes",
    )


def snapshot_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """``page_id, field, change`` for every difference.

    A page on one side only is one row with field ``page``; an error that
    became a success differs in ``outcome``.
    """
    return _compared(a, b).selectExpr("page_id", "inline(changes)")


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _in_order(places: pd.Series) -> pd.Series:
    """Which of a page's distinct numbers form its longest rising run.

    Of several longest runs it is the one found from the end: the last number
    that ends one, then each time the latest earlier number one step lower.
    """

    def marks(numbers) -> list[bool]:
        least, last, before = [], [], []
        for i, number in enumerate(numbers):
            step = bisect_left(least, number)
            before.append(last[step - 1] if step else -1)
            least[step : step + 1], last[step : step + 1] = [number], [i]
        kept = [False] * len(before)
        i = last[-1] if last else -1
        while i >= 0:
            kept[i], i = True, before[i]
        return kept

    return places.map(marks)


def _line_array(field: str) -> str:
    """The lines of a field: of a stream by line break, of a list its items; none if absent."""
    if field in LIST_FIELDS:
        return f"coalesce(metadata.{field}, array())"
    if field in STREAMS:
        return f"CASE WHEN {field} <> '' THEN split({field}, '\\n') ELSE array() END"
    return f"CASE WHEN metadata.{field} IS NOT NULL THEN array(cast(metadata.{field} AS string)) ELSE array() END"


def changed_lines(a: DataFrame, b: DataFrame, fields: Sequence[str] = ALL_FIELDS) -> DataFrame:
    """``page_id, field, change, line_a, line_b, line`` for pages on both sides.

    A line is taken by its text and by how often it has come before, so the
    second copy of a line meets the second copy.  One without a partner is
    ``removed`` (from a) or ``added`` (in b).  Of the others those outside the
    longest common order are ``moved``; this is the longest common subsequence
    of the lines so numbered.  Line numbers start at 1.  At most one row a line.

    The digests settle first which fields differ, and the lines of these alone
    are exchanged, once.  Both snapshots are read twice, so they should be stored.
    """
    cells = ", ".join(f"CASE WHEN NOT (a_{f} <=> b_{f}) THEN '{f}' END" for f in fields)
    changed = (
        _digests(a, "a")
        .join(_digests(b, "b"), "page_id")
        .selectExpr("page_id", f"explode(filter(array({cells}), f -> f IS NOT NULL)) AS field")
    )
    each = ", ".join(f"struct('{f}' AS field, {_line_array(f)} AS lines)" for f in fields)

    def lines(snapshot: DataFrame, side: str) -> DataFrame:
        of_fields = snapshot.selectExpr("page_id", f"inline(array({each}))").where("size(lines) > 0")
        some = of_fields.join(changed, ["page_id", "field"], "left_semi")
        return some.selectExpr("page_id", "field", f"'{side}' AS side", "posexplode(lines) AS (place, line)")

    # one exchange: all that follows groups within a page's field
    both = lines(a, "a").unionByName(lines(b, "b")).repartition("page_id", "field")
    copies = Window.partitionBy("page_id", "field", "side", "digest").orderBy("place")
    numbered = both.withColumn("digest", F.md5("line")).withColumn("copy", F.row_number().over(copies))
    paired = numbered.groupBy("page_id", "field", "digest", "copy").agg(
        F.expr("max(place + 1) FILTER (WHERE side = 'a') AS line_a"),
        F.expr("max(place + 1) FILTER (WHERE side = 'b') AS line_b"),
        F.expr("any_value(line) AS line"),
    )
    fields_of = paired.groupBy("page_id", "field").agg(
        F.sort_array(F.collect_list(F.struct("line_a", "line_b", "line"))).alias("rows")
    )
    split = fields_of.selectExpr(
        "page_id",
        "field",
        "filter(rows, r -> r.line_a IS NULL OR r.line_b IS NULL) AS single",
        "filter(rows, r -> r.line_a IS NOT NULL AND r.line_b IS NOT NULL) AS paired",
    ).withColumn("stays", _in_order(F.expr("transform(paired, r -> r.line_b)")))
    return split.selectExpr(
        "page_id", "field", "inline(concat(single, filter(paired, (r, i) -> NOT stays[i])))"
    ).selectExpr(
        "page_id",
        "field",
        "CASE WHEN line_a IS NULL THEN 'added' WHEN line_b IS NULL THEN 'removed' ELSE 'moved' END AS change",
        "line_a",
        "line_b",
        "line",
    )


def renamed_pages(a: DataFrame, b: DataFrame) -> DataFrame:
    """``body_sha, page_a, page_b, pages_a, pages_b``: bodies that left one id and came under another.

    Pages of one side only are compared by the digest of their main text.  A
    body that several ids lost or gained is one row with their numbers and the
    least id of each side, so a common body is no list.  Empty bodies don't count.
    """
    body = lambda df, side: df.where("content_text <> ''").selectExpr("page_id", f"sha2(content_text, 256) AS {side}_sha")
    ids = lambda df: df.select("page_id")
    gone = body(a, "body").join(ids(b), "page_id", "left_anti").selectExpr("*", "'a' AS side")
    come = body(b, "body").join(ids(a), "page_id", "left_anti").selectExpr("*", "'b' AS side")
    each = gone.unionByName(come).groupBy("body_sha").agg(
        F.expr("min(page_id) FILTER (WHERE side = 'a') AS page_a"),
        F.expr("min(page_id) FILTER (WHERE side = 'b') AS page_b"),
        F.expr("count_if(side = 'a') AS pages_a"),
        F.expr("count_if(side = 'b') AS pages_b"),
    )
    return each.where("pages_a > 0 AND pages_b > 0")


def diff_verdict(
    a: DataFrame, b: DataFrame, version_a: str, version_b: str
) -> DataFrame:
    """One row: ``empty``, ``non-empty`` or ``broken``.

    Broken when a side has no pages or both sides are the same version, so a
    comparison that compared nothing is never reported as clean.
    """
    counts = _compared(a, b).agg(
        F.count_if("in_a").alias("pages_a"),
        F.count_if("in_b").alias("pages_b"),
        F.expr("count_if(size(changes) > 0) AS pages_changed"),
        F.expr("coalesce(sum(size(changes)), 0) AS fields_changed"),
    )
    same = "true" if version_a == version_b else "false"
    return counts.selectExpr(
        "*",
        f"CASE WHEN {same} OR pages_a = 0 OR pages_b = 0 THEN 'broken' "
        "WHEN fields_changed = 0 THEN 'empty' ELSE 'non-empty' END AS verdict",
    )


def multiset_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``n_rows`` and an order-free digest of the rows."""
    # hashing skips NULLs, so where they stand is hashed as well
    row = f"xxhash64({', '.join([*columns, *(f'{c} IS NULL' for c in columns)])})"
    return df.selectExpr(f"cast({row} AS decimal(38,0)) AS h").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("h").alias("digest")
    )


def determinism_check(first: DataFrame, second: DataFrame, columns: list[str]) -> DataFrame:
    """Two runs of one job: do they give the same rows, whatever the order."""
    other = multiset_digest(second, columns).selectExpr("struct(n_rows, digest) AS d")
    return (
        multiset_digest(first, columns)
        .select("n_rows", "digest", other.scalar().alias("other"))
        .selectExpr(
            "n_rows AS rows_a",
            "other.n_rows AS rows_b",
            "n_rows = other.n_rows AND digest <=> other.digest AS same",
        )
    )
