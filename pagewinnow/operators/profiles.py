"""Distribution profiles with exact percentiles that need no big sort.

The built-in exact ``percentile`` keeps every distinct value of a group in one
task.  Here values are counted first (map-side combined), a mergeable sketch
brackets each target rank, and only the few values inside a bracket are ranked
exactly; everything below and above is a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions import patterns as P
from pagewinnow.functions.text import listed, quoted
from pagewinnow.operators.markup import clean_markup
from pagewinnow.session import durable

SKETCH_ACCURACY = 10_000
SALTS = 16


def exact_percentiles(
    df: DataFrame, value: str, fractions: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """``<group>, fraction, cont, disc, total``; one row per group and fraction.

    ``cont`` interpolates between neighbours, ``disc`` is an existing value.
    Raises at run time if a bracket ever missed its rank, rather than answer
    with a wrong value.
    """
    group = list(group)
    values = df.selectExpr(*group, f"cast({value} AS double) AS v").where("v IS NOT NULL")
    counts = values.groupBy(*group, "v").agg(F.count(F.lit(1)).alias("n"))
    slack = 2.0 / SKETCH_ACCURACY
    low = ", ".join(repr(max(0.0, p - slack)) + "D" for p in fractions)
    high = ", ".join(repr(min(1.0, p + slack)) + "D" for p in fractions)
    literal = ", ".join(repr(float(p)) + "D" for p in fractions)
    sketched = values.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        F.expr(f"percentile_approx(v, array({low}), {SKETCH_ACCURACY}) AS lows"),
        F.expr(f"percentile_approx(v, array({high}), {SKETCH_ACCURACY}) AS highs"),
    )
    bracket = (
        f"transform(array({literal}), (p, i) -> "
        "struct(p AS fraction, get(lows, i) AS low, get(highs, i) AS high, total AS total))"
    )
    brackets = sketched.selectExpr(*group, f"{bracket} AS b")
    if group:
        # salted by value, so a group with a large share of all values is
        # spread over several tasks
        salt = f"pmod(xxhash64(v), {SALTS})"
        copies = brackets.withColumn("_salt", F.expr(f"explode(sequence(0L, {SALTS - 1}L))"))
        ranked = counts.withColumn("_salt", F.expr(salt)).join(copies, [*group, "_salt"]).drop("_salt")
    else:
        # a single row: a scalar subquery, not a join
        ranked = counts.withColumn("b", brackets.select("b").scalar())
    ranked = ranked.selectExpr(*group, "v", "n", "inline(b)")
    # -1 below, 0 inside, 1 above: only the inside keeps its single values
    place = "CASE WHEN v < low THEN -1 WHEN v > high THEN 1 ELSE 0 END"
    keys = [*group, "fraction", "total"]
    slots = (
        ranked.selectExpr(*keys, "v", "n", f"{place} AS place")
        .selectExpr(*keys, "v", "n", "place", "CASE WHEN place = 0 THEN v END AS slot")
        .groupBy(*keys, "place", "slot")
        .agg(F.sum("n").alias("n"), F.expr("CASE WHEN place < 0 THEN max(v) ELSE min(v) END AS v"))
    )
    over = f"OVER (PARTITION BY {', '.join([*group, 'fraction'])} ORDER BY place, slot ROWS UNBOUNDED PRECEDING)"
    summed = slots.selectExpr("*", f"sum(n) {over} AS upto")
    # zero-based target ranks
    position = "(fraction * (total - 1))"
    disc_rank = "(greatest(ceil(fraction * total), 1) - 1)"
    lower_rank = f"floor{position}"
    at = "min(CASE WHEN upto > {} THEN v END)"
    found = summed.groupBy(*keys).agg(
        F.expr(at.format(lower_rank) + " AS at_low"),
        F.expr(at.format(f"least({lower_rank} + 1, total - 1)") + " AS at_high"),
        F.expr(at.format(disc_rank) + " AS disc"),
        F.expr("coalesce(max(CASE WHEN place < 0 THEN upto END), 0) AS below"),
        F.expr("coalesce(min(CASE WHEN place > 0 THEN upto - n END), max(total)) AS inside_end"),
    )
    first, last = f"least({lower_rank}, {disc_rank})", f"greatest({lower_rank} + 1, {disc_rank})"
    sound = f"below <= {first} + 1 AND least({last}, total - 1) <= inside_end"
    cont = f"at_low + ({position} - {lower_rank}) * (at_high - at_low)"
    return found.selectExpr(
        *group,
        "fraction",
        f"CASE WHEN {sound} THEN {cont} ELSE raise_error('percentile bracket missed its rank') END AS cont",
        "disc",
        "total",
    )


def _beside(whole: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """One row of totals with ``p50``, ``p90`` and ``p99`` put beside it."""
    names = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    picked = ", ".join(f"max(CASE WHEN fraction = {p}D THEN cont END) AS {n}" for n, p in names.items())
    shares = exact_percentiles(values, value, list(names.values()))
    record = shares.agg(F.expr(f"struct({picked}) AS shares"))
    return whole.select("*", record.scalar().alias("_shares")).selectExpr(
        *whole.columns, *[f"_shares.{n} AS {n}" for n in names]
    )


def distribution(df: DataFrame, value: str, budget: float) -> DataFrame:
    """Mean, p50, p90, p99, max, count and how many are over the budget: one row."""
    values = durable(df.select(value))
    whole = values.agg(
        F.expr(f"count({value}) AS n"),
        F.expr(f"avg({value}) AS mean"),
        F.expr(f"cast(max({value}) AS double) AS max_value"),
        F.expr(f"count_if({value} > {budget!r}) AS over_budget"),
    )
    return _beside(whole, values, value)


def page_depth(pages: DataFrame) -> DataFrame:
    """``page_id, depth``: deepest raw-markup nesting of each page.

    A fold over the tags of the page inside its own row: linear in the page,
    and no shuffle or sort at all.  End tags that close nothing don't count.
    """
    tags = f"regexp_extract_all(markup, {quoted(P.ANY_TAG)}, 0)"
    name = "lower(regexp_extract(t, '^<([a-zA-Z][a-zA-Z0-9]*)', 1))"
    step = (
        f"CASE WHEN t LIKE '</%' THEN -1 WHEN t LIKE '%/>' OR {name} IN ('', {listed(P.VOID_TAGS)}) "
        "THEN 0 ELSE 1 END"
    )
    fold = (
        f"aggregate(transform({tags}, t -> {step}), named_struct('d', 0, 'm', 0), "
        "(a, s) -> named_struct('d', greatest(a.d + s, 0), 'm', greatest(a.m, a.d + s)), a -> a.m)"
    )
    return pages.selectExpr("page_id", f"{clean_markup('html')} AS markup").selectExpr(
        "page_id", f"{fold} AS depth"
    )


def nesting_profile(pages: DataFrame) -> DataFrame:
    """One row: depth percentiles and pages deeper than 50 and 500."""
    depths = durable(page_depth(pages).select("depth"))
    whole = depths.agg(
        F.count(F.lit(1)).alias("pages"),
        F.max("depth").alias("max_depth"),
        F.expr("count_if(depth > 50) AS over_50"),
        F.expr("count_if(depth > 500) AS over_500"),
    )
    return _beside(whole, depths, "depth")


def measurement_summary(measurements: DataFrame, key: str, value: str) -> DataFrame:
    """Median of the repeats and their spread; equal repeats have no spread."""
    ends = exact_percentiles(measurements, value, (0.0, 0.5, 1.0), [key])
    at = "max(CASE WHEN fraction = {}D THEN disc END)"
    return (
        ends.groupBy(key)
        .agg(
            F.max("total").alias("repeats"),
            *[F.expr(f"{at.format(p)} AS {n}") for n, p in (("low", 0.0), ("median", 0.5), ("high", 1.0))],
        )
        .selectExpr(
            key,
            "repeats",
            "median",
            "CASE WHEN low < high THEN low END AS fastest",
            "CASE WHEN low < high THEN high END AS slowest",
        )
    )


def stream_overlap(extracted: DataFrame) -> DataFrame:
    """Add ``shared_lines``: lines the comments repeat from the content.

    Both streams are on the row, so this is an array intersection, not a join.
    """
    lines = "filter(split({}, '\\n'), l -> l <> '')"
    shared = f"size(array_intersect({lines.format('content_text')}, {lines.format('comments_text')}))"
    return extracted.selectExpr("*", f"{shared} AS shared_lines")
