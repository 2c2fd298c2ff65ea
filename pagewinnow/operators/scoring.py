"""Extraction scored against ground truth by substring containment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pagewinnow.functions.text import listed, quoted
from pagewinnow.session import durable

RELEASE_FLOOR = 0.903


def _beside_contents(extracted: DataFrame, truth: DataFrame) -> DataFrame:
    """The truth with a map of what each run made of the page; no content is repeated per snippet and run."""
    contents = extracted.groupBy("page_id").agg(
        F.map_from_entries(F.collect_list(F.struct("run", "content_text"))).alias("_contents")
    )
    return truth.join(contents, "page_id", "left")


def _found_in(run: str) -> str:
    """A page that a run lacks finds nothing."""
    return f"coalesce(contains(try_element_at(_contents, {run}), snippet), false)"


def judged_runs(extracted: DataFrame, truth: DataFrame, runs: Sequence[str] | None = None) -> DataFrame:
    """``run, page_id, kind, snippet, found``: every snippet of the truth in every run.

    Expects ``run, page_id, content_text``, a page once per run.  The truth joins
    the contents on ``page_id`` once.  ``runs`` defaults to the runs that are
    there, a short list, for which a job is started.
    """
    if runs is None:
        runs = sorted(r[0] for r in extracted.select("run").distinct().collect())
    return _beside_contents(extracted, truth).selectExpr(
        "page_id", "kind", "snippet", f"inline(transform(array({listed(runs)}), r -> struct(r AS run, {_found_in('r')} AS found)))"
    )


def score_extraction(extracted: DataFrame, truth: DataFrame, runs: Sequence[str] | None = None) -> DataFrame:
    """Score one or more runs; see ``judged_runs`` for the input.

    Containment is worked out on the joined row; only counts are exchanged after.
    """
    return score_judged(judged_runs(extracted, truth, runs))


def score_judged(judged: DataFrame, run: str = "run") -> DataFrame:
    """Counts and rates per run from ``kind, found`` rows.

    Partial sums combine map-side, so only one row per run and task is moved.
    """
    cells = {
        "tp": "kind = 'with' AND found",
        "fn": "kind = 'with' AND NOT found",
        "fp": "kind = 'without' AND found",
        "tn": "kind = 'without' AND NOT found",
    }
    counts = judged.groupBy(run).agg(
        *[F.expr(f"count_if({test}) AS {name}") for name, test in cells.items()]
    )
    return counts.selectExpr(
        "*",
        "try_divide(tp, tp + fp) AS precision",
        "try_divide(tp, tp + fn) AS recall",
        "try_divide(tp + tn, tp + tn + fp + fn) AS accuracy",
        "try_divide(2 * tp, 2 * tp + fp + fn) AS f_score",
    )


def fscore_tripwire(
    scores: DataFrame, gate_row: str, floor: float = RELEASE_FLOOR, run: str = "run"
) -> DataFrame:
    """Every row reported; only the row of the default options can fail.

    Without that row nothing has been gated, which is a failure as well.  The
    scores, a row per run, are read twice and worked out once.
    """
    scores = durable(scores)
    there = scores.agg(F.coalesce(F.expr(f"bool_or({run} = '{gate_row}')"), F.lit(False)).alias("there"))
    absent = there.where("NOT there").selectExpr(
        f"'{gate_row}' AS {run}", "cast(NULL AS double) AS f_score", "'fail' AS status"
    )
    return scores.selectExpr(
        run,
        "f_score",
        f"CASE WHEN {run} <> '{gate_row}' THEN 'reported' "
        f"WHEN f_score >= {floor!r} THEN 'pass' ELSE 'fail' END AS status",
    ).unionByName(absent)


def score_dates(extracted: DataFrame, truth: DataFrame) -> DataFrame:
    """Dates right, wrong and missing; precision over the answered ones.

    Expects ``page_id, metadata`` and truth ``page_id, date``.
    """
    answers = extracted.selectExpr("page_id", "metadata.date AS found")
    return (
        truth.where("date IS NOT NULL")
        .join(answers, "page_id", "left")
        .agg(
            F.expr("count_if(found <=> date) AS correct"),
            F.expr("count_if(found IS NOT NULL AND found <> date) AS wrong"),
            F.expr("count_if(found IS NULL) AS missing"),
        )
        .selectExpr("*", "try_divide(correct, correct + wrong) AS precision_when_answered")
    )


def paired_agreement(extracted: DataFrame, truth: DataFrame, run_a: str, run_b: str) -> DataFrame:
    """2x2 table of two runs judged on the same truth; see ``judged_runs`` for the input.

    A snippet is right when it is found for ``with`` and not found for
    ``without``.  Both runs are judged on the joined row; only counts move on.
    """
    right = lambda run: f"(kind = 'with') = {_found_in(quoted(run))}"
    both = _beside_contents(extracted, truth).selectExpr(f"{right(run_a)} AS a_right", f"{right(run_b)} AS b_right")
    return both.groupBy("a_right", "b_right").agg(F.count(F.lit(1)).alias("n"))
