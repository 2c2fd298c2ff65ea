import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewinnow.operators import compare as C
from pagewinnow.operators import profiles as P
from pagewinnow.operators import repeats as R
from pagewinnow.operators import scoring as S
from pagewinnow.operators.ledger import REASONS, outcome_tally
from pagewinnow.options import ExtractOptions
from pagewinnow.plans.extract import content_blocks, ledger, process
from tests.conftest import DATA, article


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{DATA}/pages.parquet")


def test_ledger_holds_every_page_once(spark, pages):
    rows = ledger(pages, max_input_bytes=3000, target_language="en").collect()
    assert len({r.page_id for r in rows}) == len(rows) == pages.count()
    assert all((r.outcome == "ok") == (r.reason is None) for r in rows)
    assert {r.reason for r in rows if r.reason} <= set(REASONS)


def test_tally_subtotals(spark):
    rows = spark.createDataFrame([("a", "ok", True), ("a", "refused", False), ("b", "ok", False)], "host STRING, outcome STRING, lossy BOOLEAN")
    found = {(r.level, r.host, r.outcome): (r.pages, r.lossy) for r in outcome_tally(rows, "lossy").collect()}
    assert found[3, None, None] == (3, 1) and found[1, "a", None] == (2, 1) and found[0, "b", "ok"] == (1, 0)


def test_snapshot_diff_and_verdict(pages_of):
    teaser = article('<div class="teaser"><p>A teaser here.</p></div>')
    a = process(pages_of(article(), teaser, "<p></p>"))
    b = process(pages_of(article(), teaser, article(), article()), focus="favor_recall")
    rows = {(r.page_id, r.field, r.change) for r in C.snapshot_diff(a, b).collect()}
    assert {r for r in rows if r[0] == 1} == {(1, "content_text", "changed"), (1, "content_html", "changed")}
    assert (2, "outcome", "changed") in rows and (3, "page", "only_b") in rows
    assert not any(r[0] == 0 for r in rows) and sum(r[0] == 3 for r in rows) == 1
    verdict = lambda x, y, v, w: C.diff_verdict(x, y, v, w).first()
    found = verdict(a, b, "1", "2")
    assert (found.verdict, found.pages_changed, found.pages_a, found.pages_b) == ("non-empty", 3, 3, 4)
    assert verdict(a, a, "1", "2").verdict == "empty"
    assert verdict(a, a, "1", "1").verdict == "broken"
    assert verdict(a.where("false"), a, "1", "2").verdict == "broken"


def test_manifest_tells_one_item_from_two(pages_of):
    one, two = '<meta property="article:tag" content="a\nb">', '<meta property="article:tag" content="a"><meta property="article:tag" content="b">'
    rows = {(r.page_id, r.field): r for r in C.dump_manifest(process(pages_of(article("", one), article("é", two)))).collect()}
    assert len(rows) == 2 * 18
    assert (rows[0, "tags"].n_items, rows[1, "tags"].n_items) == (1, 2)
    assert rows[0, "tags"].digest != rows[1, "tags"].digest
    assert rows[0, "date"].n_items == 0 and rows[0, "date"].digest is None
    assert rows[1, "content_text"].n_bytes == rows[0, "content_text"].n_bytes + len("\né".encode())


def test_scoring_counts(spark):
    truth = spark.createDataFrame(
        [(1, "with", "aa"), (1, "with", "zz"), (1, "without", "bb"), (1, "without", "qq"), (2, "with", "cc")],
        "page_id BIGINT, kind STRING, snippet STRING",
    )
    runs = spark.createDataFrame([("default", 1, "aa bb"), ("default", 2, "cc")], "run STRING, page_id BIGINT, content_text STRING")
    row = S.score_extraction(runs, truth).first()
    assert (row.tp, row.fn, row.fp, row.tn) == (2, 1, 1, 1)
    assert row.precision == pytest.approx(2 / 3) and row.f_score == pytest.approx(4 / 6)
    scores = spark.createDataFrame([("default", 0.9), ("fallback", 0.2)], "run STRING, f_score DOUBLE")
    found = {r.run: r.status for r in S.fscore_tripwire(scores, "default").collect()}
    assert found == {"default": "fail", "fallback": "reported"}
    assert S.fscore_tripwire(scores, "default", 0.9).first().status == "pass"


@pytest.mark.parametrize("sample", ["normal", "hot", "tiny", "single", "integers"])
def test_percentiles_are_exact(spark, sample):
    rng = np.random.default_rng(7)
    values = {
        "normal": rng.normal(size=60_000),
        "hot": np.concatenate([np.full(30_000, 3.5), rng.exponential(size=30_000)]),
        "tiny": rng.normal(size=12),
        "single": np.array([4.25]),
        "integers": rng.integers(0, 50, size=20_000).astype(float),
    }[sample]
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(values)], "v DOUBLE, g INT").repartition(6)
    shares = (0.0, 0.01, 0.5, 0.9, 0.99, 1.0)
    for group, part in (((), values), (("g",), values[1::2])):
        rows = P.exact_percentiles(df, "v", shares, group).collect()
        if group:
            rows = [r for r in rows if r.g == 1]
            if not len(part):
                continue
        found = {r.fraction: r for r in rows}
        for p in shares:
            assert found[p].cont == pytest.approx(np.quantile(part, p), rel=1e-12, abs=1e-12)
            assert found[p].disc == np.quantile(part, p, method="inverted_cdf")


def test_single_measurement_has_no_spread(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("b", 9.0), ("b", 2.0)], "k STRING, v DOUBLE")
    found = {r.k: (r.median, r.fastest, r.slowest) for r in P.measurement_summary(df, "k", "v").collect()}
    assert found == {"a": (3.0, None, None), "b": (2.0, 1.0, 9.0)}


def test_same_rows_under_two_partitionings(pages):
    columns = ["page_id", "content_text", "content_html", "outcome"]
    first, second = process(pages), process(pages.repartition(5, "url"))
    assert C.determinism_check(first, second, columns).first().same
    changed = second.withColumn("content_text", F.when(F.col("page_id") == 3, "x").otherwise(F.col("content_text")))
    assert not C.determinism_check(first, changed, columns).first().same


def brute_duplicates(rows):
    first = {}
    for i, text in sorted(rows):
        first.setdefault(text, i)
    return {i for i, text in rows if text and first[text] < i}


def test_hot_body_is_found_whatever_its_share(spark):
    rows = [(i, "hot" if i % 3 == 0 else ("" if i % 50 == 1 else f"text {i // 2}")) for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id BIGINT, content_text STRING").repartition(7)
    found = {r.page_id for r in R.duplicate_pages(df).where("first_page < page_id").collect()}
    assert found == brute_duplicates(rows)
    assert R.duplicate_pages(df).count() == len(rows)


@pytest.mark.parametrize("by_host", [False, True])
def test_repeated_blocks_by_brute_force(spark, by_host):
    rows = [(p, b, f"h{p % 3}.org", ["Share this", f"© h{p % 3}.org all", f"own {p}", f"pair {p // 2}", ""][b]) for p in range(300) for b in range(5)]
    df = spark.createDataFrame(rows, "page_id BIGINT, block_no INT, host STRING, text STRING").repartition(5)
    seen = {}
    for p, b, h, t in rows:
        seen.setdefault(((h if by_host else ""), t.replace(h, "")), set()).add(p)
    expected = {(p, b) for p, b, h, t in rows if not t or len(seen[(h if by_host else ""), t.replace(h, "")]) <= 2}
    found = {(r.page_id, r.block_no) for r in R.dedup_blocks(df, 2, by_host).collect()}
    assert found == expected


def exchanged_columns(spark, build):
    """Input columns of every exchange of a plan, with broadcasts ruled out."""
    import contextlib
    import io

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            build().explain("formatted")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = out.getvalue()
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text
    details = text.split("\n\n")
    return [d.split("Input", 1)[1].split("\n")[0] for d in details if re.match(r"\(\d+\) Exchange", d.strip())]


def test_text_is_not_shuffled_again_for_repeats(spark, pages):
    def blocks():
        rows = content_blocks(pages, ExtractOptions())
        return R.dedup_blocks(rows.selectExpr("page_id", "block_no", "'h' AS host", "text", "body"), 3)

    inputs = exchanged_columns(spark, blocks)
    assert sum("marked#" in i for i in inputs) == 1
    assert not any("text#" in i or "body#" in i for i in inputs)


def test_content_is_not_shuffled_again_for_duplicates(spark, pages):
    inputs = exchanged_columns(spark, lambda: process(pages, deduplicate=True))
    assert sum("marked#" in i for i in inputs) == 1
    assert not any("content_text#" in i or "_kept#" in i for i in inputs)


def test_overlapping_streams(pages_of):
    same = article("<p>Said twice.</p>").replace("</body>", '<div class="comments"><p>Said twice.</p><p>Other.</p></div></body>')
    assert P.stream_overlap(process(pages_of(same, article()))).orderBy("page_id").select("shared_lines").collect() == [(1,), (0,)]


def test_images_and_links(spark, pages_of):
    from pagewinnow.operators import links as K

    rows = content_blocks(
        pages_of(article('<p><img src="/a.png" alt="A"><img src=data:x><a href="b?c=1&amp;d">x</a><a href="mailto:x@y.z">m</a><a href="#top">t</a></p>')), ExtractOptions()
    ).withColumn("base", F.lit("https://e.org/dir/page.html"))
    images = K.image_rows(rows).orderBy("pos").collect()
    assert [(r.src, r.alt, r.is_data_uri) for r in images] == [("https://e.org/a.png", "A", False), ("data:x", "", True)]
    edges = K.link_edges(rows).orderBy("pos").collect()
    assert [r.target for r in edges] == ["https://e.org/dir/b?c=1&d", "https://e.org/dir/page.html#top"]
