"""Faults that green rows once hid."""

from pyspark.sql import functions as F

from pagewinnow.operators import compare, profiles, scoring
from pagewinnow.options import ExtractOptions
from pagewinnow.plans.extract import process
from pagewinnow.plans.sweep import option_sweep
from pagewinnow.sources.pages import read_page_tree
from pagewinnow.sources.sinks import split_sinks
from pagewinnow.streaming.jobs import stream_dedup
from tests.conftest import article, page


def test_missing_pages_count_against_a_run(spark):
    runs = spark.createDataFrame([("a", 1, "x y"), ("b", 1, "x y"), ("b", 2, "z")], "run STRING, page_id LONG, content_text STRING")
    truth = spark.createDataFrame([(1, "with", "x"), (2, "with", "z"), (2, "without", "q")], "page_id LONG, kind STRING, snippet STRING")
    scores = {r.run: (r.tp, r.fn, r.tn, r.recall) for r in scoring.score_extraction(runs, truth).collect()}
    assert scores == {"a": (1, 1, 1, 0.5), "b": (2, 0, 1, 1.0)}
    none = scoring.score_extraction(runs, truth, ["a", "c"]).where("run = 'c'").first()
    assert (none.tp, none.fn) == (0, 2)


def test_no_gate_row_is_a_failure(spark):
    scores = spark.createDataFrame([("other", 0.99)], "run STRING, f_score DOUBLE")
    found = {r.run: r.status for r in scoring.fscore_tripwire(scores, "default").collect()}
    assert found == {"other": "reported", "default": "fail"}
    assert scoring.fscore_tripwire(scores, "other").collect()[0].status == "pass"


def test_where_a_null_stands_matters(spark):
    a = spark.createDataFrame([("x", None)], "p STRING, q STRING")
    b = spark.createDataFrame([(None, "x")], "p STRING, q STRING")
    assert not compare.determinism_check(a, b, ["p", "q"]).first().same
    assert compare.determinism_check(a, a, ["p", "q"]).first().same


def test_a_moved_bad_byte_is_drift(spark):
    pages = lambda data: spark.createDataFrame([(1, bytearray(data))], "page_id LONG, html BINARY")
    a, b = process(pages(b"ab\x93cd")), process(pages(b"abc\x93d"))
    assert [(r.field, r.change) for r in compare.snapshot_diff(a, b).collect()] == [("outcome", "changed")]
    assert compare.diff_verdict(a, b, "1", "2").first().verdict == "non-empty"


def test_stray_end_tags_close_nothing(pages_of):
    depth = profiles.page_depth(pages_of("</div></div></div><div><div><div>", "</p><b>")).orderBy("page_id")
    assert [r.depth for r in depth.collect()] == [3, 1]


def test_equal_repeats_have_no_spread(spark):
    rows = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 1.0), ("b", 3.0)], "k STRING, v DOUBLE")
    found = {r.k: (r.fastest, r.slowest) for r in profiles.measurement_summary(rows, "k", "v").collect()}
    assert found == {"a": (None, None), "b": (1.0, 3.0)}


def test_blank_pages_are_no_copies(spark):
    rows = spark.createDataFrame([(1, "", 0), (2, None, 0), (3, "x", 0), (4, " x ", 0)], "page_id LONG, html STRING, s INT")
    kept = stream_dedup(rows.withColumn("ingest_ts", F.timestamp_seconds("s")))
    assert sorted(r.body_sha is None for r in kept.collect()) == [False, True, True] and "_body" not in kept.columns


def test_pages_of_one_id_are_refused_together(spark):
    rows = [(1, None, article()), (1, None, article("<p>other words</p>")), (2, None, article()), (None, None, article()), (None, None, "")]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    for options in ({}, {"prune_selector": ".x"}, {"deduplicate": True}, {"include_links": True, "max_input_bytes": 100_000}):
        found = {r.page_id: r for r in process(pages, **options).collect()}
        assert len(found) == 3 and found[2].outcome == "ok"
        for i in (1, None):
            assert (found[i].reason, found[i].reason_detail, found[i].content_text, found[i].metadata) == ("duplicate_id", "2", "", None)
    swept = {r.page_id: r.content_text for r in option_sweep(pages, [ExtractOptions()]).collect()}
    assert swept[1] == "" and swept[2] != ""


def test_refused_pages_leave_no_text(spark, pages_of, tmp_path):
    done = process(pages_of(article(), page("<p>x</p>" * 9)), max_input_bytes=300)
    split_sinks(done, str(tmp_path / "sinks"))
    rows = spark.read.parquet(str(tmp_path / "sinks")).where("outcome <> 'ok'").collect()
    assert rows and all(r.content_text == '' and r.metadata is None for r in rows)


def test_files_below_a_folder_named_like_the_root(spark, tmp_path):
    root = tmp_path / "r"
    inner = root / ("y" + str(root)[1:])
    inner.mkdir(parents=True)
    (root / "a.html").write_text("one")
    (inner / "a.html").write_text("two")
    tree = read_page_tree(spark, str(root)).collect()
    assert {r.page_id for r in tree} == {0, 1} and {r.path for r in tree} == {"a.html", f"y{str(root)[1:]}/a.html"}


def test_links_of_a_tag_with_many_attributes(pages_of):
    many = " ".join(f'data-{i}="{i}"' for i in range(400))
    html = article(f'<p>See <a {many} href="/far">there</a> <img {many} alt="a > b" src="/i.png"></p>')
    text = process(pages_of(html, urls={0: "https://h.org/"}), include_links=True, include_images=True).first().content_html
    assert "https://h.org/far" in text and "https://h.org/i.png" in text and '">"' not in text


def test_a_wrapper_that_has_a_sidebar_is_none(pages_of):
    inner = article().split("<body>")[1].split("</body>")[0]
    rows = process(pages_of(page(f'<div class="wrap has-sidebar">{inner}</div>'), page(f'<div class="sidebar-left">{inner}</div>')))
    found = {r.page_id: r.outcome for r in rows.collect()}
    # an article counts inside a wrapper, whatever its class says
    assert found == {0: "ok", 1: "ok"}


def test_preformatted_lines_stay(pages_of):
    row = process(pages_of(article("<pre>\nif a:\n    <b>b</b>()\n</pre>"))).first()
    assert "<pre>if a:\n    <b>b</b>()</pre>" in row.content_html


def test_the_manifest_has_refused_pages(pages_of):
    rows = compare.dump_manifest(process(pages_of(article(), page("")))).collect()
    fields = {i: {r.field: r.n_bytes for r in rows if r.page_id == i} for i in (0, 1)}
    assert fields[0]["outcome"] == 2 and "error" not in fields[0] and fields[0]["content_text"] > 0
    assert fields[1] == {"outcome": 7, "error": len("insufficient_content")}
