"""Work that is done once, and rows that are not made."""

import os

import pytest

from pagewinnow.catalog import queries as Q
from pagewinnow.operators.language import detect_by_profiles, language_profiles
from pagewinnow.operators.scoring import fscore_tripwire
from pagewinnow.options import ExtractOptions, OptionError
from pagewinnow.plans import sweep
from pagewinnow.plans.extract import process
from pagewinnow.sources.pages import read_page_tree
from tests.conftest import DATA, article, page


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_row_for_an_n_gram(spark):
    texts = [(1, "Der Hund und die Katze, der Hund und der Vogel " * 3, "de"), (2, "the dog and the cat and the bird " * 3, "en")]
    texts += [(3, None, None), (4, "1 2 3", None), (None, "the bird", None), (1, "der Hund", None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    found = detect_by_profiles(docs, language_profiles(docs), ["de", "en"])
    rows = {r.doc_id: (r.n_grams, r.detected) for r in found.collect()}
    grams = lambda text: sum(3 * len(w) + 1 for w in text.replace(",", "").split())
    assert rows[1] == (grams(texts[0][1]) + grams("der Hund"), "de") and rows[2] == (grams(texts[1][1]), "en")
    assert rows[3] == rows[4] == (0, None) and rows[None] == (grams("the bird"), None)
    assert "Generate" not in plan_of(found)


def test_scores_are_worked_out_once(spark):
    scores = spark.range(3).selectExpr("concat('r', id) AS run", "id / 2D AS f_score")
    found = fscore_tripwire(scores, "r2")
    assert {(r.run, r.status) for r in found.collect()} == {("r0", "reported"), ("r1", "reported"), ("r2", "pass")}
    assert "Range" not in plan_of(found)


def test_compared_runs_are_stored(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", article(f"<p>{i}</p>")) for i in (6, 7, 8)], "page_id LONG, url STRING, html STRING")
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    made, own = [], Q.E.process
    monkeypatch.setattr(Q.E, "process", lambda *a, **k: made.append(own(*a, **k)) or made[-1])
    found = Q.determinism_check(spark, str(tmp_path))
    assert {(r.against, r.same) for r in found.collect()} == {("shuffled", True), ("changed", False), ("longer", False)}
    assert len(made) == 2 and not any("pages.parquet" in f for f in found.inputFiles())


def test_a_block_is_sorted_once_for_all_focuses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.org/1", article("<p>One.</p>"))], "page_id LONG, url STRING, html STRING")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    runs = Q._statistical_runs(spark, str(tmp_path))
    assert {r.run for r in runs.collect()} == {"favor_precision", "balanced", "favor_recall"}
    plan = plan_of(runs)
    # rows multiply above the windows, not below
    assert plan.index("Generate") < plan.index("Window")


def test_tasks_put_files_of_pages_in_place(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    pages = spark.createDataFrame([(i, None, f"<p>{i}</p>") for i in (1, 2)], "page_id LONG, url STRING, html STRING")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    asked, own = {}, DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: asked.update({k: v}) or own(self, k, v))
    assert sorted(r.file_id for r in Q.read_page_tree_q(spark, str(tmp_path)).collect()) == [1, 2]
    assert asked["mapreduce.fileoutputcommitter.algorithm.version"] == "2"


def test_a_tree_of_many_folders_takes_few_tasks(spark, tmp_path, monkeypatch):
    """Folders are listed and files read by tasks for many of them, and no page has a file of checksums."""
    n, name = 400, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    pages = spark.createDataFrame([(i, None, f"<p>{i}</p>") for i in range(n)], "page_id LONG, url STRING, html STRING")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    before, root = spark.conf.get(name), str(tmp_path / "made")
    monkeypatch.setattr(Q, "_fresh", lambda *_: root)
    found = Q.read_page_tree_q(spark, str(tmp_path))
    assert sorted(r.file_id for r in found.collect()) == list(range(n)) and spark.conf.get(name) == before
    assert not any(f.endswith(".crc") for _, folders, files in os.walk(root) if not folders for f in files)
    context, cores = spark.sparkContext, spark.sparkContext.defaultParallelism
    context.setJobGroup("tree", "listing")
    tree = read_page_tree(spark, root, "*.txt")
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("tree") for s in tracker.getJobInfo(j).stageIds]
    tasks = [x.numTasks for s in stages if (x := tracker.getStageInfo(s))]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 16 * cores < n, tasks
    assert {r.page_id for r in tree.collect()} == set(range(n))


def test_a_sweep_gives_each_set_what_process_gives(spark):
    """Also where a page is over one cap alone, over both, no UTF-8, empty, or shares its id."""
    bodies = [article(), article("<table><tr><td>Figures</td></tr></table>"), article("<p>Long.</p>" * 300), article("<p>Huge.</p>" * 3000), "", page("<nav>Home</nav>")]
    rows = [(i, f"https://example.org/{i}", b.encode()) for i, b in enumerate(bodies)]
    rows += [(10, "https://example.org/10", b"<p>\xff</p>"), (11, None, None), (12, "https://example.org/a", article().encode()), (12, "https://example.org/b", article().encode())]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html BINARY")
    sets = [
        ExtractOptions(max_input_bytes=20000),
        ExtractOptions(focus="favor_precision", max_input_bytes=2000),
        ExtractOptions(exclude_tables=True, enable_fallback=True, include_links=True, max_input_bytes=20000),
    ]
    swept = sweep.process_sweep(pages, sets).collect()
    for i, options in enumerate(sets):
        expected = sorted((str(r.asDict(True)) for r in process(pages, options).collect()))
        found = sorted(str({k: v for k, v in r.asDict(True).items() if k != "option_id"}) for r in swept if r.option_id == i)
        assert found == expected, i
    with pytest.raises(OptionError, match="deduplicate"):
        sweep.process_sweep(pages, [ExtractOptions(deduplicate=True)])


def test_both_snapshots_come_from_one_extraction(spark, monkeypatch):
    """Two option sets, one reading of the pages: the blocks are cut once."""
    calls = []
    cut = Q.E.content_blocks
    for module in (sweep, Q.E):
        monkeypatch.setattr(module, "content_blocks", lambda *a, **b: calls.append(1) or cut(*a, **b))
    a, b = Q._snapshots(spark, DATA)
    assert len(calls) == 1 and a.count() == b.count() > 0


def test_a_run_record_reads_the_pages_in_one_sweep(spark, monkeypatch):
    """The compared and the scored runs share a sweep; the container-blind runs have blocks of their own."""
    calls = []
    cut = Q.E.content_blocks
    for module in (sweep, Q.E):
        monkeypatch.setattr(module, "content_blocks", lambda *a, **b: calls.append(1) or cut(*a, **b))
    assert Q.run_record_q(spark, DATA).columns == ["run_date", "corpus_version", "pages", "verdict", "fscore"]
    assert len(calls) == 2
