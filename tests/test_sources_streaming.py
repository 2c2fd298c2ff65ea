import datetime as dt

from pyspark.sql import functions as F

from pagewinnow.plans.extract import ledger, process
from pagewinnow.sources.pages import read_page_tree, read_pages
from pagewinnow.sources.sinks import append_run, read_accepted, read_refused, run_record, split_sinks
from pagewinnow.streaming.jobs import read_page_stream, read_tally, stream_dedup, stream_extract, stream_tally, stream_tally_sink, stream_unique
from tests.conftest import DATA, article

CAP = 2600


def test_page_tree_is_keyed_by_relative_path(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "one.html").write_text(article())
    (tmp_path / "a" / "b" / "two.html").write_bytes(b"<p>\x93</p>")
    (tmp_path / "a" / "skip.txt").write_text("no")
    pages = read_page_tree(spark, str(tmp_path))
    rows = {r.path: r for r in pages.collect()}
    assert set(rows) == {"one.html", "a/b/two.html"}
    reasons = {r.page_id: r.reason for r in ledger(pages).collect()}
    assert reasons == {rows["one.html"].page_id: None, rows["a/b/two.html"].page_id: "invalid_utf8"}


def test_small_input_can_be_spread(spark):
    path = f"{DATA}/pages.parquet"
    assert read_pages(spark, path, 6).rdd.getNumPartitions() == 6
    assert read_pages(spark, path, 6).count() == read_pages(spark, path).count()


def test_sinks_split_every_page(spark, tmp_path):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    done = process(pages, max_input_bytes=CAP)
    split_sinks(done, str(tmp_path / "out"))
    kept, refused = read_accepted(spark, str(tmp_path / "out")), read_refused(spark, str(tmp_path / "out"))
    assert kept.count() + refused.count() == pages.count() and refused.count() > 0
    assert {r.reason for r in refused.select("reason").distinct().collect()} == {"input_too_large"}
    want = done.where("outcome = 'ok'").select(kept.columns)
    assert kept.exceptAll(want).count() == 0 and want.exceptAll(kept).count() == 0


def test_run_records_append(spark, tmp_path):
    verdict = spark.createDataFrame([(5, "empty")], "pages_b BIGINT, verdict STRING")
    scores = spark.createDataFrame([("default", 0.95)], "run STRING, f_score DOUBLE")
    for day in (1, 2):
        record = run_record(spark, verdict, scores, dt.date(2024, 1, day), "c1", "default")
        append_run(record, str(tmp_path / "runs"))
    rows = spark.read.parquet(str(tmp_path / "runs")).orderBy("run_date").collect()
    assert [(r.pages, r.verdict, r.fscore) for r in rows] == [(5, "empty", 0.95)] * 2


def stream_source(spark, tmp_path, files=3):
    source = str(tmp_path / "in")
    spark.read.parquet(f"{DATA}/pages.parquet").repartition(files).write.parquet(source)
    return source


def test_streamed_extraction_equals_the_batch(spark, tmp_path):
    source = stream_source(spark, tmp_path)
    sink = str(tmp_path / "out")
    query = stream_extract(read_page_stream(spark, source), sink, str(tmp_path / "cp"), max_input_bytes=CAP)
    query.awaitTermination(240)
    assert query.exception() is None
    batch = process(spark.read.parquet(source), max_input_bytes=CAP)
    found = spark.read.parquet(sink)
    want = batch.select("page_id", "content_text", "outcome", "reason")
    got = found.select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def drain(spark, df, name, tmp_path, mode="append"):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    query.awaitTermination(240)
    assert query.exception() is None
    return spark.table(name)


def timed(df):
    return df.withColumn("ingest_ts", F.expr("timestampadd(SECOND, cast(page_id AS int) * 60, timestamp'2024-01-01')"))


def test_windowed_tally_equals_the_batch(spark, tmp_path):
    source = stream_source(spark, tmp_path, 1)
    live = timed(read_page_stream(spark, source))
    streamed = drain(spark, stream_tally(live, late="1 second", max_input_bytes=CAP), "tally", tmp_path, "complete")
    batch = stream_tally(timed(spark.read.parquet(source)), max_input_bytes=CAP)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_streamed_dedup_keeps_one_page_per_body(spark, tmp_path):
    source = str(tmp_path / "in")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id AS page_id", "cast(NULL AS string) AS url", "text AS html")
    docs.repartition(3).write.parquet(source)
    live = read_page_stream(spark, source).withColumn("ingest_ts", F.expr("timestamp'2024-01-01'"))
    streamed = drain(spark, stream_dedup(live), "dedup", tmp_path)
    batch = stream_dedup(spark.read.parquet(source).withColumn("ingest_ts", F.expr("timestamp'2024-01-01'")))
    bodies = lambda df: sorted(bytes(r.body_sha).hex() for r in df.select("body_sha").collect())
    assert bodies(streamed) == bodies(batch) and len(bodies(batch)) < docs.count()


def copies(spark, tmp_path):
    """Three files in the order of page ids; bodies recur inside and across them."""
    texts = [article(f"<p>Body number {n} of them all.</p>") for n in (0, 1, 1, 2, 0, 3, 2, 2, 4, 1, 0, 5)]
    rows = [(i, None, t) for i, t in enumerate(texts)] + [(20, None, ""), (21, None, "")]
    for k in range(3):
        part = spark.createDataFrame(rows[k * 5 : k * 5 + 5], "page_id BIGINT, url STRING, html STRING")
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{k}"))
    return rows


def test_copies_across_batches(spark, tmp_path):
    """Each file is a batch: the stream refuses what the batch job refuses."""
    rows = copies(spark, tmp_path)
    sink, state, index = (str(tmp_path / x) for x in ("out", "cp", "bodies"))
    source = str(tmp_path / "live")
    for k in range(3):
        spark.read.parquet(str(tmp_path / f"in/{k}")).coalesce(1).write.mode("append").parquet(source)
        query = stream_extract(read_page_stream(spark, source), sink, state, index=index, deduplicate=True)
        query.awaitTermination(240)
        assert query.exception() is None
    frame = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    look = lambda df: sorted((r.page_id, r.outcome, r.reason) for r in df.collect())
    want = look(process(frame, deduplicate=True))
    assert look(spark.read.parquet(sink)) == want
    assert sum(r == "duplicate_content" for _, _, r in want) == 6
    entries = lambda: sorted((bytes(r.body), r.first_page) for r in spark.read.parquet(index).collect())
    before = entries()
    assert [p for _, p in sorted(before, key=lambda x: x[1])] == [0, 1, 3, 5, 8, 11]

    # the second batch comes again, as after a failure
    from pagewinnow.operators.repeats import new_bodies
    from pagewinnow.options import ExtractOptions
    from pagewinnow.plans.extract import process_with_bodies

    seen = spark.read.parquet(index).where("batch_id < 1").select("body", "first_page")
    again, hashed = process_with_bodies(spark.read.parquet(str(tmp_path / "in/1")), ExtractOptions(deduplicate=True), seen=seen)
    assert look(again) == [w for w in want if 5 <= w[0] < 10]
    assert {r.first_page for r in new_bodies(hashed, seen).collect()} == {5, 8}

    # another run finds all of it seen
    query = stream_extract(read_page_stream(spark, source), f"{sink}-2", f"{state}-2", index=index, run="second", deduplicate=True)
    query.awaitTermination(240)
    assert {r.reason for r in spark.read.parquet(f"{sink}-2").collect()} == {"duplicate_content", "insufficient_content"}
    assert entries() == before


def test_the_index_is_filtered_before_it_is_exchanged(spark):
    from pagewinnow.operators.repeats import body_hashes, seen_bodies

    seen = spark.range(5000).selectExpr("unhex(sha2(cast(id AS string), 256)) AS body", "id AS first_page")
    pages = spark.createDataFrame([(1, "17"), (2, "x"), (3, "4999"), (4, "")], "page_id BIGINT, content_text STRING")
    found = seen_bodies(body_hashes(pages), seen)
    assert sorted(r.seen_page for r in found.collect()) == [17, 4999]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("bitmap_construct_agg") > 0 and "BroadcastHashJoin" in plan


def test_files_are_numbered_by_path(spark, tmp_path):
    names = [f"{d}/{i:03}.html" for d in ("b", "a", "a/c", "ä") for i in range(40)]
    for n in names:
        path = tmp_path / "tree" / n
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"<p>{n}</p>")
    found = {r.path: (r.page_id, bytes(r.html).decode()) for r in read_page_tree(spark, str(tmp_path / "tree")).collect()}
    order = sorted(names, key=lambda n: n.encode())
    assert {n: found[n][0] for n in names} == {n: i for i, n in enumerate(order)}
    assert all(found[n][1] == f"<p>{n}</p>" for n in names)
    assert read_page_tree(spark, str(tmp_path / "tree"), "*.none").count() == 0


def test_a_replayed_tally_changes_nothing_and_late_rows_are_counted(spark, tmp_path):
    sink, source = str(tmp_path / "out"), str(tmp_path / "in")
    frame = lambda rows: spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, s INT").selectExpr("page_id", "url", "html", "timestamp_seconds(s) AS ingest_ts")
    for rows in ([(1, None, "a", 0), (2, None, "b", 200)], [(3, None, "c", 30), (4, None, "d", 170), (5, None, "x" * 99, 300)], [(6, None, "e", 10), (7, None, "f", 290)]):
        frame(rows).coalesce(1).write.mode("append").parquet(source)
        live = spark.readStream.schema(frame(rows).schema).parquet(source)
        stream_tally_sink(live, sink, str(tmp_path / "cp"), late="60 seconds", max_input_bytes=50).awaitTermination(240)
    look = lambda: sorted((r.window_start.timestamp(), r.reason, r.late, r.closed, r.pages) for r in read_tally(spark, sink, "60 seconds").collect())
    want = [
        (0.0, "ok", False, True, 1), (0.0, "ok", True, True, 2), (120.0, "ok", False, True, 1),
        (180.0, "ok", False, True, 1), (240.0, "ok", False, False, 1), (300.0, "input_too_large", False, False, 1),
    ]
    assert look() == want
    # from the beginning, over what has been written
    live = spark.readStream.schema(frame([(1, None, "a", 0)]).schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream_tally_sink(live, sink, str(tmp_path / "again"), late="60 seconds", max_input_bytes=50).awaitTermination(240)
    assert look() == want


def test_unique_bodies_without_pages_in_state(spark, tmp_path):
    rows = [(1, "a"), (2, " a "), (3, ""), (4, None), (5, "b"), (6, ""), (7, "a"), (8, "b"), (9, "c")]
    sink, source = str(tmp_path / "out"), str(tmp_path / "in")
    for part in (rows[:4], rows[4:7], rows[7:]):
        spark.createDataFrame(part, "page_id LONG, html STRING").coalesce(1).write.mode("append").parquet(source)
        live = read_page_stream(spark, source, "page_id LONG, html STRING")
        stream_unique(live, sink, str(tmp_path / "cp")).awaitTermination(240)
    assert sorted(r.page_id for r in spark.read.parquet(sink).collect()) == [1, 3, 4, 5, 6, 9]
