"""Registered queries: every operator over the whole of its input tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewinnow.catalog import fixtures as X
from pagewinnow.operators import assemble as A
from pagewinnow.operators import blocks as B
from pagewinnow.operators import compare as C
from pagewinnow.operators import intake, language, ledger, links, markup, metadata, profiles, repeats, scoring
from pagewinnow.functions.urls import host_of
from pagewinnow.options import ExtractOptions, SweptOptions
from pagewinnow.plans import extract as E
from pagewinnow.plans.sweep import option_sweep, process_sweep
from pagewinnow.sources.pages import read_page_tree, read_pages
from pagewinnow.session import shared_folder
from pagewinnow.sources.sinks import append_run, read_accepted, read_refused, run_record, split_sinks
from pagewinnow.streaming.jobs import PAGE_SCHEMA, read_tally, stream_dedup, stream_extract, stream_tally, stream_tally_sink, stream_unique

DEFAULTS = ExtractOptions()
SIZE_CAP = 2600
PROFILED = ("de", "en", "es", "fr")
PRUNED = ".ad, h1, a"
DATE_OVERRIDE = dt.date(2001, 2, 3)
MAX_BLOCK_PAGES = 5
REGION_FLAGS = [f"in_{r}" for r in markup.FLAGS]
FOCUS_SWEEP = [ExtractOptions(focus=f) for f in B.THRESHOLDS]
CALLS = ("default", "fallback")
LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
OPTION_SETS = [
    DEFAULTS,
    ExtractOptions(focus="favor_recall"),
    ExtractOptions(focus="favor_precision"),
    ExtractOptions(exclude_comments=True),
    ExtractOptions(exclude_tables=True),
    ExtractOptions(include_links=True),
    ExtractOptions(include_images=True),
]
Query = Callable[[SparkSession, str], DataFrame]


def read_pages_q(spark, d):
    return read_pages(spark, f"{d}/pages.parquet").selectExpr(
        "page_id", "url", "cast(octet_length(html) AS bigint) AS n_bytes"
    )


def size_gate(spark, d):
    return intake.size_gate(X.pages(spark, d), SIZE_CAP).select("page_id", "n_bytes", "too_large")


def utf8_gate(spark, d):
    return intake.utf8_gate(X.raw_pages(spark, d)).select("page_id", "bad_offset")


def encoding_profile(spark, d):
    return intake.encoding_profile(X.odd_pages(spark, d))


def lossy_decode(spark, d):
    return intake.lossy_decode(X.raw_pages(spark, d)).select(
        "page_id", "lossy", F.sha2("html", 256).alias("digest")
    )


def strip_bom(spark, d):
    return intake.strip_bom(X.marked_pages(spark, d)).select(
        "page_id", F.sha2("html", 256).alias("digest")
    )


def markup_tokens(spark, d):
    return markup.markup_tokens(X.pages(spark, d)).select(
        "page_id", "pos", "token", "is_tag", "closing", "tag"
    )


def region_state(spark, d):
    rows = markup.region_state(markup.markup_tokens(X.injected(spark, d)))
    return rows.select("page_id", "pos", "tag", *REGION_FLAGS)


def block_tokens(spark, d):
    return markup.block_tokens(X.pages(spark, d)).select(
        "page_id", "pos", "closing", "tag", "css_class", "body"
    )


def _blocks(pages: DataFrame, options: ExtractOptions = DEFAULTS, carry=()) -> DataFrame:
    return E.content_blocks(pages, options, carry)


def blocks(spark, d):
    rows = _blocks(X.injected(spark, d)).where("n_chars > 0")
    return rows.select("page_id", "block_no", "tag", "text", *REGION_FLAGS)


def block_features(spark, d):
    rows = B.block_features(_blocks(X.injected(spark, d))).where("n_chars > 0")
    return rows.selectExpr(
        "page_id", "block_no", "n_chars", "link_chars", "n_words", "n_stop",
        "round(link_density, 6) AS link_density", "round(stop_density, 6) AS stop_density",
    )


def _labelled_by_focus(rows: DataFrame, name: str = "focus") -> DataFrame:
    """Statistical labels of one set of features under all three focus levels."""
    levels = ", ".join(f"'{f}'" for f in B.THRESHOLDS)
    each = rows.selectExpr("*", f"explode(array({levels})) AS {name}")
    return B.classify_blocks(each.selectExpr("*", f"struct({name} AS focus) AS opt"), SweptOptions())


def classify_blocks(spark, d):
    rows = _labelled_by_focus(B.block_features(_blocks(X.injected(spark, d))))
    return rows.where("n_chars > 0").select("focus", "page_id", "block_no", "label")


def smooth_blocks(spark, d):
    rows = _labelled_by_focus(B.block_features(_blocks(X.injected(spark, d))))
    kept = B.smooth_blocks(rows, ("focus", "page_id"))
    return kept.where("n_chars > 0").select("focus", "page_id", "block_no", "label", "keep")


def prune_blocks(spark, d):
    rows = B.blocks(markup.page_blocks(X.pages(spark, d), PRUNED)).where("n_chars > 0")
    return rows.select("page_id", "block_no", "tag", "text")


def _streams(pages: DataFrame, **options) -> DataFrame:
    return E.process(pages, **options).select("page_id", *A.STREAMS)


def exclude_tables(spark, d):
    return _streams(X.injected(spark, d), exclude_tables=True).select("page_id", "content_text")


def split_comments(spark, d):
    return _streams(X.injected(spark, d)).select("page_id", "comments_text", "comments_html")


def exclude_comments(spark, d):
    return _streams(X.injected(spark, d), exclude_comments=True).select("page_id", "comments_text")


def rescue_short_pages(spark, d):
    rows = A.label_passes(_blocks(X.injected(spark, d)), DEFAULTS)
    done = A.assemble(rows, DEFAULTS, min_chars=1500)
    return done.select("page_id", "rescued", "content_text", "content_html")


def fallback_select(spark, d):
    options = ExtractOptions(enable_fallback=True)
    rows = A.label_passes(_blocks(X.unstructured(spark, d), options), options)
    return A.assemble(rows, options).select("page_id", "chosen", "rescued", "content_text")


def nested_containers(spark, d):
    rows = _blocks(X.wrapped(spark, d)).where("n_chars > 0")
    return rows.select("page_id", "block_no", "in_content", "in_chrome", "in_furniture")


def wrapped_pages(spark, d):
    rows = A.label_passes(_blocks(X.wrapped(spark, d)), DEFAULTS)
    return A.assemble(rows, DEFAULTS).select("page_id", "rescued", "content_text", "content_html")


def assemble(spark, d):
    return _streams(X.injected(spark, d)).select("page_id", "content_text", "content_html")


def keep_links_and_images(spark, d):
    return _streams(X.injected(spark, d), include_links=True, include_images=True).select(
        "page_id", "content_html"
    )


def _based_blocks(pages: DataFrame) -> DataFrame:
    """Blocks with the page URL on every row, for links and images."""
    carried = pages.withColumn("base", F.col("url"))
    rows = _blocks(carried, carry=("base",))
    base = "first(base, true) OVER (PARTITION BY page_id ORDER BY block_no ROWS UNBOUNDED PRECEDING)"
    return rows.withColumn("base", F.expr(base))


def link_edges(spark, d):
    return links.link_edges(_based_blocks(X.injected(spark, d)))


def host_degrees(spark, d):
    kept = _based_blocks(X.injected(spark, d)).where(B.structural_label(DEFAULTS))
    return links.host_degrees(links.link_edges(kept))


def _kept_images(spark, d) -> DataFrame:
    options = ExtractOptions(include_images=True)
    kept = _based_blocks(X.injected(spark, d)).where(B.structural_label(options))
    return links.image_rows(kept)


def image_rows(spark, d):
    return _kept_images(spark, d)


def image_inventory(spark, d):
    meta = metadata.metadata_fields(X.injected(spark, d), DEFAULTS)
    return links.image_inventory(_kept_images(spark, d), meta)


def _hosted_blocks(spark, d) -> DataFrame:
    rows = _based_blocks(X.pages(spark, d)).where("n_chars > 0")
    return rows.selectExpr("page_id", "block_no", f"{host_of('base')} AS host", "text")


def dedup_blocks(spark, d):
    kept = repeats.dedup_blocks(_hosted_blocks(spark, d), MAX_BLOCK_PAGES)
    return kept.select("page_id", "block_no", "text")


def dedup_blocks_by_host(spark, d):
    kept = repeats.dedup_blocks(_hosted_blocks(spark, d), 1, by_host=True)
    return kept.select("page_id", "block_no", "text")


def _bodies(spark, d) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.selectExpr("doc_id AS page_id", "lang AS declared", "text AS content_text")


def duplicate_pages(spark, d):
    return repeats.duplicate_pages(_bodies(spark, d)).selectExpr(
        "page_id", "first_page", "coalesce(first_page < page_id, false) AS is_duplicate"
    )


def meta_pairs(spark, d):
    return metadata.meta_pairs(X.injected(spark, d))


def jsonld_fields(spark, d):
    return metadata.jsonld_fields(X.injected(spark, d))


def metadata_fields(spark, d):
    return E.flat_metadata(metadata.metadata_fields(X.injected(spark, d), DEFAULTS))


def null_if_empty(spark, d):
    """Absent values in all their spellings, worked over the whole page table."""
    spelled = X.pages(spark, d).selectExpr(
        "page_id",
        "CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN NULL ELSE concat(' ', url) END AS author",
        "CASE WHEN page_id % 2 = 0 THEN array(url) END AS tags",
    )
    return metadata.null_if_empty(spelled, ("author",), ("tags",)).selectExpr(
        "page_id", "author", "size(tags) AS n_tags"
    )


def resolve_url(spark, d):
    return metadata_fields(spark, d).select("page_id", "url", "hostname", "image")


def publication_date(spark, d):
    return metadata_fields(spark, d).select("page_id", "date")


def date_override(spark, d):
    options = ExtractOptions(html_date_override=DATE_OVERRIDE)
    meta = metadata.metadata_fields(X.injected(spark, d), options)
    return meta.select("page_id", "metadata.date", "metadata.title")


def exclude_authors(spark, d):
    options = ExtractOptions(excluded_authors=("MARY somerville",))
    meta = metadata.metadata_fields(X.injected(spark, d), options)
    return meta.select("page_id", "metadata.author")


def tag_terms(spark, d):
    return metadata.tag_terms(metadata.metadata_fields(X.injected(spark, d), DEFAULTS))


def detect_language(spark, d):
    return language.detect_language(_bodies(spark, d), "content_text").select(
        "page_id", "declared", "detected"
    )


def _documents(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang")


def language_profiles(spark, d):
    return language.language_profiles(_documents(spark, d).where("doc_id % 2 = 0"))


def detect_by_profiles(spark, d):
    return language.detect_by_profiles(_documents(spark, d), language_profiles(spark, d), PROFILED)


def profile_agreement(spark, d):
    """Of the texts that no profile was learned from: named language against the detected one."""
    named = _documents(spark, d).where("doc_id % 2 <> 0")
    found = language.detect_by_profiles(named, language_profiles(spark, d), PROFILED)
    return found.join(named.select("doc_id", "lang"), "doc_id").groupBy("lang", "detected").agg(F.count("*").alias("texts"))


def language_gate(spark, d):
    docs = language.detect_language(_bodies(spark, d), "content_text").withColumn(
        "declared", F.expr("CASE WHEN page_id % 2 = 0 THEN declared END")
    )
    return language.language_gate(docs, "en").select("page_id", "refused", "detail")


def essential_metadata_gate(spark, d):
    pages = X.injected(spark, d).withColumn("url", F.lit(None).cast("string"))
    meta = metadata.metadata_fields(pages, DEFAULTS)
    return meta.selectExpr("page_id", f"{metadata.missing_essential('metadata')} AS missing")


def metadata_coverage(spark, d):
    meta = metadata.metadata_fields(X.injected(spark, d), DEFAULTS)
    return metadata.metadata_coverage(meta).selectExpr(
        "host", "field", "pages", "filled", "round(fill_rate, 6) AS fill_rate"
    )


def _strict_ledger(spark, d) -> DataFrame:
    """Every reason but the language ones at once, on damaged and small pages."""
    pages = X.injected(spark, d).withColumn(
        "html",
        F.expr(
            "CASE WHEN page_id % 10 = 3 THEN concat(cast(substr(html, 1, 10) AS binary), "
            f"{X.BAD_BYTE}, cast(substr(html, 11) AS binary)) "
            "WHEN page_id % 11 = 4 THEN cast('<html><head><title>Stub</title>"
            '<meta name="date" content="2020-01-01"></head></html>\' AS binary) '
            "WHEN page_id % 13 = 5 THEN cast('<html lang=\"en\"><head><title>Copy</title>"
            '<meta name="date" content="2020-01-01"></head><body><p>The same body.</p></body></html>\' AS binary) '
            "ELSE cast(html AS binary) END"
        ),
    )
    return E.ledger(
        pages, max_input_bytes=9000, has_essential_metadata=True, deduplicate=True, target_language="en"
    )


def outcome_ledger(spark, d):
    return _strict_ledger(spark, d)


def outcome_tally(spark, d):
    return ledger.outcome_tally(_strict_ledger(spark, d).selectExpr("outcome", f"{host_of('url')} AS host"))


def lossy_tally(spark, d):
    """Outcomes of pages decoded with losses where they must be, and how many those are."""
    decoded = intake.lossy_decode(X.raw_pages(spark, d))
    outcomes = E.ledger(decoded.drop("lossy")).select("page_id", "outcome")
    marked = decoded.selectExpr("page_id", f"{host_of('url')} AS host", "lossy")
    return ledger.outcome_tally(outcomes.join(marked, "page_id"), "lossy")


def _stored_sweep(spark, pages: DataFrame, sets: list[ExtractOptions], name: str) -> list[DataFrame]:
    """What ``process`` gives for each option set, worked out in one pass and stored once."""
    path = f"{_fresh(spark, name)}/swept"
    process_sweep(pages, sets).write.parquet(path)
    swept = spark.read.parquet(path)
    return [swept.where(F.col("option_id") == i).drop("option_id") for i in range(len(sets))]


def _snapshots(spark, d) -> list[DataFrame]:
    sets = [DEFAULTS, ExtractOptions(focus="favor_precision", max_input_bytes=20000)]
    return _stored_sweep(spark, X.injected(spark, d), sets, "compared")


def snapshot_diff(spark, d):
    return C.snapshot_diff(*_snapshots(spark, d))


def _stored_snapshots(spark, d) -> tuple[DataFrame, DataFrame]:
    """Results as two runs would have stored them, the second with edits."""
    folder = _fresh(spark, "snapshots")
    E.process(X.injected(spark, d)).write.parquet(f"{folder}/a")
    X.edited(spark.read.parquet(f"{folder}/a")).write.parquet(f"{folder}/b")
    return spark.read.parquet(f"{folder}/a"), spark.read.parquet(f"{folder}/b")


def changed_lines(spark, d):
    return C.changed_lines(*_stored_snapshots(spark, d))


def renamed_pages(spark, d):
    return C.renamed_pages(*_stored_snapshots(spark, d))


def diff_verdict(spark, d):
    return C.diff_verdict(*_snapshots(spark, d), "balanced", "precision")


def dump_manifest(spark, d):
    return C.dump_manifest(E.process(X.injected(spark, d)))


def _statistical_runs(spark, d) -> DataFrame:
    """Container-blind content per focus and page, repeated blocks removed."""
    rows = B.block_features(_based_blocks(X.pages(spark, d)))
    hosted = rows.withColumn("host", F.expr(host_of("base")))
    unique = repeats.dedup_blocks(hosted, MAX_BLOCK_PAGES)
    # labels of all focuses side by side, so a block is sorted and collected once
    labels = {f: f"label_{f}" for f in B.THRESHOLDS}
    labelled = unique.selectExpr("page_id", "block_no", "text", *[f"{B.statistical_label(ExtractOptions(focus=f))} AS {x}" for f, x in labels.items()])
    smooth = B.smooth_blocks(labelled, labels=list(labels.values()))
    kept = smooth.where(" OR ".join(f"keep_{f}" for f in labels)).groupBy("page_id").agg(
        F.expr(f"array_sort(collect_list(struct(block_no, text, {', '.join(f'keep_{f}' for f in labels)}))) AS _kept")
    )
    of_runs = ", ".join(f"struct('{f}' AS run, transform(filter(_kept, b -> b.keep_{f}), b -> b.text) AS texts)" for f in labels)
    runs = kept.selectExpr("page_id", f"inline(filter(array({of_runs}), r -> size(r.texts) > 0))")
    return runs.selectExpr("run", "page_id", "array_join(texts, '\\n') AS content_text")


def _runs(spark, d) -> DataFrame:
    """``run, page_id, content_text``: the default call, the one with fallback, the container-blind ones."""
    swept = option_sweep(X.pages(spark, d), [DEFAULTS, ExtractOptions(enable_fallback=True)])
    calls = swept.selectExpr(f"element_at(array({', '.join(map(repr, CALLS))}), option_id + 1) AS run", "page_id", "content_text")
    return calls.unionByName(_statistical_runs(spark, d))


def _scores(spark, d) -> DataFrame:
    return scoring.score_extraction(_runs(spark, d), X.truth(spark, d), [*CALLS, *B.THRESHOLDS])


def score_extraction(spark, d):
    rates = [f"round({c}, 6) AS {c}" for c in ("precision", "recall", "accuracy", "f_score")]
    return _scores(spark, d).selectExpr("run", "tp", "fn", "fp", "tn", *rates)


def fscore_tripwire(spark, d):
    return scoring.fscore_tripwire(_scores(spark, d), "default").selectExpr(
        "run", "round(f_score, 6) AS f_score", "status"
    )


def score_dates(spark, d):
    meta = metadata.metadata_fields(X.injected(spark, d), DEFAULTS)
    truth = X.pages(spark, d).selectExpr(
        "page_id", "CASE WHEN page_id % 6 IN (0, 4) THEN date'2020-03-09' ELSE date'2020-01-21' END AS date"
    )
    return scoring.score_dates(meta, truth).selectExpr(
        "correct", "wrong", "missing", "round(precision_when_answered, 6) AS precision_when_answered"
    )


def paired_agreement(spark, d):
    return scoring.paired_agreement(_runs(spark, d), X.truth(spark, d), "default", "favor_recall")


def stream_overlap(spark, d):
    return profiles.stream_overlap(_streams(X.injected(spark, d))).selectExpr("page_id", "shared_lines")


def distribution(spark, d):
    sized = X.pages(spark, d).selectExpr("octet_length(html) AS n_bytes")
    return _rounded(profiles.distribution(sized, "n_bytes", 5000))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def nesting_profile(spark, d):
    return _rounded(profiles.nesting_profile(X.pages(spark, d)))


def determinism_check(spark, d):
    columns = ["page_id", *A.STREAMS, "outcome", "reason"]
    pages = X.injected(spark, d)
    # each run is worked out once and read by all checks
    folder = _fresh(spark, "determinism")
    E.process(pages).select(columns).write.parquet(f"{folder}/first")
    E.process(pages.repartition("url")).select(columns).write.parquet(f"{folder}/second")
    first, second = (spark.read.parquet(f"{folder}/{name}") for name in ("first", "second"))
    changed = second.withColumn("content_text", F.expr("CASE WHEN page_id = 7 THEN 'other' ELSE content_text END"))
    runs = {"shuffled": second, "changed": changed, "longer": second.unionByName(second.where("page_id = 7"))}
    checks = [
        C.determinism_check(first, other, columns).withColumn("against", F.lit(name)) for name, other in runs.items()
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


def measurement_summary(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").select("event_type", "value")
    return profiles.measurement_summary(events, "event_type", "value")


def option_sweep_q(spark, d):
    swept = option_sweep(X.injected(spark, d), OPTION_SETS)
    return swept.selectExpr(
        "option_id", "page_id", *[f"sha2({s}, 256) AS {s}" for s in A.STREAMS]
    )


def run_record_q(spark, d):
    # the runs that are compared and those that are scored come from one sweep
    sets = [DEFAULTS, ExtractOptions(focus="favor_precision"), ExtractOptions(enable_fallback=True)]
    balanced, precise, fallback = _stored_sweep(spark, X.pages(spark, d), sets, "recorded")
    verdict = C.diff_verdict(balanced, precise, "a", "b")
    calls = [run.selectExpr(f"'{name}' AS run", "page_id", "content_text") for name, run in zip(CALLS, (balanced, fallback), strict=True)]
    runs = calls[0].unionByName(calls[1]).unionByName(_statistical_runs(spark, d))
    scores = scoring.score_extraction(runs, X.truth(spark, d), [*CALLS, *B.THRESHOLDS])
    return _rounded(run_record(spark, verdict, scores, dt.date(2024, 1, 1), "corpus-1", "default"))


def run_log(spark, d):
    """Records of two runs, appended to one table and read back."""
    path, record = f"{_fresh(spark, 'runs')}/log", run_record_q(spark, d)
    append_run(record, path)
    # the record of a later run of the same pages
    append_run(spark.read.parquet(path).withColumn("run_date", F.expr("date_add(run_date, 1)")).coalesce(1), path)
    return spark.read.parquet(path)


def _live(spark, d, table: str, schema: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of them."""
    # a stream begins at a folder or a pattern, so the name of the table is written as one
    return spark.readStream.schema(schema).parquet(f"{d}/[{table[0]}]{table[1:]}.parquet")


def _drained(spark, live: DataFrame, name: str, mode: str) -> DataFrame:
    """What a stream gives until it is drained; the last complete result, or all appended rows."""
    sink = _fresh(spark, name)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink if mode == "complete" else f"{sink}/batch_id={batch_id}")

    query = (
        live.writeStream.foreachBatch(one_batch)
        .outputMode(mode)
        .option("checkpointLocation", f"{sink}-state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(live.schema).parquet(sink).select(*live.columns)


def stream_tally_q(spark, d):
    live = X.with_time(_live(spark, d, "pages", PAGE_SCHEMA))
    return _drained(spark, stream_tally(live, max_input_bytes=SIZE_CAP), "tally", "complete")


def _in_batches(spark, parts: list[DataFrame], name: str, start) -> None:
    """Each part is added to a growing source, whose new files a stream then takes up as one batch."""
    source = _fresh(spark, name)
    for part in parts:
        part.write.mode("append").parquet(source)
        start(spark.readStream.schema(part.schema).parquet(source)).awaitTermination()


def stream_late_q(spark, d):
    """Three batches, some rows of which come after their windows have closed."""
    sink = _fresh(spark, "late")
    parts = [p.withColumn("ingest_ts", F.expr(X.LATE_TIME)) for p in X.batches(X.pages(spark, d))]
    start = lambda live: stream_tally_sink(live, sink, f"{sink}-state", late="2 minutes", max_input_bytes=SIZE_CAP)
    _in_batches(spark, parts, "late-source", start)
    return read_tally(spark, sink, "2 minutes")


def stream_extract_copies_q(spark, d):
    """Three batches; the last one brings copies of the others' pages."""
    sink = _fresh(spark, "copies")
    pages = X.pages(spark, d)
    first, second, third = X.batches(pages)
    parts = [first, second, third.unionByName(first.unionByName(second).withColumn("page_id", F.col("page_id") + 1_000_000))]
    _in_batches(spark, parts, "copies-source", lambda live: stream_extract(live, sink, f"{sink}-state", deduplicate=True))
    return spark.read.parquet(sink).select("page_id", "outcome", "reason")


def stream_unique_q(spark, d):
    """Documents in three batches; of each body the first one stays."""
    sink = _fresh(spark, "unique")
    docs = spark.read.parquet(f"{d}/documents.parquet").selectExpr("doc_id AS page_id", "text AS html")
    _in_batches(spark, X.batches(docs), "unique-source", lambda live: stream_unique(live, sink, f"{sink}-state"))
    return spark.read.parquet(sink).select("page_id")


def read_page_tree_q(spark, d):
    """The pages as files, a folder each, read back by path."""
    root = _fresh(spark, "tree")
    rows = X.pages(spark, d).where("page_id IS NOT NULL").select("page_id", "html")
    # tasks put their own files in place; else the driver would move a folder for every page, one by one
    writer = rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    # on a local disk a page's file needs no second one with its checksums
    for name, value in LOCAL_FILES.items():
        writer = writer.option(name, value)
    writer.partitionBy("page_id").text(root)
    tree = read_page_tree(spark, root, "*.txt")
    own = "cast(regexp_extract(path, 'page_id=([0-9]+)', 1) AS bigint) AS file_id"
    return tree.selectExpr("page_id", own, "sha2(regexp_replace(cast(html AS string), '\\\\n$', ''), 256) AS digest")


def stream_dedup_q(spark, d):
    live = _live(spark, d, "documents", "doc_id BIGINT, text STRING").selectExpr("doc_id AS page_id", "text AS html")
    timed = live.selectExpr("*", f"{X.STREAM_TIME} AS ingest_ts")
    found = stream_dedup(timed, late="1000 hours").selectExpr("lower(hex(body_sha)) AS body")
    return _drained(spark, found, "dedup", "append")


def _fresh(spark, name: str) -> str:
    return f"{shared_folder(spark)}/pagewinnow-{name}-{uuid.uuid4().hex}"


def split_sinks_q(spark, d):
    """Both sinks written in one pass and read back."""
    path = _fresh(spark, "sinks")
    split_sinks(E.process(X.injected(spark, d), max_input_bytes=SIZE_CAP), path)
    kept = read_accepted(spark, path).selectExpr("page_id", "'accepted' AS sink", "cast(NULL AS string) AS reason")
    refused = read_refused(spark, path).selectExpr("page_id", "'refused' AS sink", "reason")
    return kept.unionByName(refused)


def stream_extract_q(spark, d):
    """The page table as a stream, drained into a sink and read back."""
    sink = _fresh(spark, "stream")
    query = stream_extract(_live(spark, d, "pages", PAGE_SCHEMA), sink, f"{sink}-state", max_input_bytes=SIZE_CAP)
    query.awaitTermination()
    return spark.read.parquet(sink).select("page_id", "outcome", "reason", "content_text")


def extracted(spark, d):
    done = E.extract(X.injected(spark, d))
    return E.flat_metadata(done, A.STREAMS)


REGISTERED: dict[str, Query] = {
    "read_pages": read_pages_q,
    "option_sweep": option_sweep_q,
    "run_record": run_record_q,
    "split_sinks": split_sinks_q,
    "stream_extract": stream_extract_q,
    "stream_tally": stream_tally_q,
    "stream_late": stream_late_q,
    "stream_extract_copies": stream_extract_copies_q,
    "stream_unique": stream_unique_q,
    "read_page_tree": read_page_tree_q,
    "stream_dedup": stream_dedup_q,
    **{
        f.__name__: f
        for f in (
            size_gate, utf8_gate, encoding_profile, lossy_decode, strip_bom, markup_tokens,
            region_state, block_tokens, blocks, block_features, classify_blocks, smooth_blocks,
            prune_blocks, exclude_tables, split_comments, exclude_comments, rescue_short_pages,
            fallback_select, nested_containers, wrapped_pages, assemble, keep_links_and_images, link_edges, host_degrees, image_rows,
            image_inventory, dedup_blocks, dedup_blocks_by_host, duplicate_pages, meta_pairs,
            jsonld_fields, metadata_fields, null_if_empty, resolve_url, publication_date, date_override,
            exclude_authors, tag_terms, detect_language, language_profiles, detect_by_profiles, profile_agreement,
            language_gate, essential_metadata_gate, changed_lines, renamed_pages, lossy_tally, run_log,
            metadata_coverage, outcome_ledger, outcome_tally, snapshot_diff, diff_verdict,
            dump_manifest, score_extraction, fscore_tripwire, score_dates, paired_agreement,
            stream_overlap, distribution, nesting_profile, determinism_check, measurement_summary,
            extracted,
        )
    },
}
