"""Headline queries on one machine; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores.  Each query
writes its whole result to the no-op sink.  ``start_up`` is the session start
plus the first run of the extraction job, which pays for class loading and
compilation once; the timings per query come after it.
"""

from __future__ import annotations

import json
import os
import time

from pagewinnow.catalog.queries import REGISTERED
from pagewinnow.plans.extract import process
from pagewinnow.session import local_session
from pagewinnow.sources.pages import read_pages

HEADLINE = (
    "metadata_fields",
    "option_sweep",
    "dedup_blocks",
    "score_extraction",
    "duplicate_pages",
    "detect_language",
    "link_edges",
    "nesting_profile",
    "distribution",
    "measurement_summary",
    "stream_dedup",
)


def timed(job) -> float:
    started = time.perf_counter()
    job().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    started = time.perf_counter()
    spark = local_session(cores, shuffle_partitions=cores, app="pagewinnow-bench")
    pages = lambda: read_pages(spark, f"{folder}/pages.parquet", min_partitions=cores)
    n_pages = pages().count()
    timed(lambda: process(pages()))
    start_up = round(time.perf_counter() - started, 3)
    many = lambda: (  # noqa: E731  eight times the pages, for the cost of one more page
        pages().selectExpr("*", "explode(sequence(0, 7)) AS copy").selectExpr("page_id * 8 + copy AS page_id", "url", "html")
    )
    runs = {
        "extract": lambda: process(pages()),
        "extract_8x": lambda: process(many()),
        "extract_with_fallback": lambda: process(pages(), enable_fallback=True),
        "extract_deduplicated": lambda: process(pages(), deduplicate=True),
        **{name: (lambda name=name: REGISTERED[name](spark, folder)) for name in HEADLINE},
    }
    times = {name: timed(job) for name, job in runs.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
                "pages": n_pages,
                "pages_per_sec_extract": round(n_pages / times["extract"], 1),
                "marginal_pages_per_sec_extract": round(7 * n_pages / max(times["extract_8x"] - times["extract"], 0.001), 1),
                "start_up": start_up,
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
