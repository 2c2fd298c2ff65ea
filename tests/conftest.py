import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pagewinnow.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"

PARAGRAPHS = (
    "<p>Opening paragraph of the story, written at enough length that no reader would take it "
    "for a caption, a label or any other small part of a page around it.</p>"
    "<p>Closing paragraph of the story, which adds what is needed for the whole to be well over "
    "the length below which a rescue pass would have a second look at the page.</p>"
)


def page(body: str, head: str = "", lang: str = ' lang="en"') -> str:
    return (
        f"<!DOCTYPE html><html{lang}><head><title>A small story</title>{head}</head>"
        f"<body>{body}</body></html>"
    )


def article(extra: str = "", head: str = "") -> str:
    return page(f"<article>{PARAGRAPHS}{extra}</article>", head)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, "pagewinnow-tests")
    session.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1m")
    return session


@pytest.fixture(scope="session")
def pages_of(spark):
    def build(*documents, urls=None):
        rows = [(i, (urls or {}).get(i), d) for i, d in enumerate(documents)]
        return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")

    return build


def by_page(df):
    return {r["page_id"]: r for r in df.collect()}
