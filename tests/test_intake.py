import pytest
from pyspark.sql import functions as F

from pagewinnow import UNLIMITED
from pagewinnow.operators import intake
from pagewinnow.plans.extract import ledger, process
from tests.conftest import article, by_page

PREFIX = b"<html><body><p>"
DAMAGED = [
    (0, b"plain", None),
    (1, PREFIX + b"\x93smart\x94</p>", 15),
    (2, PREFIX + "é".encode()[:1], 15),
    (3, PREFIX + "日".encode()[:2], 15),
    (4, PREFIX + "😀".encode()[:3], 15),
    (5, b"\xff\xfe<\x00p\x00", 0),
    (6, b"\xfe\xff\x00<", 0),
    (7, "a�b".encode() + b"\x93", 5),
    (8, b"\xc0\xaf", 0),
    (9, "ok é 日".encode(), None),
    (10, b"\x93", 0),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(i, f"http://h{i % 2}.example.org/", bytearray(b)) for i, b, _ in DAMAGED]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html BINARY")


def test_offset_of_the_first_bad_byte(raw):
    found = {r.page_id: r.bad_offset for r in intake.utf8_gate(raw).collect()}
    assert found == {i: offset for i, _, offset in DAMAGED}


def test_lossy_decode_keeps_every_page(raw):
    rows = by_page(intake.lossy_decode(raw))
    assert {i for i, r in rows.items() if r.lossy} == {i for i, _, o in DAMAGED if o is not None}
    assert "�" in rows[1].html and rows[9].html == "ok é 日"


def test_size_is_bytes_and_the_cap_itself_passes(pages_of):
    text = "é" * 10
    pages = pages_of(text)
    at = intake.size_gate(pages, 20).first()
    assert (at.n_bytes, at.too_large) == (20, False)
    assert intake.size_gate(pages, 19).first().too_large
    assert not intake.size_gate(pages, None).first().too_large


def test_byte_order_mark_never_reaches_the_text(pages_of):
    marked = process(pages_of("﻿" + article())).first()
    assert "﻿" not in marked.content_text and marked.outcome == "ok"
    assert intake.strip_bom(pages_of("﻿x")).first().html == "x"


def test_profile_sees_what_the_gate_lets_through(spark):
    rows = [
        (0, "http://a.example/", bytearray("<html>".encode("utf-16-le"))),
        (1, "http://a.example/", bytearray(b"\xef\xbb\xbf<html></html>")),
        (2, "http://a.example/", bytearray(b"\xff\xfe<\x00")),
        (3, "http://b.example/", bytearray(b"<html></HTML>")),
    ]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html BINARY")
    found = {r.host: r.asDict() for r in intake.encoding_profile(pages).collect()}
    assert found["a.example"] == {
        "host": "a.example", "pages": 3, "not_utf8": 1, "utf8_bom": 1, "utf16_bom": 1, "has_nul": 2, "unclosed": 2,
    }
    assert found["b.example"]["unclosed"] == 0


def test_gate_order_and_ledger_closure(spark, raw):
    big = bytearray(b"\x93" * 40)
    pages = raw.union(spark.createDataFrame([(99, None, big)], raw.schema))
    rows = by_page(ledger(pages, max_input_bytes=39))
    assert len(rows) == len(DAMAGED) + 1
    assert rows[99].reason == "input_too_large" and rows[99].reason_offset is None
    assert (rows[1].reason, rows[1].reason_offset) == ("invalid_utf8", 15)
    assert rows[0].outcome == "ok"
    free = by_page(ledger(pages, max_input_bytes=UNLIMITED))
    assert (free[99].reason, free[99].reason_offset) == ("invalid_utf8", 0)


def test_missing_document_is_a_refusal(spark):
    pages = spark.createDataFrame([(1, "http://x.org/", None)], "page_id BIGINT, url STRING, html STRING")
    row = process(pages).first()
    assert (row.outcome, row.reason, row.content_text) == ("refused", "insufficient_content", "")
    assert process(pages).where(F.col("metadata.url").isNull()).count() == 0
