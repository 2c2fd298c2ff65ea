"""WARC writing and reading as a table of chunks (operator 6).

A record is one or more rows ``record_id, chunk_no, value``.  A payload over
``CHUNK`` characters is cut into WARC segments: the first row is the record,
the others are ``continuation`` records.  Rows are written by Spark's text
writer with the record terminator as line separator, so each file is a plain
WARC file (gzip as a whole) in whatever store Spark writes to.

Reading streams the rows of a file through one parser per task, which knows
only lengths: it holds a header or a piece of a block, never a whole record, and
carries the digest of a segmented payload from chunk to chunk.

Which record of equal payloads is the response is settled beforehand on digests
and lengths alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewinnow.llm.shared import shared_folder, ship, slices, table

ship(__name__)

CHUNK = 256 * 1024
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(r"[\x00-\x20\x7f]")
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
SLICE = 8 << 20


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def header(fields: list[tuple[str, str | int | None]]) -> str:
    return "WARC/1.1\r\n" + "\r\n".join(f"{k}: {v}" for k, v in fields if v is not None) + "\r\n\r\n"


def record_rows(page_id: int | None, url: str | None, html: str, refers_to: int | None, first: bool, chunk: int) -> Iterator[tuple[str, int, str]]:
    """Rows of one page: a response with its continuations, or a revisit."""
    digest, size = hashlib.sha1(), 0
    for i in range(0, len(html), chunk):
        piece = html[i : i + chunk].encode()
        digest.update(piece)
        size += len(piece)
    name = base32(digest.digest())
    own = record_id(page_id, name)
    uri = CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    common = [("WARC-Target-URI", uri), ("WARC-Date", DATE), ("X-Page-Id", page_id)]
    if not first:
        fields = [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", own),
            *common,
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to, name)),
            ("X-Refers-To-Page", refers_to),
            ("WARC-Payload-Digest", f"sha1:{name}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(http)),
        ]
        yield own, 1, header(fields) + http
        return
    cut = len(html) > chunk
    for number, i in enumerate(range(0, max(len(html), 1), chunk), 1):
        piece = html[i : i + chunk]
        block = (http if number == 1 else "") + piece
        last = i + chunk >= len(html)
        fields = [
            ("WARC-Type", "response" if number == 1 else "continuation"),
            ("WARC-Record-ID", own if number == 1 else record_id(page_id, f"{name}:{number}")),
            *common,
            ("WARC-Segment-Number", number if cut else None),
            ("WARC-Segment-Origin-ID", own if number > 1 else None),
            ("WARC-Segment-Total-Length", len(http) + size if cut and last else None),
            ("WARC-Payload-Digest", f"sha1:{name}" if number == 1 else None),
            ("Content-Type", "application/http; msgtype=response" if number == 1 else None),
            ("Content-Length", len(block.encode())),
        ]
        yield own, number, header(fields) + block


def roles(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id, url, html, refers_to, first``; a page of the largest id among equal payloads is first."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html"))
    same = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size")
    same = same.agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(same, ["digest", "size"], "left")
    first = F.col("largest").isNull() | F.coalesce(F.col("page_id") == F.col("largest"), F.lit(False))
    return rows.select("page_id", "url", "html", F.when(~first, F.col("largest")).alias("refers_to"), first.alias("first"))


def chunk_table(pages: DataFrame, least_bytes: int = LEAST_BYTES, chunk: int = CHUNK) -> DataFrame:
    """``record_id, chunk_no, value`` of all records; the chunks of a record follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html", SLICE):
                rows, size = [], 0
                for page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for row in record_rows(*page, chunk):
                        rows.append(row)
                        size += len(row[2])
                        if size > SLICE:
                            yield of(rows)
                            rows, size = [], 0
                if rows:
                    yield of(rows)

    def of(rows: list) -> pa.RecordBatch:
        a, b, c = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int32()), pa.array(c)], ["record_id", "chunk_no", "value"])

    return roles(pages, least_bytes).mapInArrow(run, "record_id string, chunk_no int, value string")


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, chunk: int = CHUNK) -> None:
    """WARC files under ``path``, one per task, gzip."""
    values = chunk_table(pages, least_bytes, chunk).select("value")
    values.write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


class Parser:
    """Records of a byte stream, fed piece by piece."""

    def __init__(self):
        self.buffer = bytearray()
        self.left = -1  # bytes of the current block still to come; -1: in a header
        self.head = False  # inside the HTTP header of the block
        self.fields: dict[str, str] = {}
        self.record: dict | None = None
        self.trailer = 0

    def feed(self, piece: bytes) -> Iterator[tuple]:
        self.buffer += piece
        while True:
            if self.trailer:
                n = min(self.trailer, len(self.buffer))
                del self.buffer[:n]
                self.trailer -= n
                if self.trailer:
                    return
            if self.left < 0:
                at = self.buffer.find(END)
                if at < 0:
                    return
                if not at:  # after a file's last record, where its end and the terminator overlap
                    del self.buffer[:4]
                    continue
                self.begin(bytes(self.buffer[:at]).decode())
                del self.buffer[: at + 4]
            if self.head:
                at = self.buffer.find(END)
                if at < 0:
                    return
                self.record["size"] = int(re.search(rb"Content-Length: (\d+)", self.buffer[:at])[1])
                self.left -= at + 4
                del self.buffer[: at + 4]
                self.head = False
            n = min(self.left, len(self.buffer))
            self.record["digest"].update(memoryview(self.buffer)[:n].tobytes())
            self.record["seen"] += n
            self.left -= n
            del self.buffer[:n]
            if self.left:
                return
            self.left, self.trailer = -1, 4
            done = self.record
            if done["type"] == "revisit" or done["seen"] == done["size"]:
                yield self.finished(done)

    def begin(self, text: str) -> None:
        lines = text.split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
        f = self.fields = dict(x.split(": ", 1) for x in lines[1:])
        self.left = int(f["Content-Length"])
        if f["WARC-Type"] == "continuation":
            if f["WARC-Segment-Origin-ID"] != self.record["id"]:
                raise ValueError("a continuation does not follow its record")
            return
        self.head = True
        number = lambda k: int(f[k]) if k in f else None
        self.record = {
            "id": f["WARC-Record-ID"],
            "type": f["WARC-Type"],
            "page": number("X-Page-Id"),
            "refers": number("X-Refers-To-Page"),
            "named": f["WARC-Payload-Digest"].removeprefix("sha1:"),
            "digest": hashlib.sha1(),
            "seen": 0,
            "size": 0,
        }

    def finished(self, r: dict) -> tuple:
        if r["type"] == "response" and base32(r["digest"].digest()) != r["named"]:
            raise ValueError(f"the payload of {r['id']} has another digest than its header")
        return r["page"], r["size"], r["named"], r["type"], r["refers"]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record under ``path``.

    The files are gzip, which Spark doesn't split, so a file's rows reach one task in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file = Parser(), None
        for batch in batches:
            found = []
            values = batch.column(0).cast(pa.binary())
            for i, name in enumerate(batch.column(1).to_pylist()):
                if name != file:
                    parser, file = Parser(), name
                found += parser.feed(values[i].as_py() + END)
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    lines = spark.read.option("lineSep", END.decode()).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file")).mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the archives of ``pages(page_id, url, html)`` and reads them back.

    A null or empty html is an empty payload.  Of repeated rows (equal id and
    payload) all are responses if theirs is the largest id, else all revisit.
    Null ids count as smaller than all others, and are responses only where no
    equal payload has an id.  Other columns are ignored.  An empty table gives
    an empty result.  Control characters and blanks in urls are percent-encoded.
    """
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return read_archives(spark, path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


ORACLE = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS payload, SHA1(COALESCE(html, '')) AS digest FROM pages),
r AS (SELECT *, MAX(page_id) OVER (PARTITION BY payload) AS largest FROM p)
SELECT page_id, CAST(STRLEN(payload) AS BIGINT) AS payload_bytes,
  ARRAY_TO_STRING([SUBSTR('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || SUBSTR(digest, CAST(i // 8 * 10 + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - i % 8 * 5 AS BIGINT)) & 31 AS BIGINT) + 1, 1) FOR i IN RANGE(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM r"""
