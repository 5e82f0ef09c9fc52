import base64
import gzip
import hashlib

import pytest

from silofeed.llm import archives as A

SCHEMA = "page_id long, url string, html string, id string, digest string, payload string, type string"
HTML = [
    (1, "http://a.example/x y", "<p>one</p>"), (2, "http://b.example/", "<p>one</p>"), (3, None, None), (4, "http://c.example/", ""),
    (5, "http://d.example/", "line\r\n\r\nWARC/1.0\r\n\nfiledesc: not a record\n" * 50), (6, "http://e.example/", "ü" * 200_000),
    (None, "http://f.example/", "<p>one</p>"), (7, "http://g.example/", "line\r\n"), (7, "http://g.example/", "line\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*row, *["clash"] * 4) for row in HTML]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sha1(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, pages, version):
    arc = A.write_arc(pages, version=lambda task: version)
    records = A.read_arc(spark, arc).collect()
    assert sorted((r["page_id"] or 0, bytes(r["payload"]).decode()) for r in records) == sorted((i or 0, h or "") for i, _, h in HTML)
    found = A.resolved(A.read_warc(spark, A.convert(spark, arc))).collect()
    assert sorted((r["page_id"] or 0, r["payload_digest"], r["payload_length"]) for r in found) == sorted(
        (i or 0, sha1(h), len((h or "").encode())) for i, _, h in HTML)
    kinds = {(r["page_id"], r["type"], r["refers_to"]) for r in found if r["page_id"] != 7}
    assert kinds == {(1, "response", None), (2, "revisit", 1), (None, "revisit", 1), (3, "response", None), (4, "revisit", 3),
                     (5, "response", None), (6, "response", None)}
    assert sorted(r["type"] for r in found if r["page_id"] == 7) == ["response", "revisit"]
    assert all(r["payload"] is None for r in found if r["type"] == "revisit")
    assert {r["date"] for r in found} == {"2024-01-01T00:00:00Z"} and len({r["record_id"] for r in found}) == len(HTML)


def test_files_are_archives(spark, pages):
    warc = A.convert(spark, A.write_arc(pages))
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(warc).collect()
    text = b"".join(gzip.decompress(p["content"]) for p in parts)
    assert text.count(b"WARC-Type: response") == 5 and text.startswith(b"WARC/1.0\r\n") and text.endswith(b"\r\n\r\n")


def test_small_payloads_are_all_responses(spark, pages):
    found = A.read_warc(spark, A.convert(spark, A.write_arc(pages), least=1000)).collect()
    assert {r["type"] for r in found} == {"response"}


BLOCK = b"1 0 Somebody\nURL IP-address Archive-date Content-type Archive-length\nand more\n"
OLD = (
    b"filedesc://old.arc 0.0.0.0 19970101000000 text/plain %d\n%s\nhttp://x.example/ 1.2.3.4 19970203040506 text/html 27\n"
    b"HTTP/1.0 200 OK\n\n<b>old</b>\ndns:x.example 1.2.3.4 199702030405 text/dns 9\nx 1.2.3.4\n" % (len(BLOCK), BLOCK)
)


@pytest.mark.parametrize("data", [OLD, gzip.compress(OLD), b"".join(gzip.compress(OLD[i : i + 7]) for i in range(0, len(OLD), 7))])
def test_headers_lengths_and_types(data):
    page, dns = [A.converted("old.arc", i, r) for i, r in enumerate(A.parse_arc(data))]
    assert (page["type"], page["date"], page["payload"]) == ("response", "1997-02-03T04:05:06Z", b"<b>old</b>")
    assert (dns["type"], dns["date"], dns["mime"], dns["payload"]) == ("resource", "1997-02-03T04:05:00Z", "text/dns", b"x 1.2.3.4")
    assert page["record_id"] == A.converted("old.arc", 0, next(A.parse_arc(data)))["record_id"]


def test_wrong_archives_are_errors():
    with pytest.raises(ValueError, match="fields"):
        list(A.parse_arc(b"http://x.example/ 1.2.3.4 19970203040506 3\nabc"))
    with pytest.raises(ValueError, match="early"):
        list(A.parse_arc(b"http://x.example/ 1.2.3.4 19970203040506 text/html 30\nabc"))
    with pytest.raises(ValueError, match="not the start"):
        list(A.parse_warc(b"HTTP/1.1 200 OK\r\n\r\n"))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    arc = A.write_arc(none)
    assert A.read_arc(spark, arc).count() == 0 and A.read_warc(spark, A.convert(spark, arc)).count() == 0
