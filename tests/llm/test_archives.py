import gzip
import hashlib

import pytest

from casametra.llm import archives



def arc(version, *records):
    out = bytearray(archives.arc_version_block(version, "a.arc"))
    for url, block in records:
        out += archives.arc_record(version, url, "19970203040506", block, "a.arc", len(out))
    return bytes(out)


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_records_are_cut_by_their_declared_lengths(version):
    blocks = [b"HTTP/1.0 200 OK\r\n\r\nhello\n\nhttp://x 1.2.3.4 19970101 text/html 5\n", b"", "été".encode()]
    found = list(archives.parse_arc(arc(version, *((f"http://h/{k}", b) for k, b in enumerate(blocks)))))
    assert [r.block for r in found] == blocks
    assert [(r.url, r.date, r.content_type) for r in found] == [(f"http://h/{k}", "19970203040506", "text/html") for k in range(3)]
    assert len({r.offset for r in found}) == 3


def test_damaged_arc_files_are_errors():
    whole = arc("1", ("http://h/", b"0123456789"))
    with pytest.raises(ValueError, match="declared bytes"):
        list(archives.parse_arc(whole[:-5]))
    with pytest.raises(ValueError, match="filedesc"):
        list(archives.parse_arc(b"http://h/ 0 0 text/html 1\nx\n"))
    with pytest.raises(ValueError, match="fields of version 2"):
        list(archives.parse_arc(arc("2") + archives.arc_record("1", "http://h/", "1", b"x", "a", 0)))
    with pytest.raises(ValueError, match="unknown ARC version"):
        list(archives.parse_arc(arc("1").replace(b"\n1 0", b"\n7 0")))


def test_converted_fields(spark):
    block = b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\npayload"
    files = spark.createDataFrame([("a.arc", bytearray(arc("1", ("http://h/p", block), ("http://h/q", b"no head"))))], "name string, content binary")
    first, second = archives.converted(files).orderBy("uri").collect()
    again = archives.converted(files).orderBy("uri").first()
    assert (first.record_key, first.uri, first.date, first.payload) == (7, "http://h/p", "1997-02-03T04:05:06Z", b"payload")
    assert first.payload_digest == hashlib.sha256(b"payload").hexdigest() and first.payload_bytes == 7
    assert first.record_id == again.record_id != second.record_id and first.record_id.startswith("<urn:uuid:")
    assert (second.record_key, second.http_head, second.payload) == (None, b"", b"no head")


BIG = "<html>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\né</html>"
PAGES = [
    (5, "http://a/ b", BIG), (3, "http://a/", BIG), (9, None, BIG), (9, "http://dup/", BIG),
    (1, "http://s/", "short"), (2, "http://s/", "short"), (4, "http://n/", None), (6, "http://e/", ""),
    (None, "http://k/", BIG), (7, "http://l/", "line\n" * 50_000),
]


def test_pages_survive_the_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    rows = archives.archive_pages(pages, str(tmp_path / "warc")).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        html = next(p[2] for p in PAGES if p[0] == r.record_key) or ""
        data = html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        revisit = html == BIG and r.record_key != 3
        assert (r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None))
        assert r.payload == (None if revisit else data)
    text = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "warc").glob("part-*.gz")))
    assert text.count(b"WARC-Type: ") == len(PAGES) and text.endswith(b"\r\n\r\n")
    fields = [f for f, _ in archives.parse_warc(text)]
    assert len({f["warc-record-id"] for f in fields}) == len(PAGES)


def test_pages_in_any_encoding_keep_their_bytes(spark, tmp_path):
    """Latin-1, Shift-JIS, zero bytes and a URL and a head that are no UTF-8."""
    bodies = ["café".encode("latin-1") * 50, "日本語".encode("shift_jis") * 60, bytes(range(256)) * 3, "café".encode("latin-1") * 50, b"\xe9"]
    head = b"HTTP/1.0 200 OK\r\nServer: caf\xe9\r\nX-Page-Id: %d\r\n\r\n"
    content = bytearray(archives.arc_version_block("1", "a.arc"))
    for k, body in enumerate(bodies):
        block = head % k + body
        content += b"http://h/caf\xe9/%d 1.2.3.4 19970203040506 text/html %d\n" % (k, len(block)) + block + b"\n"
    files = spark.createDataFrame([("a.arc", content)], "name string, content binary")
    typed = archives.with_types(archives.converted(files))
    archives.write_warc(typed, str(tmp_path / "w"))
    rows = archives.read_warc(spark, str(tmp_path / "w")).orderBy("record_key").collect()
    assert [r.uri for r in rows] == [f"http://h/caf%E9/{k}" for k in range(5)]
    assert [r.payload_digest for r in rows] == [hashlib.sha256(b).hexdigest() for b in bodies]
    assert [(r.record_type, r.refers_to) for r in rows] == [("response", None)] * 3 + [("revisit", 0), ("response", None)]
    assert [None if r.payload is None else bytes(r.payload) for r in rows] == [*bodies[:3], None, bodies[4]]


def test_payloads_that_many_pages_have(spark):
    """Empty pages and copies of one large page, a third of the table each."""
    rows = [(f"id{k}", k, 0 if k % 3 == 0 else 500, "empty" if k % 3 == 0 else "same" if k % 3 == 1 else f"d{k}") for k in range(3000)]
    records = spark.createDataFrame(rows, "record_id string, record_key long, payload_bytes long, payload_digest string")
    typed = archives.with_types(records)
    counts = {r.record_type: r["count"] for r in typed.groupBy("record_type").count().collect()}
    assert counts == {"response": 2001, "revisit": 999} and typed.filter("refers_to <> 1").isEmpty()
    assert typed.columns == [*records.columns, "record_type", "refers_to"]


def test_equal_keys_with_one_payload_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", BIG), (1, "v", BIG)], "page_id long, url string, html string")
    assert {r.record_type for r in archives.archive_pages(pages, str(tmp_path / "w")).collect()} == {"response"}


def test_no_pages_no_records(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert archives.archive_pages(pages, str(tmp_path / "w")).collect() == []


def test_damaged_warc_is_an_error():
    with pytest.raises(ValueError, match="no WARC record"):
        list(archives.parse_warc(b"junk"))
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"
    with pytest.raises(ValueError, match="does not end"):
        list(archives.parse_warc(record))
