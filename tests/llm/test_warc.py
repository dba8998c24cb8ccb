import gzip
import hashlib

import pytest

from embedlift.llm import warc


def write_and_read(spark, rows, path):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, block string")
    warc.write_archives(pages, path)
    return warc.read_pages(spark, path)


def expected(rows):
    out = []
    for page, _, html, *_ in rows:
        payload = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "").encode() == payload and p is not None]
        first = min(same) if len(payload) >= 100 and same else page
        revisit = first != page
        out.append((page is None, page or 0, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, scratch):
    long = "é<p>text\r\n\r\nWARC/1.1\r\n" * 9000
    rows = [(5, "http://a/\r\nb", long), (3, None, long), (7, "u", "x" * 99), (1, "u", "x" * 99), (2, "u", None), (4, "u", ""), (8, "u", "y" * 100),
            (6, "u", "y" * 100), (6, "u", "y" * 100), (None, "u", "z" * 200), (None, "u", "y" * 100), (9, "u", "👍" * 33000)]
    rows = [(*r, "theirs", None) for r in rows]
    pages = write_and_read(spark, rows, scratch)
    found = pages.collect()
    assert warc.dangling(pages).count() == 0 and warc.dangling(pages.where("page_id <> 6")).count() == 1
    assert all(r.problem is None for r in found)
    got = [(r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == expected(rows)
    assert {r.page_id: bytes(r.payload).decode() for r in found if r.record_type == "response"}[3] == long
    records = warc.read_records(spark, scratch)
    assert records.where("record_type = 'continuation'").count() > 4


def test_missing_segments_are_reported(spark, scratch):
    pages = spark.createDataFrame([(1, "u", "a" * 200_000)], "page_id long, url string, html string")
    warc.write_archives(pages, scratch)
    records = warc.read_records(spark, scratch)
    assert warc.reassembled(records).first().problem is None
    assert warc.reassembled(records.where("number <> 2")).first().problem == "segments are missing"
    assert warc.reassembled(records.where("total is null")).first().problem == "segments are missing"


def test_foreign_framing():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [b for _, b in warc.records_in(gzip.compress(record) + gzip.compress(record))] == [b"abcd", b"abcd"]
    with pytest.raises(ValueError):
        list(warc.records_in(record[:-8]))
    assert warc.unchunked(b"3;x=y\r\nabc\r\n1\r\nd\r\n0\r\n\r\n") == b"abcd"
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody") == b"body"
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n9\r\nabc\r\n") is None


def test_empty_table(spark, scratch):
    assert write_and_read(spark, [], scratch).count() == 0


def test_a_page_of_twenty_megabytes(spark, scratch):
    body = "<p>é" + "0123456789abcdef\r\n" * 1_150_000
    rows = [(1, "u", body, None, None), (2, "v", body, None, None), (3, "w", "short", None, None)]
    found = {r.page_id: r for r in write_and_read(spark, rows, scratch).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem").collect()}
    want = (len(body.encode()), hashlib.sha256(body.encode()).hexdigest())
    assert (found[1].payload_bytes, found[1].payload_digest, found[1].record_type, found[1].problem) == (*want, "response", None)
    assert (found[2].payload_bytes, found[2].payload_digest, found[2].record_type, found[2].refers_to) == (*want, "revisit", 1)


def test_segments_equal_their_definition():
    for body in ("", "a", "é" * 8192, "x" * 8193, "👍" * 40_000):
        chunks = [body[i:i + warc.CHUNK_CHARS] for i in range(0, len(body), warc.CHUNK_CHARS)]
        block = warc._HEAD + "".join(f"{len(c.encode()):x}\r\n{c}\r\n" for c in chunks) + "0\r\n\r\n"
        parts = warc.segments(body)
        assert "".join(parts) == block and all(len(p) == warc.SEGMENT_CHARS for p in parts[:-1]) and 0 < len(parts[-1]) <= warc.SEGMENT_CHARS
    assert warc.segments(None) == [warc._HEAD]
