import gzip
import hashlib

import pytest
from catlens.llm.files import RangeReader
from catlens.llm.shared import scratch
from catlens.llm.warc import archive_and_read, archive_path, lookup, parse_record, record, url_key, write_archives, write_index

LONG = "<p>" + "ü" * 600


def pages(spark, rows):
    return spark.createDataFrame([(h, p, u, "d", 1) for p, u, h in rows], "html string, page_id long, url string, digest string, k int")


ROWS = [
    (1, "http://www.b.example.com/x?q=1", LONG), (9, "https://b.example.com:443/x?q=1", LONG), (4, "http://a.example.com/", LONG), (5, "http://a.example.com/", "short"),
    (6, "http://a.example.com/", "short"), (7, None, None), (8, "", ""), (10, "not a url\r\nat all", "x" * 999), (11, "http://[bad", "x" * 999), (12, "http://h/é ü", "x" * 1000),
    (13, "http://h/2", "x" * 1000), (13, "http://h/2", "x" * 1000), (None, "http://n/", LONG), (14, "http://z/\r\n\r\n", "a\r\n\r\nb"),
]


def brute(rows):
    top = {}
    for p, _, h in rows:
        if h and len(h.encode()) >= 1000 and p is not None:
            top[h] = max(p, top.get(h, p))
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        to = top.get(h)
        revisit = to is not None and to != p
        out.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_written_and_read_back(spark):
    got = archive_and_read(pages(spark, ROWS)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS)


def test_empty_table(spark):
    assert archive_and_read(pages(spark, [])).count() == 0


def test_lookup_finds_exactly_the_key(spark):
    rows = [(i, f"http://h{i % 7}.example.org/p{i % 40}", f"page {i}") for i in range(300)] + [(1000 + i, "http://hot.example.org/", f"hot {i}") for i in range(200)]
    out = scratch(spark, "warc")
    captures = write_archives(pages(spark, rows), out)
    index = write_index(captures, out + "/index", block_lines=7)
    wanted = ["http://h3.example.org/p3", "https://www.hot.example.org/", "http://absent.example.org/", "http://h1.example.org/p8", "http://h1.example.org/p8"]
    got = sorted(r.page_id for r in lookup(index, spark.createDataFrame([(u,) for u in wanted], "url string")).collect())
    keys = {url_key(u) for u in wanted}
    assert got == sorted(p for p, u, _ in rows if url_key(u) in keys)


def test_archives_are_gzip_members(spark):
    out = scratch(spark, "warc")
    captures = write_archives(pages(spark, ROWS[:3]), out).collect()
    for c in captures:
        reader = RangeReader(archive_path(out, c.file_no))
        raw = gzip.decompress(reader.read(c.offset, c.length))
        whole = gzip.decompress(reader.read(0, reader.size))
        reader.close()
        assert raw in whole
        warc, http, payload = parse_record(raw)
        assert warc["WARC-Type"] == c.record_type and (payload.decode() == LONG or c.record_type == "revisit")


def test_record_checks_its_length():
    raw = record(1, "http://x/", b"abc", "d", None, "2020-01-01T00:00:00Z")
    assert parse_record(raw)[2] == b"abc"
    with pytest.raises(ValueError):
        parse_record(raw[:-5])


def test_url_keys():
    assert url_key("http://WWW.B.com:80/x?q#f") == "com,b)/x?q" and url_key("https://a.b.c:8080") == "c,b,a:8080)/" and url_key(None) == ""
