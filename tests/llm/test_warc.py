"""Archives read back, and lookups against a plain scan."""

import gzip
import hashlib
import zlib

import pytest

from tallylake.llm import warc

BIG = "<p>" + "copy " * 400


def brute(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload]
        whole = max((p for p in same if p is not None), default=None) if len(payload) >= 1000 else page
        own = whole == page
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "response" if own else "revisit", None if own else whole))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rows = [(i, f"http://h{i % 5}.Example.org:80/p {i % 11}?q=é\n{i}", BIG if i % 3 == 0 else f"page {i}" * (i % 200)) for i in range(900)]
    rows += [(1000, None, None), (None, None, None), (1001, "no url", BIG), (1001, "no url", BIG), (None, "http://x.org", BIG), (1002, "http://x.org/", "ü\0\r\n\r\n" * 50_000)]
    return rows + [(2000 + i, "http://one.org/", "same small") for i in range(50)]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", 3) for r in rows], "page_id long, url string, html string, key string, digest int").repartition(4)


def test_read_back(pages, rows):
    found = warc.write_and_read(pages)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_a_revisit_reads_the_payload_it_states(spark):
    """One page id, one URL, two payloads: each revisit has its own."""
    a, b, small = "A" * 1500, "B" * 2500, "c" * 10
    rows = [(7, "http://x.org/", a), (7, "http://x.org/", b), (4, "http://y.org/", b), (5, "http://x.org/", a), (7, "http://x.org/", small)]
    found = warc.write_and_read(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_archives_are_gzip_members_that_any_reader_splits(pages, rows):
    archive = warc.write_archive(pages)
    records = 0
    for r in archive.files.collect():
        with warc.open_file(r.archive) as f:
            data = f.read()
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") >= 1
        while data:
            member = zlib.decompressobj(31)
            whole = member.decompress(data)
            assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")
            data = member.unused_data
            records += 1
    assert records == len(rows)


def test_lookups_find_each_capture(spark, pages, rows):
    archive = warc.write_archive(pages)
    index = warc.Index(archive.root)
    keys = {r.page_id: r.key for r in pages.select("page_id", warc.key_of(warc.clean_uri(pages["url"])).alias("key")).collect()}
    for page, _, html in rows[::37]:
        hits = list(index.find(keys[page], page))
        assert hits
        for where, line in hits:
            record = index.read(where, line)
            assert record.page_id == page
            if line[1] == "response":
                assert record.payload == (html or "").encode()
    assert list(index.find("org,none)/", 1)) == [] and list(index.find(keys[5], 6)) == [] and list(index.find("", None)) == []


def test_keys(spark):
    urls = {
        "http://b.Example.org:80/x?y#z": "org,example,b)/x?y#z",
        "https://user@host/": "host)/",
        "no url": ")no%20url",
        None: ")",
        "ftp://a.b?q": "b,a)?q",
    }
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.k for r in frame.select(warc.key_of(warc.clean_uri(frame["url"])).alias("k")).collect()] == list(urls.values())


def test_empty_table(pages):
    assert warc.write_and_read(pages.limit(0)).collect() == []
