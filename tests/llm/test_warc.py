from __future__ import annotations

import gzip
import hashlib
import io
import zlib

import pytest

from airpanel.llm.warc import Damaged, archive_folder, read_records, read_warc, record_bytes, write_warc

LONG = "<p>" + "ü" * 400_000 + "</p>"
PAGES = [
    (1, "http://a/1", "x" * 100), (2, "http://a/2", "x" * 100), (3, "http://a/3", "x" * 99), (4, "http://a/4", "x" * 99), (5, None, None),
    (6, "http://a/6\r\nInjected: yes", ""), (7, "http://ü/7", LONG), (8, "http://a/8", LONG), (None, "http://a/n", "x" * 100),
    (None, "http://a/n", "y" * 200), (9, "http://a/9", "\r\n\r\nContent-Length: 5\r\n\r\n" * 20), (1, "http://a/1b", "x" * 100),
    (10, "http://a/10", "é" * 50), (11, "http://a/11", "é" * 50),
]


def expected():
    out = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == body and p is not None]
        first = min(same) if same and len(body) >= 100 else None
        again = first is not None and page != first
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(p, u, h, "x") for p, u, h in PAGES], "page_id long, url string, html string, digest string").repartition(3)


def test_written_and_read_back(spark, pages, rows):
    manifest = write_warc(pages, archive_folder(spark))
    assert sum(r.records for r in manifest.collect()) == len(PAGES)
    found = read_warc(manifest, payloads=True).persist()
    assert rows(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected()
    for r in found.collect():
        assert r.record_type == "revisit" or hashlib.sha256(r.payload).hexdigest() == r.payload_digest
        assert "\n" not in r.url


def test_every_record_is_one_gzip_member(spark, pages):
    row = write_warc(pages.coalesce(1), archive_folder(spark)).first()
    packed, members = open(row.path.removeprefix("file://"), "rb").read(), 0
    assert gzip.decompress(packed).count(b"WARC/1.1\r\n") == row.records
    while packed:
        inflate = zlib.decompressobj(31)
        assert inflate.decompress(packed).startswith(b"WARC/1.1\r\n")
        packed, members = inflate.unused_data, members + 1
    assert members == row.records


def archive():
    body = b"hello " * 50_000
    return b"".join(record_bytes(i, "u", body, hashlib.sha256(body).hexdigest(), None, False) for i in range(3))


def test_reader_takes_small_blocks():
    class Drip(io.BytesIO):
        def read(self, n=-1):
            return super().read(7)

    assert [r["page_id"] for r in read_records(Drip(archive()))] == [0, 1, 2]


def test_damage_is_found():
    good = archive()
    with pytest.raises(Damaged):
        list(read_records(io.BytesIO(good[:-20])))
    with pytest.raises(Damaged):
        list(read_records(io.BytesIO(good[:200] + b"\x00" * 30 + good[230:])))
    with pytest.raises(Damaged):
        list(read_records(io.BytesIO(record_bytes(1, "u", b"abc", "0" * 64, None, False))))
    plain = gzip.decompress(record_bytes(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, False))
    with pytest.raises(Damaged):
        list(read_records(io.BytesIO(gzip.compress(plain + b"more"))))


def test_empty_table(spark, pages):
    manifest = write_warc(pages.limit(0), archive_folder(spark))
    assert manifest.collect() == [] and read_warc(manifest).collect() == []
