import hashlib
import io
import zipfile

import pytest

from vicinity.llm import archives
from vicinity.llm.common import shared_folder, written

PAGES = [
    (1, "http://a/", "x" * 150),
    (2, None, "x" * 150),
    (3, "http://b/\r\nWARC-Type: fake", "x" * 99),
    (4, "http://c/", "x" * 99),
    (5, "http://d/", None),
    (6, "http://e/", ""),
    (None, "http://f/", "x" * 150),
    (7, "http://g/", "é\r\n\r\nContent-Length: 5\r\n" * 20),
    (8, "http://h/", "é\r\n\r\nContent-Length: 5\r\n" * 20),
    (0, "http://i/", "y" * 300_000),
]


def brute(rows):
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= 100:
            first[h] = min(p, first.get(h, p))
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        to = first.get(h) if p is not None and first.get(h, p) < p else None
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


@pytest.mark.parametrize("most", [1, 32 << 20])
def test_odd_rows(spark, most):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string")
    manifest = archives.write_archives(archives.with_revisits(pages), shared_folder(spark, "wacz"), most_bytes=most)
    found = archives.read_archives(written(manifest, "manifest"))
    assert result(found) == brute(PAGES)
    kept = {r.page_id: r for r in found.collect()}
    assert bytes(kept[7].payload).decode() == PAGES[7][2] and kept[8].payload is None and kept[2].url is None


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = archives.write_archives(archives.with_revisits(pages), shared_folder(spark, "wacz"))
    assert archives.read_archives(written(manifest, "manifest")).count() == 0


@pytest.mark.parametrize("limit", [None, 10])
def test_directory_with_and_without_zip64(monkeypatch, limit):
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    data = archives.package([b"first record", b"second"], ["<urn:page:1>", "<urn:page:2>"])
    assert (b"PK\x06\x06" in data) == bool(limit)
    for tail in (b"", ):
        found = archives.Package(io.BytesIO(data + tail), len(data))
        assert set(found.members) == {archives.DATA, archives.INDEX, "datapackage.json"}
        at, length = found.where(archives.INDEX)
        assert b"urn:page:2" in data[at : at + length]


def test_comment_and_damage():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.warc.gz", b"abc")
        z.comment = b"holds PK\x05\x06 itself, and more than twenty-two bytes"
    data = out.getvalue()
    found = archives.Package(io.BytesIO(data), len(data))
    at, n = found.where("a.warc.gz")
    assert data[at : at + n] == b"abc"
    with pytest.raises(ValueError):
        archives.Package(io.BytesIO(data[:-9]), len(data) - 9)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"abc" * 99)
    with pytest.raises(ValueError):
        archives.Package(io.BytesIO(packed.getvalue()), len(packed.getvalue())).where("a")


def test_query_on_the_test_table(spark, sf):
    from vicinity.llm.queries import QUERIES

    pages = [(p.page_id, p.url, p.html) for p in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert result(QUERIES["op5_warc_packages"](spark, sf)) == brute(pages)
