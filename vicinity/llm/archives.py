"""WARC records in ZIP packages, read back by range.

A package holds stored members: ``archive/data.warc.gz`` (a gzip member per record),
``indexes/index.cdxj`` (a line per record: where it lies in the member) and
``datapackage.json``. The reader parses the end records and the central directory,
ZIP64 forms included, finds where the members' bytes begin, reads the index, and then
reads each record by its own range; nothing is unpacked to disk.

Payloads are the UTF-8 bytes of the html (null: empty). Of equal payloads of at least
100 bytes the smallest page id is the response, the others revisit it; rows that
repeat that id with that payload are responses too. A null url gives a record without
target. Null page ids are responses and come back as null. An empty table writes no
package and gives no rows.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import struct
import zipfile
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from vicinity.llm.common import file_system, pieces, write_file

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing ----------------------------------------------------------------------


def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, html, digest, and ``refers_to`` for those that revisit."""
    html = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html")).withColumn(
        "digest", F.sha2("html", 256)
    )
    repeated = (
        known.filter((F.octet_length("html") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select(F.col("digest").alias("same"), "first")
    )
    joined = known.join(repeated, known["digest"] == F.col("same"), "left")
    later = F.when(F.col("page_id") > F.col("first"), F.col("first"))
    return joined.select("page_id", "url", "html", "digest", later.alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A WARC record; a revisit keeps the HTTP head, whose length is the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\s\x00-\x1f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def package(records: list[bytes], names: list[str]) -> bytes:
    """The bytes of a package; all members are stored."""
    members, lines, at = [], [], 0
    for name, data in zip(names, records, strict=True):
        members.append(gzip.compress(data, 1, mtime=0))
        lines.append(f"{name} {json.dumps({'offset': at, 'length': len(members[-1]), 'filename': DATA})}\n")
        at += len(members[-1])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in (
            (DATA, b"".join(members)),
            (INDEX, "".join(lines).encode()),
            ("datapackage.json", json.dumps({"profile": "data-package", "records": len(records)}).encode()),
        ):
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def write_archives(pages: DataFrame, folder: str, date: str = "2020-01-01T00:00:00Z", most_bytes: int = 32 << 20) -> DataFrame:
    """Packages of ``with_revisits`` rows below ``folder``; one manifest row each.

    Write the manifest to a table before use: a recomputed task writes new files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        names: list[str] = []
        size = 0

        def close() -> pa.RecordBatch:
            uri, length = write_file(folder, ".wacz", [package(held, names)])
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([length], pa.int64())], names=["file", "bytes"])

        for batch in pieces(batches, "html"):
            for row in batch.to_pylist():
                payload = row["html"].encode()
                held.append(record(row["page_id"], row["url"], payload, row["digest"], row["refers_to"], date))
                names.append(record_id(row["page_id"]))
                size += len(held[-1])
                if size >= most_bytes:
                    yield close()
                    held, names, size = [], [], 0
        if held:
            yield close()

    return pages.mapInArrow(run, StructType([StructField("file", StringType()), StructField("bytes", LongType())]))


# --- reading ----------------------------------------------------------------------


class Package:
    """The directory of a ZIP package behind a file that can seek."""

    def __init__(self, file: Any, size: int) -> None:
        self.file, self.size = file, size
        self.members = self._directory()

    def read(self, at: int, length: int) -> bytes:
        if at < 0 or length < 0 or at + length > self.size:
            raise ValueError("the package points outside itself")
        self.file.seek(at)
        return self.file.read(length)

    def _directory(self) -> dict[str, tuple[int, int, int, int]]:
        """Name to (method, packed size, size, place of the local header)."""
        tail_at = max(0, self.size - 65557)  # the end record and the longest comment
        tail = self.read(tail_at, self.size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
            end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("no end of a central directory")
        entries, length, start = struct.unpack_from("<HLL", tail, end + 10)
        locator = tail_at + end - 20
        if locator >= 0 and self.read(locator, 4) == b"PK\x06\x07":
            (at,) = struct.unpack_from("<Q", self.read(locator, 20), 8)
            big = self.read(at, 56)
            if big[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record where its locator points")
            entries, length, start = struct.unpack_from("<QQQ", big, 32)
        directory, members, at = self.read(start, length), {}, 0
        for _ in range(entries):
            if directory[at : at + 4] != b"PK\x01\x02":
                raise ValueError("the central directory is damaged")
            (method,) = struct.unpack_from("<H", directory, at + 10)
            packed, full, n, extra, comment = struct.unpack_from("<LLHHH", directory, at + 20)
            (place,) = struct.unpack_from("<L", directory, at + 42)
            name = directory[at + 46 : at + 46 + n].decode("utf-8")
            full, packed, place = big_values(directory[at + 46 + n : at + 46 + n + extra], full, packed, place)
            members[name] = (method, packed, full, place)
            at += 46 + n + extra + comment
        return members

    def where(self, name: str) -> tuple[int, int]:
        """Place and size of a stored member's bytes in the package."""
        method, packed, _, place = self.members[name]
        if method:
            raise ValueError(f"{name} is packed by method {method}, not stored")
        head = self.read(place, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header of {name}")
        n, extra = struct.unpack_from("<HH", head, 26)
        return place + 30 + n + extra, packed


def big_values(extra: bytes, full: int, packed: int, place: int) -> tuple[int, int, int]:
    """Sizes and place, from the ZIP64 extra field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            full, packed, place = (next(values) if v == 0xFFFFFFFF else v for v in (full, packed, place))
        at += 4 + length
    return full, packed, place


LOCATION = StructType(
    [StructField("file", StringType()), StructField("bytes", LongType()), StructField("at", LongType()), StructField("length", LongType())]
)


def locate(manifest: DataFrame) -> DataFrame:
    """Where each record lies: package, its size, place and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = file_system(row["file"])
                with system.open_input_file(path) as f:
                    found = Package(f, row["bytes"])
                    starts = {n: found.where(n)[0] for n in found.members if n.endswith(".warc.gz")}
                    lines = found.read(*found.where(INDEX)).decode().splitlines()
                spots = [json.loads(line.split(" ", 1)[1]) for line in lines]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * len(spots), pa.string()),
                        pa.array([row["bytes"]] * len(spots), pa.int64()),
                        pa.array([starts[s["filename"]] + s["offset"] for s in spots], pa.int64()),
                        pa.array([s["length"] for s in spots], pa.int64()),
                    ],
                    names=LOCATION.names,
                )

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file", "bytes").repartition(spread, "file").mapInArrow(run, LOCATION)


def parse(data: bytes) -> dict[str, Any]:
    """Fields of a record; ``payload`` is None for a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
    kind = fields["warc-type"]
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload_bytes": length,
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
        "payload": payload if kind == "response" else None,
    }


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


RECORD = StructType(
    [
        StructField("page_id", LongType()),
        StructField("url", StringType()),
        StructField("record_type", StringType()),
        StructField("refers_to", LongType()),
        StructField("payload_bytes", LongType()),
        StructField("payload_digest", StringType()),
        StructField("payload", BinaryType()),
    ]
)


def read_archives(manifest: DataFrame) -> DataFrame:
    """All records of the packages, each read by its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        schema = pa.schema(list(zip(RECORD.names, kinds, strict=True)))
        for batch in batches:
            rows = sorted(batch.to_pylist(), key=lambda r: (r["file"], r["at"]))
            done, size, name, f = [], 0, None, None
            for row in rows:
                if row["file"] != name:
                    if f is not None:
                        f.close()
                    name = row["file"]
                    system, path = file_system(name)
                    f = system.open_input_file(path)
                f.seek(row["at"])
                done.append(parse(gzip.decompress(f.read(row["length"]))))
                size += done[-1]["payload_bytes"]
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, size = [], 0
            if f is not None:
                f.close()
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)

    return locate(manifest).mapInArrow(run, RECORD)
