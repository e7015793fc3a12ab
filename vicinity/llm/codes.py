"""Token-id files of directly addressable codes.

An id is split into chunks of a few bits. Level 0 holds the low chunk of every id,
level 1 the next chunk of those ids that need one, and so on; each level but the last
has a bitmap that says which of its codes continue, with a directory of ones before
each block. The code that continues a token on the next level stands at the rank of
its bit, so any token is read by a few range reads without decoding a block.

A file holds the documents of one range in ascending id order: sections of plain
little-endian arrays, an index of them as JSON, its length and a closing mark.

Null and empty texts are documents of their end id alone. Rows with equal ids all
stay, ordered by text (null first) and dealt over tasks by the first 32 characters; a
null id sorts first. An empty table gives no files and no rows. Only the two named columns are read.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from vicinity.llm.bpe import bpe
from vicinity.llm.common import file_system, pieces, write_file

MARK = b"DACIDS01"
HEAD = 32  # characters of a text that deal rows of equal ids
BLOCK = 512  # bits per entry of a rank directory


def to_sections(ids: np.ndarray, bits: int = 8) -> tuple[dict[str, Any], dict[str, np.ndarray]]:
    """Level by level: codes, continuation bits and ones before each block."""
    if not 1 <= bits <= 16:
        raise ValueError("chunks have 1 to 16 bits")
    kind = "<u1" if bits <= 8 else "<u2"
    rest, sections, counts = ids.astype(np.uint32), {}, []
    while True:
        k = len(counts)
        counts.append(len(rest))
        sections[f"codes{k}"] = (rest & ((1 << bits) - 1)).astype(kind)
        high = rest >> bits
        more = high > 0
        if not more.any():
            return {"bits": bits, "counts": counts}, sections
        sections[f"bits{k}"] = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64)
        sections[f"ranks{k}"] = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
        rest = high[more]


def file_parts(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, bits: int = 8) -> list[bytes]:
    """The bytes of a file of documents that stand one after another in ``ids``."""
    index, sections = to_sections(ids, bits)
    sections["starts"] = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    sections["docs"] = np.array([d or 0 for d in doc_ids], "<i8")
    sections["nulls"] = np.packbits(np.array([d is None for d in doc_ids], bool), bitorder="little")
    places, at, parts = {}, 0, []
    for name, values in sections.items():
        parts.append(values.tobytes())
        places[name] = [at, len(parts[-1]), values.dtype.str]
        at += len(parts[-1])
    tail = json.dumps(index | {"documents": len(doc_ids), "places": places}).encode()
    return [*parts, tail, struct.pack("<Q", len(tail)), MARK]


class CodeFile:
    """A file open for range reads."""

    def __init__(self, file: Any, size: int) -> None:
        self.file = file
        file.seek(size - 16)
        length, mark = struct.unpack("<Q8s", file.read(16))
        if mark != MARK:
            raise ValueError("not a file of directly addressable codes")
        file.seek(size - 16 - length)
        self.index = json.loads(file.read(length))
        self.bits, self.counts = self.index["bits"], self.index["counts"]

    def section(self, name: str, start: int = 0, stop: int | None = None) -> np.ndarray:
        at, length, kind = self.index["places"][name]
        width = np.dtype(kind).itemsize
        stop = length // width if stop is None else stop
        self.file.seek(at + start * width)
        return np.frombuffer(self.file.read((stop - start) * width), kind)

    def _continues(self, k: int, start: int, stop: int) -> np.ndarray:
        first = start // 8
        packed = self.section(f"bits{k}", first, (stop + 7) // 8)
        return np.unpackbits(packed, bitorder="little")[start - first * 8 : stop - first * 8].astype(bool)

    def _rank(self, k: int, place: int) -> int:
        """Ones before a place of level ``k``."""
        block = place // BLOCK
        before = int(self.section(f"ranks{k}", block, block + 1)[0])
        return before + int(self._continues(k, block * BLOCK, place).sum())

    def tokens(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """Ids ``start`` to ``stop`` - 1; only their own codes are read."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        codes = self.section(f"codes{level}", start, stop).astype(np.uint32)
        if level + 1 < len(self.counts):
            more = self._continues(level, start, stop)
            if more.any():
                first = self._rank(level, start)
                codes[more] |= self.tokens(first, first + int(more.sum()), level + 1) << np.uint32(self.bits)
        return codes

    def token(self, place: int) -> int:
        return int(self.tokens(place, place + 1)[0])

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        n = self.index["documents"]
        null = np.unpackbits(self.section("nulls"), bitorder="little")[:n].astype(bool)
        docs = [None if z else int(d) for d, z in zip(self.section("docs"), null, strict=True)]
        return docs, self.section("starts").astype(np.int64)


MANIFEST = StructType(
    [
        StructField("part", IntegerType()),
        StructField("seq", IntegerType()),
        StructField("file", StringType()),
        StructField("bytes", LongType()),
        StructField("documents", LongType()),
        StructField("tokens", LongType()),
    ]
)


def write_codes(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens_per_file: int = 1 << 22,
    bits: int = 8,
) -> DataFrame:
    """Encode whole texts with a byte-level BPE file and write files below ``folder``.

    Returns the manifest, one row per file; ``part`` and ``seq`` give their order.
    Write it to a table before use: a recomputed task writes new files. A file is
    closed after the document that fills it, so a long one stays whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe(path)
        end = np.array([end_id], "<u4").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        packed: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            ids = np.frombuffer(b"".join(packed), "<u4")
            uri, size = write_file(folder, ".dac", file_parts(names, sizes, ids, bits))
            row = [part, seq, uri, size, len(names), len(ids)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                names=MANIFEST.names,
            )

        for batch in pieces(batches, "text"):
            ids = encoder.packed_all(batch.column(1).to_pylist())
            for name, body in zip(batch.column(0).to_pylist(), ids, strict=True):
                names.append(name)
                packed.append(body + end)
                held += len(packed[-1]) // 4
                if held >= tokens_per_file:
                    yield close()
                    names, packed, held, seq = [], [], 0, seq + 1
        if names:
            yield close()

    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # an id that many rows have, or none, is dealt by the heads of its texts: the same order
    head = F.substring("text", 1, HEAD)
    placed = rows.repartitionByRange(ranges, F.col("doc_id"), head).sortWithinPartitions("doc_id", "text")
    return placed.mapInArrow(run, MANIFEST)


def with_starts(manifest: DataFrame) -> DataFrame:
    """Add ``first``: the tokens of all files before. Parts are summed first, so the
    one window over all of them has a row per part."""
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("_sum"))
    before = parts.select(
        "part", (F.sum("_sum").over(Window.orderBy("part")) - F.col("_sum")).alias("_before")
    )
    inside = Window.partitionBy("part").orderBy("seq")
    return (
        manifest.join(before, "part")
        .withColumn("first", F.col("_before") + F.sum("tokens").over(inside) - F.col("tokens"))
        .drop("_before")
    )


def read_codes(manifest: DataFrame) -> DataFrame:
    """Documents of the files: doc_id, start among all ids, ids (packed, little-endian
    unsigned 32 bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = file_system(row["file"])
                with system.open_input_file(path) as f:
                    codes = CodeFile(f, row["bytes"])
                    names, starts = codes.documents()
                    for low in range(0, len(names), 512):
                        high = min(low + 512, len(names))
                        ids = codes.tokens(int(starts[low]), int(starts[high])).astype("<u4")
                        cut = starts[low : high + 1] - starts[low]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(names[low:high], pa.int64()),
                                pa.array(starts[low:high] + row["first"], pa.int64()),
                                pa.array([ids[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                            ],
                            names=["doc_id", "start", "ids"],
                        )

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = StructType(
        [StructField("doc_id", LongType()), StructField("start", LongType()), StructField("ids", BinaryType())]
    )
    files = with_starts(manifest).select("file", "bytes", "first").repartition(spread, "file")
    return files.mapInArrow(run, out)
