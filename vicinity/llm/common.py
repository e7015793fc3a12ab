"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinity.session import scratch
from vicinity.sources.files import file_system, shared_folder, write_file  # noqa: F401


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: later steps read files that every executor can reach. The
    shuffle files behind it are no longer needed, so the driver is asked to let
    them go before the next step makes its own.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


HEAVY = 1_000  # keys that hold this part of all rows, or more, are broadcast


def with_values(rows: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Inner join with a written table of one row per key, whose ``n`` says how many rows
    have the key. Keys with a thousandth of the rows or more, 1,000 at most, are sent to
    the rows; with the others sorted, no key fills a task."""
    total = values.agg(F.sum("n")).first()[0] or 0
    heavy, light = values.filter(F.col("n") * HEAVY >= total).drop("n"), values.filter(F.col("n") * HEAVY < total).drop("n")
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return rows.join(F.broadcast(heavy), key).unionByName(rest.join(light.hint("merge"), key))


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores as it takes to be no column's."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def pieces(batches: Iterator[pa.RecordBatch], col: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a text column holds about ``most_bytes`` per piece.

    A longer single text makes a piece of its own; nothing is dropped."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = text_sizes(batch.column(batch.schema.get_field_index(col)))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + most_bytes, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def text_sizes(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text; 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in one array, and the n + 1 offsets of its rows."""
    import pyarrow.compute as pc

    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offset_buffer, data = filled.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(k).type) for k, c in columns.items()], schema=schema
    )
