"""Records of big CSV files, read by many tasks.

A quoted field may hold line breaks, so a line is a record of its own only if the quotes
before it, counted from the start of the file, are even. The file is read as lines in
byte ranges; the task that reads a range counts the quotes before each line of it, and
notes where the record of the line begins if the range begins outside quotes, and if
inside. The running parity of the ranges (one row each) says which of the two holds. Lines
that go on with a record, wherever it began, are joined to it; all others are complete and
stay where they are.

For files whose fields hold quotes only inside quotes, doubled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vicinity.session import materialize


_LINE = "_path string, block long, value string, quotes long, before long, position long, own_even long, own_odd long"


def _noted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of ranges (_path, block, value), in order, with their quotes, those before
    them in the range, their position in the file, and where a record that goes on beyond its
    line has begun, at the line or before it, for both parities (null: before the range)."""
    at, before, position, own = None, 0, 0, [-1, -1]
    for batch in batches:
        path, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        which = path.indices.to_numpy()
        edges = np.flatnonzero((which[1:] != which[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(block)]):
            if a == b:
                continue
            if at != (here := (path[a].as_py(), int(block[a]))):
                # a range but the first starts behind the line that crosses into it, so never at its first byte
                at, before, position, own = here, 0, int(block[a] + (block[a] > 0)), [-1, -1]
            part = batch.slice(a, b - a)
            quotes = pc.count_substring(part.column(2), '"').to_numpy().astype("int64")
            size = pc.binary_length(part.column(2)).to_numpy().astype("int64") + 1
            ahead, place = before + np.cumsum(quotes) - quotes, position + np.cumsum(size) - size
            columns = [*part.columns, pa.array(quotes), pa.array(ahead), pa.array(place)]
            for parity in (0, 1):
                opens = ((ahead + parity) % 2 == 0) & (quotes % 2 == 1)
                last = np.maximum.accumulate(np.append(own[parity], np.where(opens, place, -1)))[1:]
                own[parity] = int(last[-1])
                columns.append(pa.array(last, mask=last < 0))
            before, position = before + int(quotes.sum()), position + int(size.sum())
            yield pa.RecordBatch.from_arrays(columns, names=["_path", "block", "value", "quotes", "before", "position", "own_even", "own_odd"])


def csv_records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """_path, position (rises within a file, 0 for its first line) and record."""
    block = F.col("_metadata.file_block_start")
    lines = spark.read.option("lineSep", "\n").text(list(files)).select(F.col("_metadata.file_path").alias("_path"), block.alias("block"), "value")
    lines = materialize(lines.mapInArrow(_noted, _LINE), "csv-lines")
    ranges = lines.groupBy("_path", "block").agg(F.sum("quotes").alias("total"))
    before = Window.partitionBy("_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    begin = ranges.select("_path", "block", (F.coalesce(F.sum("total").over(before), F.lit(0)) % 2).alias("odd"))
    begin = materialize(begin, "csv-ranges")
    placed = lines.join(F.broadcast(begin), ["_path", "block"]).withColumn("starts", (F.col("odd") + F.col("before")) % 2 == 0)

    whole = placed.filter(F.col("starts") & (F.col("quotes") % 2 == 0))
    parts = placed.filter(~F.col("starts") | (F.col("quotes") % 2 == 1))
    # a part that doesn't start a record belongs to the last one that has started before it
    known = F.when(F.col("odd") == 0, F.col("own_even")).otherwise(F.col("own_odd"))
    last = placed.groupBy("_path", "block").agg(F.max(known).alias("last"))
    earlier = last.select("_path", "block", F.last("last", ignorenulls=True).over(before).alias("open"))
    earlier = materialize(earlier, "csv-open")
    owned = parts.join(F.broadcast(earlier), ["_path", "block"]).withColumn("own", F.coalesce(known, F.col("open")))
    line = F.struct("position", "value")
    joined = owned.groupBy("_path", F.col("own").alias("position")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["value"]), "\n").alias("record")
    )
    records = whole.select("_path", "position", F.col("value").alias("record")).unionByName(joined)
    trimmed = F.regexp_replace("record", "\r$", "")
    return records.select("_path", "position", trimmed.alias("record")).filter("record <> ''")


def csv_columns(records: DataFrame, columns: int) -> DataFrame:
    """The fields of each record as ``c0``, ``c1``, ... beside _path and position."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    parsed = F.from_csv("record", F.lit(schema), {"quote": '"', "escape": '"'})
    return records.select("_path", "position", parsed.alias("f")).select("_path", "position", "f.*")
