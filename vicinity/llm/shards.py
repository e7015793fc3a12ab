"""Contiguous shards of near-equal bytes, cut on global prefix sums.

The table is ordered by document id and cut into ranges; each range sums its bytes
and rows, the running totals of the ranges (one row each) are added to the running
totals inside them, and the whole is cut at equal byte targets. No text moves: rows
are sized first and only ids and sizes are shuffled.

A null text has 0 bytes (its record still takes one), equal ids are ordered by
checksum and size, null ids come last, an empty table gives no rows. Rows alike in
all of these are interchangeable; they share a task, which holds 24 bytes of each. Other
columns aren't read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


EXACT = 1 << 53  # whole numbers below it are themselves as doubles
HIGH = 1 << 31  # above the number of any part


def cut_into_ranges(rows: DataFrame, ranges: int) -> DataFrame:
    """Add ``_range``, ascending with (doc_id, text_crc32), null ids in the last ones. The
    cuts are approximate percentiles and travel as literals: a repeated task finds the same
    ranges, and any cut gives the same shards. An id that is several percentiles, or null,
    is cut into as many ranges by checksum."""
    order = F.col("doc_id").cast("double")
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    found, missing = rows.agg(F.percentile_approx(order, shares), F.avg(F.col("doc_id").isNull().cast("int"))).first()
    times = Counter(found or [0.0])
    cuts = [float("-inf"), *sorted(times), float("inf")]
    to_range = Bucketizer(splits=cuts, inputCol="_order", outputCol="_range", handleInvalid="keep")
    placed = to_range.transform(rows.withColumn("_order", order)).drop("_order")
    # a cut opens its range: other ids there are higher
    parts = F.when(F.col("doc_id").isNull(), F.lit(max(1, round((missing or 0) * ranges))))
    hot = [(int(value), n) for value, n in times.items() if n > 1 and abs(value) < EXACT]
    if hot:
        of_id = F.create_map(*[F.lit(x).cast("long") for pair in hot for x in pair])
        parts = parts.otherwise(F.try_element_at(of_id, F.col("doc_id")))
    part = F.coalesce(F.floor(F.col("text_crc32") * parts / F.lit(1 << 32)), F.lit(HIGH - 1))
    number = F.coalesce(F.col("_range"), F.lit(float(len(cuts)))).cast("long")
    return placed.withColumn("_range", number * HIGH + part)


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot (from 0 in each shard).

    A document goes to the shard in which its middle byte falls, so a shard's bytes
    miss the target by no more than a document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = cut_into_ranges(sized, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    totals = placed.groupBy("_range").agg(F.sum("size").alias("_size"), F.count("*").alias("_rows"))
    running, everything = Window.orderBy("_range"), Window.partitionBy()  # over one row per range
    before = totals.select(
        "_range",
        (F.sum("_size").over(running) - F.col("_size")).alias("_size_before"),
        (F.sum("_rows").over(running) - F.col("_rows")).alias("_rows_before"),
        F.sum("_size").over(everything).alias("_all"),
    )
    inside = Window.partitionBy("_range").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    counted = (
        placed.withColumn("_up_to", F.sum("size").over(inside))
        .withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(before), "_range")
    )
    middle = f"cast(2 * (_size_before + _up_to) - size as decimal(28, 0)) * {int(shards)}"
    cut = F.expr(f"cast(({middle}) div (2 * _all) as int)")
    numbered = counted.withColumn("shard", cut).withColumn("_no", F.col("_rows_before") + F.col("_row") - 1)
    starts = numbered.groupBy("shard").agg(F.min("_no").alias("_first"))  # one row per shard
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_no") - F.col("_first")).alias("slot")
    )
