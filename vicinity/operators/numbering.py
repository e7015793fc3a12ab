"""Dense row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_rows(df: DataFrame, order_col: str, name: str = "row_no", ranges: int | None = None) -> DataFrame:
    """Add 1, 2, 3, ... in the order of a unique numeric column.

    The values are cut into ranges of similar size at approximate percentiles;
    rows are numbered inside each range, then shifted by the rows before it. Any
    cut gives the same numbers, so the percentiles may be rough, and because the
    cuts are literals a lost task recomputes the same ranges.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    found = df.agg(F.percentile_approx(F.col(order_col).cast("double"), shares).alias("cuts")).first()[0]
    cuts = [float("-inf"), *sorted(set(found or [0.0])), float("inf")]
    to_range = Bucketizer(splits=cuts, inputCol="_order", outputCol="_range")
    placed = to_range.transform(df.withColumn("_order", F.col(order_col).cast("double"))).drop("_order")

    up_to_here = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_rows"))  # one row per range
    before = sizes.select("_range", (F.sum("_rows").over(up_to_here) - F.col("_rows")).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(order_col)
    return (
        placed.join(F.broadcast(before), "_range")
        .withColumn(name, F.col("_before") + F.row_number().over(inside))
        .drop("_range", "_before")
    )


def with_batches(df: DataFrame, order_col: str, batch_size: int) -> DataFrame:
    """Add ``batch_no``: rows in order, ``batch_size`` at a time, from 0."""
    numbered = number_rows(df, order_col, "_no")
    batch = F.floor((F.col("_no") - 1) / batch_size).cast("long")
    return numbered.withColumn("batch_no", batch).drop("_no")
