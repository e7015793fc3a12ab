"""Result sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_json_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One JSON object per row; NULL fields are kept, non-ASCII stays readable."""
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(body.alias("json"))


def to_json_array(hits: DataFrame, columns: Sequence[str], id_col: str = "id") -> DataFrame:
    """A ranked result as one JSON array, nearest first; for top-n reports."""
    entry = F.struct(
        F.col("distance").alias("_d"), F.col(id_col).alias("_i"), F.struct(*columns).alias("row")
    )
    rows = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["row"])
    return hits.agg(F.to_json(rows, {"ignoreNullFields": "false"}).alias("json"))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
