"""Data checks as one-pass aggregations with one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinity.functions.encode import encode
from vicinity.functions.vectors import distance_between
from vicinity.operators.fresh import is_stale


def overview(df: DataFrame) -> DataFrame:
    """Rows, embedded rows and stale rows in one pass."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count("embedding").alias("embedded"),
        F.count_if(is_stale()).alias("stale"),
    )


def checklist(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Named boolean aggregates as rows: item, status OK or MISSING."""
    names = list(checks)
    facts = df.agg(*[F.coalesce(checks[n], F.lit(False)).alias(f"c{i}") for i, n in enumerate(names)])
    rows = [
        F.struct(
            F.lit(n).alias("item"),
            F.when(F.col(f"c{i}"), "OK").otherwise("MISSING").alias("status"),
        )
        for i, n in enumerate(names)
    ]
    return facts.select(F.inline(F.array(*rows)))


def assertions(df: DataFrame, expected: Mapping[str, tuple[Column, object]]) -> DataFrame:
    """Named aggregates against expected values: name, expected, actual, ok."""
    names = list(expected)
    facts = df.agg(*[expected[n][0].cast("string").alias(f"c{i}") for i, n in enumerate(names)])
    rows = [
        F.struct(
            F.lit(n).alias("name"),
            F.lit(str(expected[n][1])).alias("expected"),
            F.col(f"c{i}").alias("actual"),
            F.col(f"c{i}").eqNullSafe(F.lit(str(expected[n][1]))).alias("ok"),
        )
        for i, n in enumerate(names)
    ]
    return facts.select(F.inline(F.array(*rows)))


def coverage(df: DataFrame) -> DataFrame:
    counts = df.agg(F.count("*").alias("total"), F.count("embedding").alias("embedded"))
    complete = (F.col("total") > 0) & (F.col("total") == F.col("embedded"))
    return counts.withColumn("complete", complete)


def triplets(
    df: DataFrame, anchor: str = "anchor", related: str = "related", unrelated: str = "unrelated", encoder=None
) -> DataFrame:
    """Is the anchor text nearer to the related than to the unrelated text?"""
    vectors = df
    for c in (anchor, related, unrelated):
        vectors = vectors.withColumn(f"_{c}", encode(F.col(c), encoder))
    near = distance_between(F.col(f"_{anchor}"), F.col(f"_{related}"))
    far = distance_between(F.col(f"_{anchor}"), F.col(f"_{unrelated}"))
    measured = vectors.withColumn("d_related", near).withColumn("d_unrelated", far)
    return measured.withColumn("ok", F.col("d_related") < F.col("d_unrelated")).drop(
        f"_{anchor}", f"_{related}", f"_{unrelated}"
    )


def keyword_precision(hits: DataFrame, text_col: str, pattern: str, groups: Sequence[str] = ()) -> DataFrame:
    """Share of hits whose text matches the pattern, per group of hits."""
    matching = F.count_if(F.col(text_col).rlike(pattern))
    counted = hits.groupBy(*groups).agg(F.count("*").alias("hits"), matching.alias("matching"))
    return counted.withColumn("precision", F.try_divide("matching", "hits"))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and an order-free hash of the columns, to compare snapshots."""
    row = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.sum(row).cast("string").alias("hash"))
