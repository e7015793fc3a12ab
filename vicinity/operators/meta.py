"""Key/value provenance and name aliases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_SIDE_ROWS = 100_000  # alias rows that may be sent to every task
SMALL_SIDE_BYTES = 32 << 20  # and their text


def merge_meta(entries: DataFrame, order: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    """The last value written for each key; earlier ones never leave their task."""
    return entries.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def update_meta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries of ``new`` over those of ``old`` (columns key, value)."""
    entries = old.select("key", "value", F.lit(0).alias("_turn")).unionByName(
        new.select("key", "value", F.lit(1).alias("_turn"))
    )
    return merge_meta(entries, ["_turn"])


def load_meta(spark: SparkSession, facts: Mapping[str, str], rows: DataFrame, as_of: str) -> DataFrame:
    """Provenance of one load: given facts, its time, and its row count."""
    fixed = spark.createDataFrame(
        [*facts.items(), ("load_timestamp", as_of)], "key string, value string"
    )
    counted = rows.agg(F.count("*").cast("string").alias("value"))
    return fixed.unionByName(counted.select(F.lit("row_count").alias("key"), "value"))


def prefixed(info: DataFrame, prefix: str = "embedding_") -> DataFrame:
    """Model settings (setting, value) as provenance entries."""
    return info.select(F.concat(F.lit(prefix), F.col("setting")).alias("key"), "value")


def resolve_alias(
    df: DataFrame, name: Column, aliases: DataFrame, alias_col: str, match_col: str, out: str, small_rows: int = SMALL_SIDE_ROWS
) -> DataFrame:
    """Canonical name where the alias list has one, else the name itself.

    The list goes to every task while it is small; a longer one is joined by
    shuffle, where adaptive execution splits names that are very frequent.
    """
    pairs = aliases.select(F.col(alias_col).alias("_alias"), F.col(match_col).alias("_match"))
    pairs = pairs.groupBy("_alias").agg(F.min("_match").alias("_match"))
    text = F.octet_length("_alias") + F.coalesce(F.octet_length("_match"), F.lit(0))
    rows, size = pairs.limit(small_rows + 1).agg(F.count("*"), F.coalesce(F.sum(text), F.lit(0))).first()
    if rows <= small_rows and size <= SMALL_SIDE_BYTES:
        pairs = F.broadcast(pairs)
    joined = df.join(pairs, name == F.col("_alias"), "left")
    return joined.withColumn(out, F.coalesce("_match", name)).drop("_alias", "_match")
