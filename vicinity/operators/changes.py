"""Table changes as snapshots: dedupe, upsert, ids, update, delete, insert.

A parquet table cannot be changed in place, so every change is a function from
the old snapshot to the new one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinity.functions.text import text_hash
from vicinity.operators.numbering import number_rows
from vicinity.session import materialize

def first_wins(
    df: DataFrame, keys: Sequence[str], order_col: str, copies: str | None = None, last: bool = False
) -> DataFrame:
    """One row per key, the first (or last) by ``order_col``; NULL keys are equal.

    A row without order counts after all others (before, for ``last``), so it stays
    only where its key has no row with one. Of rows that tie any one stays. Every task
    reduces its own rows first: a key that fills most of the table moves one row per
    task. ``copies`` names an optional column with the number of rows of each key.
    """
    known = F.col(order_col).isNotNull()
    rank = F.struct((known if last else ~known).alias("known"), F.col(order_col).alias("at"))
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    winner = (F.max_by if last else F.min_by)(row, rank).alias("_row")
    reduced = df.groupBy(*keys).agg(winner, F.count("*").alias("_copies"))
    count = [F.col("_copies").alias(copies)] if copies else []
    columns = [F.col(f"`{c}`") if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    return reduced.select(*columns, *count)


def _same_key(keys: Sequence[str], left: str = "t", right: str = "s") -> Column:
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def assign_ids(new_rows: DataFrame, existing: DataFrame, order_col: str, id_col: str = "id") -> DataFrame:
    """Ids above all existing ones, in the order of ``order_col``."""
    highest = existing.agg(F.greatest(F.coalesce(F.max(id_col), F.lit(0)), F.lit(0)).alias("m"))
    numbered = number_rows(new_rows, order_col, "_no")
    return numbered.withColumn(id_col, F.col("_no") + highest.scalar().cast("long")).drop("_no")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    order_col: str,
    *,
    text_col: str = "info",
    id_col: str = "id",
    change_col: str | None = None,
) -> DataFrame:
    """Bring ``source`` into ``target`` by natural key; NULL key parts match.

    A match takes over the source's columns and keeps its id. Only a changed
    text moves ``updated_at``; it also clears the vector, so the row is stale
    until it is embedded again. New rows get the next ids in ``order_col``
    order. ``source`` must hold each key once (``first_wins``). ``change_col``
    names an optional column: insert, update or keep.
    """
    payload = [c for c in source.columns if c not in keys and c in target.columns and c != id_col]
    kept = [c for c in target.columns if c not in payload and c not in keys]
    t = target.withColumn("_old", F.lit(True)).alias("t")
    s = source.withColumn("_hit", F.lit(True)).alias("s")
    hit = F.col("s._hit").isNotNull()
    changed = hit & ~F.col(f"t.{text_col}").eqNullSafe(F.col(f"s.{text_col}"))

    def carried(c: str) -> Column:
        old = F.col(f"t.{c}")
        if c == "updated_at":
            return F.when(changed, as_of).otherwise(old)
        if c in ("embedding", "embedded_at"):
            return F.when(~changed, old)
        return old

    # target and source meet once; the rows are written, then the new ones numbered
    old = F.col("t._old").isNotNull()
    met = t.join(s, _same_key(keys), "full").select(
        *[F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in keys],
        *[F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in payload],
        *[carried(c).alias(c) for c in kept],
        *([F.col(f"s.{order_col}").alias("_source_order")]),
        F.when(hit & old, "update").when(hit, "insert").otherwise("keep").alias("_change"),
    )
    met = materialize(met, "merged-rows")
    old_rows = met.filter("_change != 'insert'")
    missing = met.filter("_change = 'insert'")
    fresh = assign_ids(missing.drop(id_col), target, "_source_order", id_col)
    if "updated_at" in target.columns:
        fresh = fresh.withColumn("updated_at", as_of)
    columns = [*target.columns, "_change"]
    fresh = fresh.select(*[c for c in columns if c in fresh.columns])
    merged = old_rows.select(*columns).unionByName(fresh, allowMissingColumns=True)
    return merged.withColumnRenamed("_change", change_col) if change_col else merged.drop("_change")


def load_report(read: DataFrame, usable: Column, merged: DataFrame, change_col: str) -> DataFrame:
    """Counts of a load, one row: read, skipped, duplicates, total, inserted, updated."""
    source = read.agg(F.count("*").alias("read"), F.count_if(~usable).alias("skipped"))
    changes = merged.agg(
        F.count_if(F.col(change_col) == "insert").alias("inserted"),
        F.count_if(F.col(change_col) == "update").alias("updated"),
    )
    inserted = changes.select("inserted").scalar()
    updated = changes.select("updated").scalar()
    total = inserted + updated
    return source.select(
        "read",
        "skipped",
        (F.col("read") - F.col("skipped") - total).alias("duplicates"),
        total.alias("total"),
        inserted.alias("inserted"),
        updated.alias("updated"),
    )


def append_text(df: DataFrame, where: Column, addition: str, text_col: str = "info") -> DataFrame:
    changed = F.concat(F.col(text_col), F.lit(addition))
    return df.withColumn(text_col, F.when(where, changed).otherwise(F.col(text_col)))


def delete_rows(df: DataFrame, where: Column) -> DataFrame:
    """Rows for which ``where`` is not true; unknown (NULL) stays, as in SQL."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def insert_rows(df: DataFrame, new_rows: DataFrame, order_col: str, id_col: str = "id") -> DataFrame:
    fresh = assign_ids(new_rows, df, order_col, id_col)
    fresh = fresh.select(*[c for c in df.columns if c in fresh.columns])
    return df.unionByName(fresh, allowMissingColumns=True)


def write_back(
    df: DataFrame, vectors: DataFrame, as_of: Column, id_col: str = "id", vec_col: str = "embedding"
) -> DataFrame:
    """Take over new vectors by id; rows without a new one keep what they had."""
    new = vectors.select(id_col, F.col(vec_col).alias("_new"))
    joined = df.join(new, id_col, "left")
    given = F.col("_new").isNotNull()
    out = joined.withColumn(vec_col, F.coalesce("_new", vec_col))
    if "embedded_at" in df.columns:
        out = out.withColumn("embedded_at", F.when(given, as_of).otherwise(F.col("embedded_at")))
    if "text_hash" in df.columns and "info" in df.columns:
        fresh = text_hash(F.col("info"))
        out = out.withColumn("text_hash", F.when(given, fresh).otherwise(F.col("text_hash")))
    return out.select(*df.columns)
