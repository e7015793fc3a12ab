"""Keeping vectors in step with text: stale rows, refresh, batches, run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinity.functions.encode import DEFAULT_BATCH, encode
from vicinity.functions.text import text_hash
from vicinity.operators.numbering import with_batches
from vicinity.session import materialize


def is_stale() -> Column:
    """Has text, and no vector, no time, or a hash that is not the text's."""
    outdated = ~F.col("text_hash").eqNullSafe(text_hash(F.col("info")))
    return (F.col("info") != "") & (
        F.col("embedding").isNull() | F.col("embedded_at").isNull() | outdated
    )


def stale(df: DataFrame) -> DataFrame:
    return df.filter(is_stale())


def refresh(df: DataFrame, as_of: Column, encoder=None, prefix: str = "") -> DataFrame:
    """The next snapshot: stale rows embedded, all others as they were.

    One narrow pass: only the text of stale rows reaches the encoder (the rest
    is NULL and skipped there), so nothing is joined back and nothing shuffles.
    """
    needs = F.coalesce(is_stale(), F.lit(False))
    marked = df.withColumn("_needs", needs)
    vector = encode(F.when(F.col("_needs"), F.col("info")), encoder, prefix)
    done = marked.withColumn("_vector", vector)
    take = F.col("_needs")
    return done.select(
        *[
            {
                "embedding": F.when(take, F.col("_vector")).otherwise(F.col("embedding")),
                "text_hash": F.when(take, text_hash(F.col("info"))).otherwise(F.col("text_hash")),
                "embedded_at": F.when(take, as_of).otherwise(F.col("embedded_at")),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in df.columns
        ]
    )


def refresh_delta(df: DataFrame, as_of: Column, encoder=None, prefix: str = "", id_col: str = "id") -> DataFrame:
    """Only the refreshed rows (id, embedding, text_hash, embedded_at), for a log."""
    return stale(df).select(
        id_col,
        encode(F.col("info"), encoder, prefix).alias("embedding"),
        text_hash(F.col("info")).alias("text_hash"),
        as_of.alias("embedded_at"),
    )


def clear_vectors(df: DataFrame) -> DataFrame:
    """Forget all vectors, so that a refresh embeds every row again."""
    return df.withColumn("embedding", F.lit(None).cast(df.schema["embedding"].dataType)).withColumn(
        "embedded_at", F.lit(None).cast(df.schema["embedded_at"].dataType)
    )


def stale_batches(df: DataFrame, batch_size: int = DEFAULT_BATCH, id_col: str = "id") -> DataFrame:
    """Stale rows in id order as arrays of ``batch_size``: batch_no, ids, infos."""
    # Numbering reads the rows three times; the hashes are worked out once.
    waiting = materialize(stale(df).select(id_col, "info"), "stale-rows")
    pending = with_batches(waiting, id_col, batch_size)
    rows = F.array_sort(F.collect_list(F.struct(id_col, "info")))  # at most batch_size entries
    return pending.groupBy("batch_no").agg(rows.alias("rows")).select(
        "batch_no", F.col(f"rows.{id_col}").alias("ids"), F.col("rows.info").alias("infos")
    )


def unnest_batches(batches: DataFrame, values: str, id_col: str = "id") -> DataFrame:
    """Ids of each batch with the value at the same position (from 1)."""
    spread = batches.select("batch_no", values, F.posexplode("ids").alias("pos", id_col))
    return spread.select(
        "batch_no",
        (F.col("pos") + 1).alias("ord"),
        id_col,
        F.get(values, F.col("pos")).alias("value"),
    )


def log_run(log: DataFrame | None, run: DataFrame) -> DataFrame:
    """Append a run (run_id, job_id, status, rows, started, ended)."""
    return run if log is None else log.unionByName(run)


def latest_runs(log: DataFrame, jobs: DataFrame, n: int = 3) -> DataFrame:
    """The last ``n`` runs with their job's name, newest first."""
    return log.join(jobs, "job_id").orderBy(F.desc("started"), F.desc("run_id")).limit(n)


def throughput(log: DataFrame, floor_rows: int = 3300, floor_seconds: int = 300) -> DataFrame:
    """Rows and seconds of all runs against a floor, in whole-number arithmetic."""
    seconds = F.sum(F.unix_seconds("ended") - F.unix_seconds("started"))
    total = log.agg(F.sum("rows").alias("rows"), seconds.alias("seconds"))
    met = F.col("rows") * floor_seconds >= F.col("seconds") * floor_rows
    return total.withColumn("met", met)


def percent_done(df: DataFrame) -> DataFrame:
    counted = df.agg(F.count("embedding").alias("embedded"), F.count("*").alias("total"))
    whole = F.floor(F.try_divide(F.col("embedded") * 100, F.col("total"))).cast("long")
    return counted.withColumn("percent", whole)
