"""Runs that report and record themselves.

What a run has done is counted by ``observe`` on the rows it writes, in the same pass,
and appended to a run log: a folder with a small table per run, named by job and run, so
that a repeated run replaces its own entry. A run that fails is logged as failed and its
error is raised again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vicinity.operators.fresh import is_stale, refresh

Clock = Callable[[], datetime]

LOG = "run_id string, status string, rows long, counts map<string, long>, started timestamp, ended timestamp"


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def append_run(spark: SparkSession, log: str, job_id: int, run_id: str, entry: tuple) -> None:
    one = spark.createDataFrame([(run_id, *entry)], LOG).coalesce(1)
    one.write.mode("overwrite").parquet(f"{log}/job_id={job_id}/run={run_id}")


def read_runs(spark: SparkSession, log: str) -> DataFrame:
    """run_id, job_id, status, rows, counts, started, ended of every run."""
    rows = spark.read.schema(f"{LOG}, job_id int, run string").option("basePath", log).parquet(log)
    return rows.select("run_id", "job_id", "status", "rows", "counts", "started", "ended")


def recorded(
    df: DataFrame, write: Callable[[DataFrame], object], counts: Mapping[str, Column], log: str, *, job_id: int = 1,
    run_id: str | None = None, rows: str = "rows", clock: Clock = now,
) -> dict[str, int]:
    """Write a table, count it on the way and log the run: the ``counts``. ``rows`` names
    the one that is the run's number of rows. ``write`` must run exactly one action."""
    spark, run_id, started = df.sparkSession, run_id or uuid.uuid4().hex, clock()
    seen = Observation(f"run-{uuid.uuid4().hex}")
    try:
        write(df.observe(seen, *[c.cast("long").alias(name) for name, c in counts.items()]))
        found = {name: int(n or 0) for name, n in seen.get.items()}
    except Exception:
        append_run(spark, log, job_id, run_id, ("failed", None, None, started, clock()))
        raise
    append_run(spark, log, job_id, run_id, ("succeeded", found[rows], found, started, clock()))
    return found


def refresh_table(
    df: DataFrame, target: str, as_of: Column, log: str, encoder=None, prefix: str = "", **run,
) -> int:
    """Write the next snapshot of a table to ``target`` and log the run; returns how many
    rows were embedded. A second run over the result embeds none."""
    flag = "_embedded"
    marked = df.withColumn(flag, F.coalesce(is_stale(), F.lit(False)))
    snapshot = refresh(marked, as_of, encoder, prefix)
    counts = {"rows": F.count_if(F.col(flag)), "total": F.count(F.lit(1)), "with_vector": F.count("embedding")}

    def write(observed: DataFrame) -> None:
        observed.drop(flag).write.mode("overwrite").parquet(target)

    return recorded(snapshot, write, counts, log, **run)["rows"]
