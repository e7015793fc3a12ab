"""Vectors kept fresh from a stream of changed rows.

The sink is a vector log: every micro-batch writes its rows to a folder of its own
run (a checkpoint) and epoch, so a replayed batch replaces itself and nothing else.
The current vector of a row is that of its latest change, in the order of changes,
not of writing. A change that leaves the text as it was, or blanks it, is logged too, so
that an older one that comes late doesn't count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vicinity.functions.encode import encode
from vicinity.functions.text import text_hash
from vicinity.operators.changes import first_wins
from vicinity.operators.runs import Clock, now, recorded

EVERY_MINUTE = {"processingTime": "1 minute"}
ONCE = {"availableNow": True}
BUCKETS = 16  # divisions of a log by id


def embed_on_write(
    changes: DataFrame, encoder=None, prefix: str = "", text_col: str = "info", time_col: str = "changed_at"
) -> DataFrame:
    """Vector, hash and time for every row as it passes; for batches and streams."""
    return changes.select(
        "*",
        encode(F.col(text_col), encoder, prefix).alias("embedding"),
        text_hash(F.col(text_col)).alias("text_hash"),
        F.col(time_col).alias("embedded_at"),
    )


def open_log(spark: SparkSession, path: str, id_type: str = "long") -> None:
    """Start an empty log, with a file that carries the schema and no rows."""
    schema = f"id {id_type}, text_hash string, embedding array<float>, embedded_at timestamp"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/run=r0/epoch=-1/bucket=-1")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All entries; ``position`` is the change that an entry stands for."""
    return spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)


def current_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The entry of the latest change of each id, whenever it was written; none for an id
    whose latest text is blank."""
    log = read_log(spark, path)
    if "position" in log.columns:
        log = first_wins(log, ["id"], "position", last=True).drop("position")
    return log.filter("text_hash IS NOT NULL").drop("run", "epoch", "bucket")


def compact_log(spark: SparkSession, path: str, new_path: str) -> None:
    """Copy the latest entries, those of blank texts too, to a new log, for a stopped
    stream to go on with."""
    log = read_log(spark, path)
    if "position" in log.columns:
        log = first_wins(log, ["id"], "position", last=True)
    kept = log.drop("run", "epoch")
    kept.write.mode("overwrite").partitionBy("bucket").parquet(f"{new_path}/run=r0/epoch=-1")


def last_write(changes: DataFrame, order: Sequence[str], id_col: str = "id", text_col: str = "info", time_col: str = "changed_at") -> DataFrame:
    """The last change per row, with its ``position`` in the order of changes."""
    position = F.struct(*order)
    last = F.max_by(F.struct(text_col, time_col, position.alias("position")), position).alias("_c")
    return changes.groupBy(id_col).agg(last).select(F.col(id_col).alias("id"), "_c.*")


def append_epoch(
    changes: DataFrame, epoch: int, path: str, order: Sequence[str], encoder=None, prefix: str = "",
    id_col: str = "id", text_col: str = "info", time_col: str = "changed_at", run: str = "r1", buckets: int = BUCKETS,
    runs: str | None = None, job_id: int = 1, clock: Clock = now,
) -> dict[str, int] | None:
    """Embed what is new in a micro-batch and write it as this epoch of a run. With a run
    log (``runs``) the epoch is entered there, with the rows written and embedded as the
    write has counted them, and these are returned.

    A row is written if its change comes after the one in the log. It is embedded if its
    text has another hash; the same text takes the logged vector along, and a blank one
    is written without hash and vector. Epochs of this run from this one on are ignored,
    so a replay sees what the first try saw; other runs' folders are only read. The log
    is divided by a hash of the id, and only the divisions that the batch touches are read.
    """
    spark = changes.sparkSession
    last = last_write(changes, order, id_col, text_col, time_col)
    last = last.withColumn("text_hash", F.when(F.col(text_col) != "", text_hash(F.col(text_col))))
    last = last.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    log = read_log(spark, path)
    needs, logged = F.col("text_hash").isNotNull(), F.lit(None).cast("array<float>")
    if "position" in log.columns:
        touched = [r["bucket"] for r in last.select("bucket").distinct().collect()]  # at most ``buckets``
        replayed = (F.col("run") == run) & (F.col("epoch") >= epoch)
        earlier = log.filter(F.col("bucket").isin(touched) & ~replayed).join(last.select("id"), "id", "left_semi")
        entry = F.struct("position", "text_hash", "embedding")
        known = earlier.groupBy("id").agg(F.max_by(entry, "position").alias("_known"))
        joined = last.join(known, "id", "left")
        last = joined.filter(F.col("_known").isNull() | (F.col("position") > F.col("_known.position")))
        same = F.coalesce(F.col("text_hash") == F.col("_known.text_hash"), F.lit(False))
        needs, logged = needs & ~same, F.when(same, F.col("_known.embedding"))
    # texts that need no vector are NULL to the encoder, which skips them
    vector = encode(F.when(needs, F.col(text_col)), encoder, prefix)
    entries = last.select(
        "id",
        "text_hash",
        F.coalesce(vector, logged).alias("embedding"),
        F.col(time_col).cast("timestamp").alias("embedded_at"),
        "position",
        "bucket",
        needs.alias("_embedded"),
    )

    def write(rows: DataFrame) -> None:
        rows.drop("_embedded").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/run={run}/epoch={epoch}")

    if runs is None:
        return write(entries)
    counts = {"rows": F.count_if(F.col("_embedded")), "written": F.count(F.lit(1))}
    return recorded(entries, write, counts, runs, job_id=job_id, run_id=f"{run}-{epoch}", clock=clock)


def keep_fresh(
    changes: DataFrame, path: str, checkpoint: str, order: Sequence[str], encoder=None, prefix: str = "",
    trigger: Mapping[str, object] = EVERY_MINUTE, **columns,
) -> StreamingQuery:
    """Run ``append_epoch`` on a stream; the checkpoint resumes after a stop."""

    def write(batch: DataFrame, epoch: int) -> None:
        # the stream's id, which its checkpoint keeps, names its epochs; a stream that starts
        # again with an empty checkpoint has another one
        stream = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0]
        run = "r" + hashlib.sha256(stream.encode()).hexdigest()[:12]
        append_epoch(batch, epoch, path, order, encoder, prefix, run=run, **columns)

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
