"""Plans of runs that report and record themselves."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vicinity.functions.encode import HashedWords
from vicinity.functions.vectors import rounded
from vicinity.operators.fresh import throughput
from vicinity.operators.runs import read_runs, refresh_table
from vicinity.plans.common import CATALOG, STALE, as_of, catalog, words
from vicinity.plans.ingest import _FEED, _FIRST, _USABLE, _catalog_file
from vicinity.plans.registry import query
from vicinity.session import materialize, scratch, table
from vicinity.sources.catalog import empty_catalog, load_and_record, read_meta
from vicinity.streaming.refresh import ONCE, keep_fresh, open_log

START = datetime(2024, 6, 1, 12)


def _clock():
    """Times a minute apart, so that results repeat."""
    ticks = iter(range(1000))
    return lambda: START + timedelta(minutes=next(ticks))


def _two_refreshes(spark, sf_dir):
    rows = materialize(catalog(spark, sf_dir), "catalog")
    log, first, second, clock = (scratch(spark, "runs"), scratch(spark, "first"), scratch(spark, "second"), _clock())
    way = {"encoder": HashedWords(64), "job_id": 7, "clock": clock}
    embedded = refresh_table(rows, first, as_of(), log, run_id="first", **way)
    again = refresh_table(spark.read.parquet(first), second, as_of(), log, run_id="second", **way)
    return spark.read.parquet(second), log, embedded, again


@query(f"""WITH {CATALOG}, n AS (SELECT count(*) AS total, count(*) FILTER ({STALE}) AS stale,
  count(*) FILTER ({STALE} OR embedding IS NOT NULL) AS with_vector FROM catalog)
SELECT 'first' AS run_id, 7 AS job_id, 'succeeded' AS status, stale AS rows, stale AS returned, total, with_vector, 60::BIGINT AS seconds FROM n
UNION ALL SELECT 'second', 7, 'succeeded', 0, 0, total, with_vector, 60 FROM n""")
def refresh_runs_report_themselves(spark, sf_dir):
    """A refresh returns and logs what it embedded; the next one finds nothing to do."""
    _, log, embedded, again = _two_refreshes(spark, sf_dir)
    returned = F.when(F.col("run_id") == "first", F.lit(embedded)).otherwise(F.lit(again)).cast("long")
    return read_runs(spark, log).select(
        "run_id", "job_id", "status", "rows", returned.alias("returned"),
        F.col("counts")["total"].alias("total"), F.col("counts")["with_vector"].alias("with_vector"),
        (F.unix_seconds("ended") - F.unix_seconds("started")).alias("seconds"),
    )


@query(f"""WITH {CATALOG}, s AS (SELECT id, info FROM catalog WHERE {STALE}), {words('s', 'doc').replace('% 384', '% 64')},
fresh AS (SELECT doc.id, sum((c / norm)::FLOAT::DOUBLE) AS total FROM doc JOIN doc_norm USING (id) GROUP BY doc.id)
SELECT c.id, round(CASE WHEN {STALE} THEN coalesce(f.total, 0.0) ELSE list_sum(embedding::DOUBLE[]) END, 4) + 0.0 AS total
FROM catalog c LEFT JOIN fresh f ON f.id = c.id""")
def vectors_after_recorded_refresh(spark, sf_dir):
    """The vectors themselves: new ones where the text was stale, the old ones elsewhere."""
    rows = _two_refreshes(spark, sf_dir)[0]
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rows.select("id", rounded(total, 4).alias("total"))


@query("""WITH r AS (SELECT count(DISTINCT user_id) AS n FROM events)
SELECT 1::BIGINT AS runs, n AS rows, n AS written, 60::BIGINT AS seconds, n * 300 >= 60 * 3300 AS met FROM r""")
def sweep_runs_report_themselves(spark, sf_dir):
    """A sweep logs each of its epochs; the throughput check reads that log."""
    schema = table(spark, sf_dir, "events").schema
    feed = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    changes = feed.select(
        F.col("user_id").alias("id"), F.concat_ws(" ", "event_type", "props").alias("info"),
        F.col("ts").cast("timestamp").alias("changed_at"), "event_id",
    )
    path, log = scratch(spark, "vector-log"), scratch(spark, "runs")
    open_log(spark, path)
    keep_fresh(
        changes, path, scratch(spark, "progress"), ["changed_at", "event_id"], HashedWords(64), trigger=ONCE, runs=log, clock=_clock()
    ).awaitTermination()
    runs = read_runs(spark, log)
    sums = runs.agg(F.count("*").alias("runs"), F.sum(F.col("counts")["written"]).alias("written"))
    return throughput(runs).crossJoin(F.broadcast(sums)).select("runs", "rows", "written", "seconds", "met")


@query(f"""WITH {_FEED}, {_USABLE}, {_FIRST}, n AS (SELECT count(*)::VARCHAR AS n FROM firsts)
SELECT 'source' AS key, 'feed' AS value UNION ALL SELECT 'license', 'ODbL' UNION ALL SELECT 'version', '2'
UNION ALL SELECT 'load_timestamp', '2024-06-02 12:00:00' UNION ALL SELECT 'row_count', n FROM n""")
def provenance_of_recorded_loads(spark, sf_dir):
    """Two loads of a file: the second changes nothing, and its facts replace the first's."""
    path, meta, log = _catalog_file(spark, sf_dir), scratch(spark, "meta"), scratch(spark, "runs")
    first, second = scratch(spark, "first"), scratch(spark, "second")
    load_and_record(spark, path, empty_catalog(spark), "2024-06-01 12:00:00", first, meta, log, {"source": "feed", "license": "ODbL", "version": "1"})
    target = spark.read.parquet(first)
    load_and_record(spark, path, target, "2024-06-02 12:00:00", second, meta, log, {"version": "2"})
    return read_meta(spark, meta)
