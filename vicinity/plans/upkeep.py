"""Freshness, streaming and data-check plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinity.functions.encode import HashedWords
from vicinity.functions.text import text_hash
from vicinity.functions.vectors import dims
from vicinity.operators.changes import append_text, delete_rows, insert_rows, write_back
from vicinity.operators.checks import assertions, checklist, coverage, fingerprint, overview
from vicinity.operators.fresh import (
    is_stale,
    latest_runs,
    log_run,
    percent_done,
    refresh,
    refresh_delta,
    stale,
    stale_batches,
    throughput,
    unnest_batches,
)
from vicinity.operators.snapshots import Snapshots
from vicinity.operators.topk import nearest, row_vector
from vicinity.plans.common import AS_OF, CATALOG, EMBEDDED_AT, STALE, as_of, catalog, cosine
from vicinity.plans.registry import query
from vicinity.session import scratch, spread, table, table_stream
from vicinity.sources import changefeed
from vicinity.streaming.refresh import ONCE, current_vectors, embed_on_write, keep_fresh, open_log

WIDTH = 64  # the stored vectors' size, so that refreshed ones fit beside them


def _encoder() -> HashedWords:
    return HashedWords(WIDTH)


@query(f"WITH {CATALOG} SELECT id, beer_name, brewery, style, embedded_at IS NOT NULL AS dated FROM catalog WHERE {STALE}")
def stale_rows(spark, sf_dir):
    rows = stale(catalog(spark, sf_dir))
    return rows.select("id", "beer_name", "brewery", "style", F.col("embedded_at").isNotNull().alias("dated"))


@query(f"WITH {CATALOG} SELECT count(*) AS rows, count(embedding) AS embedded, count(*) FILTER ({STALE}) AS stale FROM catalog")
def count_embedded_and_stale(spark, sf_dir):
    return overview(catalog(spark, sf_dir))


@query(f"WITH {CATALOG} SELECT count(*) FILTER (n_chars > 3000) AS long_texts, count(*) FILTER (embedding IS NULL) AS unembedded, greatest(coalesce(max(id), 1), 1) AS highest_id FROM catalog")
def count_by_condition(spark, sf_dir):
    return catalog(spark, sf_dir).agg(
        F.count_if(F.col("n_chars") > 3000).alias("long_texts"),
        F.count_if(F.col("embedding").isNull()).alias("unembedded"),
        F.greatest(F.coalesce(F.max("id"), F.lit(1)), F.lit(1)).alias("highest_id"),
    )


_BATCHED = f"""WITH {CATALOG}, s AS (
  SELECT id, info, (row_number() OVER (ORDER BY id) - 1) // 64 AS batch_no FROM catalog WHERE {STALE})"""


@query(f"""{_BATCHED} SELECT batch_no, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids, sha256(string_agg(info, '|' ORDER BY id)) AS infos
FROM s GROUP BY batch_no""")
def batches_of_stale_rows(spark, sf_dir):
    batches = stale_batches(catalog(spark, sf_dir))
    return batches.select(
        "batch_no", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        text_hash(F.array_join("infos", "|")).alias("infos"),
    )


@query(f"""{_BATCHED} SELECT batch_no, row_number() OVER (PARTITION BY batch_no ORDER BY id)::INT AS ord, id, sha256(info) AS value FROM s""")
def batch_members_by_position(spark, sf_dir):
    members = unnest_batches(stale_batches(catalog(spark, sf_dir)), "infos")
    return members.withColumn("value", text_hash(F.col("value")))


@query(f"""WITH {CATALOG} SELECT id, {STALE} AS refreshed, 64 AS dims, CASE WHEN {STALE} OR embedding IS NOT NULL THEN sha256(info) END AS text_hash,
  CASE WHEN {STALE} THEN '{AS_OF}' ELSE '{EMBEDDED_AT}' END AS embedded_at FROM catalog""")
def refresh_stale_rows(spark, sf_dir):
    rows = refresh(spread(catalog(spark, sf_dir)), as_of(), _encoder())
    moment = F.date_format("embedded_at", "yyyy-MM-dd HH:mm:ss")
    return rows.select(
        "id", (F.col("embedded_at") == as_of()).alias("refreshed"), dims(F.col("embedding")).alias("dims"),
        "text_hash", moment.alias("embedded_at"),
    )


@query(f"WITH {CATALOG} SELECT count(*) FILTER ({STALE}) AS first_run, 0::BIGINT AS second_run, count(*) AS embedded FROM catalog")
def refresh_again_finds_nothing(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    once = refresh(rows, as_of(), _encoder())
    second = once.agg(F.count_if(is_stale()).alias("n"), F.count("embedding").alias("e"))
    first = rows.agg(F.count_if(is_stale()).alias("first_run"))
    return first.select(
        "first_run", second.select("n").scalar().alias("second_run"), second.select("e").scalar().alias("embedded")
    )


@query(f"""WITH {CATALOG} SELECT id, len(embedding) IS NOT NULL OR {STALE} AS has_vector, {STALE} AS new,
  CASE WHEN {STALE} THEN sha256(info) ELSE text_hash END AS text_hash FROM catalog""")
def write_back_vectors(spark, sf_dir):
    """Only stale rows are embedded, then joined into the table by id."""
    rows = catalog(spark, sf_dir)
    after = write_back(rows, refresh_delta(rows, as_of(), _encoder()), as_of())
    new = F.coalesce(F.col("embedded_at") == as_of(), F.lit(False))
    return after.select("id", F.col("embedding").isNotNull().alias("has_vector"), new.alias("new"), "text_hash")


@query("SELECT doc_id AS id, sha256(text) AS text_hash, 384 AS dims, true AS dated FROM documents")
def embed_rows_on_write(spark, sf_dir):
    """A stream of inserts, each row written with its vector."""
    stream = table_stream(spark, sf_dir, "documents")
    rows = stream.select(F.col("doc_id").alias("id"), F.col("text").alias("info"), as_of().alias("changed_at"))
    path = scratch(spark, "written")
    written = embed_on_write(rows).drop("info", "changed_at").writeStream.format("parquet")
    written = written.option("path", path).option("checkpointLocation", scratch(spark, "progress"))
    written.trigger(**ONCE).start().awaitTermination()
    stored = spark.read.parquet(path)
    return stored.select(
        "id", "text_hash", dims(F.col("embedding")).alias("dims"), F.col("embedded_at").isNotNull().alias("dated")
    )


@query("""WITH c AS (SELECT user_id AS id, event_type || ' ' || props AS info, ts,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT id, sha256(info) AS text_hash, 64 AS dims, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS changed FROM c WHERE rn = 1""")
def keep_vectors_fresh_from_feed(spark, sf_dir):
    """A change feed, last write per row, swept into the vector log."""
    feed = table_stream(spark, sf_dir, "events")
    changes = feed.select(
        F.col("user_id").alias("id"), F.concat_ws(" ", "event_type", "props").alias("info"),
        F.col("ts").cast("timestamp").alias("changed_at"), "event_id",
    )
    path = scratch(spark, "vector-log")
    open_log(spark, path)
    job = keep_fresh(
        changes, path, scratch(spark, "progress"), ["changed_at", "event_id"], _encoder(), trigger=ONCE
    )
    job.awaitTermination()
    now = current_vectors(spark, path)
    return now.select(
        "id", "text_hash", dims(F.col("embedding")).alias("dims"), F.date_format("embedded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("changed")
    )


@query("""WITH c AS (SELECT user_id AS id, event_type || ' ' || props AS info, ts,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT id, sha256(info) AS text_hash, 64 AS dims, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS changed FROM c WHERE rn = 1""")
def keep_vectors_fresh_over_epochs(spark, sf_dir):
    """The same feed in several files, one per epoch, its changes out of order."""
    events, source = table(spark, sf_dir, "events"), scratch(spark, "feed")
    events.repartition(4, "event_id").write.parquet(source)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    changes = feed.select(
        F.col("user_id").alias("id"), F.concat_ws(" ", "event_type", "props").alias("info"),
        F.col("ts").cast("timestamp").alias("changed_at"), "event_id",
    )
    path = scratch(spark, "vector-log")
    open_log(spark, path)
    keep_fresh(
        changes, path, scratch(spark, "progress"), ["changed_at", "event_id"], _encoder(), trigger=ONCE
    ).awaitTermination()
    now = current_vectors(spark, path)
    return now.select(
        "id", "text_hash", dims(F.col("embedding")).alias("dims"), F.date_format("embedded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("changed")
    )


@query("""WITH jobs AS (SELECT event_type AS job, row_number() OVER (ORDER BY event_type) AS job_id FROM (SELECT DISTINCT event_type FROM events))
SELECT event_id AS run_id, job, CASE WHEN value < 10 THEN 'failed' ELSE 'succeeded' END AS status
FROM events JOIN jobs ON job = event_type ORDER BY ts DESC, event_id DESC LIMIT 3""")
def last_job_runs(spark, sf_dir):
    log, jobs = _runs(spark, sf_dir)
    return latest_runs(log, jobs).select("run_id", "job", "status")


def _runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Events as a run log: one job per event type."""
    events = table(spark, sf_dir, "events")
    kinds = events.select(F.col("event_type").alias("job")).distinct()
    # A handful of jobs: the list is one small array on one row.
    names = kinds.agg(F.array_sort(F.collect_list("job")).alias("names"))
    jobs = names.select(F.posexplode("names").alias("pos", "job")).select((F.col("pos") + 1).alias("job_id"), "job")
    started = F.col("ts").cast("timestamp")
    runs = events.join(F.broadcast(jobs), F.col("event_type") == F.col("job")).select(
        F.col("event_id").alias("run_id"), "job_id",
        F.when(F.col("value") < 10, "failed").otherwise("succeeded").alias("status"),
        F.floor("value").cast("long").alias("rows"), started.alias("started"),
        (started + F.make_dt_interval(secs=F.floor("value") % 7 + 1)).alias("ended"),
    )
    ok = runs.filter(F.col("status") == "succeeded")
    return log_run(ok, runs.filter(F.col("status") != "succeeded")), jobs


@query("""WITH r AS (SELECT floor(value)::BIGINT AS rows, floor(value)::BIGINT % 7 + 1 AS secs FROM events)
SELECT sum(rows)::BIGINT AS rows, sum(secs)::BIGINT AS seconds, sum(rows) * 300 >= sum(secs) * 3300 AS met FROM r""")
def throughput_of_runs(spark, sf_dir):
    return throughput(_runs(spark, sf_dir)[0])


@query(f"WITH {CATALOG} SELECT count(embedding) AS embedded, count(*) AS total, (count(embedding) * 100 // count(*))::BIGINT AS percent FROM catalog")
def percent_embedded(spark, sf_dir):
    return percent_done(catalog(spark, sf_dir))


@query(f"WITH {CATALOG} SELECT count(*) AS total, count(embedding) AS embedded, count(*) > 0 AND count(*) = count(embedding) AS complete FROM catalog")
def coverage_of_vectors(spark, sf_dir):
    return coverage(catalog(spark, sf_dir))


@query(f"""WITH {CATALOG}, f AS (SELECT count(*) AS n, count(*) FILTER (embedding IS NULL) AS m, count(*) FILTER ({STALE}) AS s,
  min(len(embedding)) AS lo, max(len(embedding)) AS hi, max(id) AS top FROM catalog)
SELECT item, CASE WHEN ok THEN 'OK' ELSE 'MISSING' END AS status FROM (
  SELECT 'rows loaded' AS item, n > 0 AS ok FROM f UNION ALL SELECT 'all rows embedded', m = 0 FROM f
  UNION ALL SELECT 'nothing stale', s = 0 FROM f UNION ALL SELECT 'vector size', lo = 64 AND hi = 64 FROM f
  UNION ALL SELECT 'ids cover rows', top >= n - 1 FROM f
  UNION ALL SELECT 'has labels', EXISTS (SELECT 1 FROM labels) FROM f)""")
def readiness_checklist(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").agg(F.count("*").alias("n")).scalar()
    size = dims(F.col("embedding"))
    return checklist(
        catalog(spark, sf_dir),
        {
            "rows loaded": F.count("*") > 0,
            "all rows embedded": F.count_if(F.col("embedding").isNull()) == 0,
            "nothing stale": F.count_if(is_stale()) == 0,
            "vector size": (F.min(size) == WIDTH) & (F.max(size) == WIDTH),
            "ids cover rows": F.max("id") >= F.count("*") - 1,
            "has labels": labels > 0,
        },
    )


@query(f"""WITH {CATALOG}, f AS (SELECT count(*) FILTER (embedding IS NULL) AS m, count(*) FILTER ({STALE}) AS s,
  any_value(beer_name) FILTER (id = 3) AS name FROM catalog),
h AS (SELECT count(*) AS n, count(*) FILTER (id = 3) AS self FROM (
  SELECT e.vec_id AS id FROM embeddings e, (SELECT embedding AS v FROM embeddings WHERE vec_id = 3) q
  WHERE e.vec_id <> 3 ORDER BY {cosine('e.embedding', 'q.v')}, e.vec_id LIMIT 5))
SELECT 'no row without a vector' AS name, '0' AS expected, m::VARCHAR AS actual, m = 0 AS ok FROM f
UNION ALL SELECT 'no stale row', '0', s::VARCHAR, s = 0 FROM f
UNION ALL SELECT 'known row has its name', 'doc-3', f.name, f.name = 'doc-3' FROM f
UNION ALL SELECT 'search returns five rows', '5', n::VARCHAR, n = 5 FROM h
UNION ALL SELECT 'search leaves out the row itself', '0', self::VARCHAR, self = 0 FROM h""")
def acceptance_assertions(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    facts = assertions(
        rows,
        {
            "no row without a vector": (F.count_if(F.col("embedding").isNull()), 0),
            "no stale row": (F.count_if(is_stale()), 0),
            "known row has its name": (F.max(F.when(F.col("id") == 3, F.col("beer_name"))), "doc-3"),
        },
    )
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    hits = nearest(vectors, row_vector(vectors, 3), 5, where=F.col("id") != 3)
    found = assertions(
        hits,
        {
            "search returns five rows": (F.count("*"), 5),
            "search leaves out the row itself": (F.count_if(F.col("id") == 3), 0),
        },
    )
    return facts.unionByName(found)


@query(f"WITH {CATALOG} SELECT count(*) AS rows, true AS same FROM catalog")
def state_restored_after_changes(spark, sf_dir):
    """Insert, edit, delete again: rows and texts are as before."""
    rows = catalog(spark, sf_dir).select("id", "beer_name", "info")
    new = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("file_row"), F.lit("visitor").alias("beer_name"), F.col("text").alias("info")
    )
    visiting = F.col("beer_name") == "visitor"
    edited = append_text(insert_rows(rows, new, "file_row"), visiting, " More.")
    restored = delete_rows(edited, visiting)
    columns = ["id", "beer_name", "info"]
    before, after = fingerprint(rows, columns), fingerprint(restored, columns)
    return before.select(
        "rows",
        ((F.col("rows") == after.select("rows").scalar()) & (F.col("hash") == after.select("hash").scalar())).alias("same"),
    )


@query("""SELECT d.doc_id AS id, 'labelled' AS side FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL SELECT d.doc_id, 'unlabelled' FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def rows_with_and_without_match(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    has = documents.join(labels, "id", "left_semi").withColumn("side", F.lit("labelled"))
    has_not = documents.join(labels, "id", "left_anti").withColumn("side", F.lit("unlabelled"))
    return has.unionByName(has_not)


@query(f"WITH {CATALOG} SELECT id, beer_name FROM catalog WHERE embedded_at IS NOT NULL ORDER BY embedded_at DESC, id DESC LIMIT 5")
def last_embedded_rows(spark, sf_dir):
    rows = catalog(spark, sf_dir).filter(F.col("embedded_at").isNotNull())
    return rows.orderBy(F.desc("embedded_at"), F.desc("id")).limit(5).select("id", "beer_name")


def _divided(spark, sf_dir) -> Snapshots:
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("info"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price")
    )
    return Snapshots.create(rows, scratch(spark, "divided"), divisions=32)


def _three_changes(spark, sf_dir) -> Snapshots:
    """Rows replaced and inserted, a text appended to, rows deleted."""
    divided = _divided(spark, sf_dir)
    rows = divided.read()
    new = rows.filter("id <= 5").withColumn("price", F.col("price") * 2)
    more = rows.filter("id <= 3").withColumn("id", F.col("id") + 1_000_000)
    divided = divided.change(new.unionByName(more))
    divided = divided.update(F.col("id") == 7, {"info": F.concat("info", F.lit(", aged in oak"))})
    return divided.delete(F.col("id").between(11, 14))


_PARTS_CHANGED = """p AS (SELECT p_partkey AS id, p_name AS info, p_size AS size, p_retailprice AS price FROM part),
now AS (
  SELECT id, CASE WHEN id = 7 THEN info || ', aged in oak' ELSE info END AS info, size, CASE WHEN id <= 5 THEN price * 2 ELSE price END AS price
  FROM p WHERE id NOT BETWEEN 11 AND 14
  UNION ALL SELECT id + 1000000, info, size, price FROM p WHERE id <= 3)"""


@query(f"WITH {_PARTS_CHANGED} SELECT * FROM now")
def table_after_divided_changes(spark, sf_dir):
    """Each change rewrites only the divisions it touches."""
    return _three_changes(spark, sf_dir).read()


_FEED = f"""WITH {_PARTS_CHANGED}
SELECT CASE WHEN p.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'delete' ELSE 'update' END AS change,
       coalesce(n.id, p.id) AS id, coalesce(n.info, p.info) AS info, coalesce(n.size, p.size) AS size, coalesce(n.price, p.price) AS price
FROM p FULL JOIN now n ON n.id = p.id WHERE (p.info, p.size, p.price) IS DISTINCT FROM (n.info, n.size, n.price)"""


@query(_FEED)
def changes_between_versions(spark, sf_dir):
    """A change feed out of two versions, which skips divisions that are the same."""
    return _three_changes(spark, sf_dir).changes(since=1)


@query(_FEED)
def changes_as_a_stream(spark, sf_dir):
    """The same changes, followed version by version by a stream."""
    divided = _three_changes(spark, sf_dir)
    changefeed.register(spark)
    stream = spark.readStream.format("snapshot_changes").option("path", divided.path).option("since", 1).load()
    out = scratch(spark, "changes")
    job = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "progress")).start()
    job.processAllAvailable()
    job.stop()
    return spark.read.schema(stream.schema).parquet(out)
