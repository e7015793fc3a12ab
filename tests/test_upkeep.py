import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vicinity.operators.checks import assertions, checklist, coverage, keyword_precision, overview, triplets
from vicinity.operators.fresh import (
    clear_vectors,
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
from vicinity.session import scratch
from vicinity.streaming.refresh import ONCE, compact_log, current_vectors, embed_on_write, keep_fresh, open_log

SCHEMA = "id long, info string, text_hash string, embedding array<float>, embedded_at timestamp"


def now():
    return F.lit("2024-03-01").cast("timestamp")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


class Counting:
    """Encoder that leaves a line per text it was given."""

    width = 2
    chunk = 2

    def __init__(self, path):
        self.path = str(path)

    def encode(self, texts):
        texts = texts if isinstance(texts, list) else texts.to_pylist()
        with open(self.path, "a") as out:
            out.writelines(f"{t}\n" for t in texts)
        return np.array([[len(t), 1.0] for t in texts], "float32")

    def info(self):
        return [("model", "counting")]


@pytest.fixture
def rows(spark):
    import datetime

    t = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [
            (1, "done", sha("done"), [1.0, 0.0], t),
            (2, "new", None, None, None),
            (3, "edited", sha("before"), [1.0, 0.0], t),
            (4, "", None, None, None),
            (5, None, None, None, None),
            (6, "undated", sha("undated"), [1.0, 0.0], None),
            (7, "unhashed", None, [1.0, 0.0], t),
        ],
        SCHEMA,
    )


def test_stale_rows(rows):
    assert sorted(r.id for r in stale(rows).collect()) == [2, 3, 6, 7]


def test_refresh_embeds_stale_rows_only_and_then_none(rows, tmp_path):
    model = Counting(tmp_path / "calls")
    once = refresh(rows, now(), model).cache()
    got = {r.id: r for r in once.collect()}
    calls = (tmp_path / "calls").read_text().split()
    assert sorted(calls) == ["edited", "new", "undated", "unhashed"]
    assert got[1].embedding == [1.0, 0.0] and got[1].embedded_at.month == 1
    assert got[2].embedding == [3.0, 1.0] and got[2].text_hash == sha("new") and got[2].embedded_at.month == 3
    assert got[4].embedding is None and got[5].embedding is None
    refresh(once, now(), model).collect()
    assert len((tmp_path / "calls").read_text().split()) == len(calls)
    assert stale(once).count() == 0


def test_delta_has_the_stale_rows_only(rows, tmp_path):
    got = {r.id: r.embedding for r in refresh_delta(rows, now(), Counting(tmp_path / "c")).collect()}
    assert got == {2: [3.0, 1.0], 3: [6.0, 1.0], 6: [7.0, 1.0], 7: [8.0, 1.0]}


def test_clearing_makes_every_row_with_text_stale(rows):
    cleared = clear_vectors(rows)
    assert sorted(r.id for r in stale(cleared).collect()) == [1, 2, 3, 6, 7]
    assert cleared.schema == rows.schema


def test_batches_and_positions(rows):
    batches = stale_batches(rows, 3)
    assert [(r.batch_no, r.ids, r.infos) for r in batches.orderBy("batch_no").collect()] == [
        (0, [2, 3, 6], ["new", "edited", "undated"]),
        (1, [7], ["unhashed"]),
    ]
    members = unnest_batches(batches, "infos").orderBy("id").collect()
    assert [(r.batch_no, r.ord, r.id, r.value) for r in members][2:] == [(0, 3, 6, "undated"), (1, 1, 7, "unhashed")]


def test_counts_coverage_and_percent(rows):
    assert overview(rows).first().asDict() == {"rows": 7, "embedded": 4, "stale": 4}
    assert coverage(rows).first().complete is False
    assert coverage(rows.filter("embedding IS NOT NULL")).first().complete is True
    assert coverage(rows.limit(0)).first().complete is False
    assert percent_done(rows).first().percent == 57 and percent_done(rows.limit(0)).first().percent is None


def test_checklist_and_assertions(rows):
    got = checklist(rows, {"seven rows": F.count("*") == 7, "all embedded": F.count("embedding") == 7, "unknown": F.max("text_hash") < F.lit(None)})
    assert {r["item"]: r.status for r in got.collect()} == {"seven rows": "OK", "all embedded": "MISSING", "unknown": "MISSING"}
    got = assertions(rows, {"rows": (F.count("*"), 7), "text": (F.max("info"), "x"), "none": (F.max(F.lit(None).cast("int")), 0)})
    assert {r.name: (r.expected, r.actual, r.ok) for r in got.collect()} == {
        "rows": ("7", "7", True),
        "text": ("x", "unhashed", False),
        "none": ("0", None, False),
    }


def test_triplets_and_keywords(spark):
    df = spark.createDataFrame(
        [("lemon peel", "lemon zest", "diesel engine"), ("lemon peel", "diesel engine", "lemon zest")],
        "anchor string, related string, unrelated string",
    )
    assert [r.ok for r in triplets(df).collect()] == [True, False]
    hits = spark.createDataFrame([(1, "Lemon wit"), (1, "stout"), (2, "porter")], "g int, info string")
    got = {r.g: r.precision for r in keyword_precision(hits, "info", "(?i)lemon|wit", ["g"]).collect()}
    assert got == {1: 0.5, 2: 0.0}


def test_run_log(spark):
    jobs = spark.createDataFrame([(1, "refresh")], "job_id long, job string")
    schema = "run_id long, job_id long, status string, rows long, started timestamp, ended timestamp"
    log = None
    for i in range(4):
        run = spark.createDataFrame([(i, 1, "succeeded", 1100)], "run_id long, job_id long, status string, rows long")
        start = F.lit(f"2024-01-01 00:0{i}:00").cast("timestamp")
        run = run.withColumn("started", start).withColumn("ended", start + F.expr("INTERVAL 100 SECONDS"))
        log = log_run(log, run.select(*[c.split()[0] for c in schema.split(", ")]))
    assert [r.run_id for r in latest_runs(log, jobs).collect()] == [3, 2, 1]
    assert throughput(log).first().asDict() == {"rows": 4400, "seconds": 400, "met": True}
    assert throughput(log, floor_rows=3301).first().met is False


CHANGES = "id long, info string, changed_at timestamp, n long"


def feed(spark, path, name, rows):
    df = spark.createDataFrame([(i, t, n) for i, t, n in rows], "id long, info string, n long")
    df = df.select("id", "info", F.timestamp_seconds("n").alias("changed_at"), "n")
    df.coalesce(1).write.mode("append").parquet(path)


def run(spark, source, log, checkpoint, model):
    stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(source)
    job = keep_fresh(stream, log, checkpoint, ["n"], model, trigger=ONCE)
    job.awaitTermination()


def test_sweeps_resume_skip_what_is_unchanged_and_keep_the_last_write(spark, tmp_path):
    source, log, progress = str(tmp_path / "in"), scratch(spark, "log"), scratch(spark, "progress")
    model = Counting(tmp_path / "calls")
    open_log(spark, log)
    feed(spark, source, "a", [(1, "one", 1), (2, "two", 2), (1, "one again", 3), (3, "", 4)])
    run(spark, source, log, progress, model)
    got = {r.id: r for r in current_vectors(spark, log).collect()}
    assert {i: r.text_hash for i, r in got.items()} == {1: sha("one again"), 2: sha("two")}
    assert sorted((tmp_path / "calls").read_text().splitlines()) == ["one again", "two"]

    feed(spark, source, "b", [(2, "two", 5), (1, "one more", 6)])
    run(spark, source, log, progress, model)
    assert sorted((tmp_path / "calls").read_text().splitlines()) == ["one again", "one more", "two"]
    run(spark, source, log, progress, model)  # nothing new
    assert len((tmp_path / "calls").read_text().splitlines()) == 3
    now = {r.id: r.embedding for r in current_vectors(spark, log).collect()}
    assert now == {1: [8.0, 1.0], 2: [3.0, 1.0]}

    smaller = scratch(spark, "log")
    compact_log(spark, log, smaller)
    assert {r.id: r.embedding for r in current_vectors(spark, smaller).collect()} == now
    feed(spark, source, "c", [(4, "four", 7), (2, "two", 8)])
    run(spark, source, smaller, progress, model)
    assert {r.id for r in current_vectors(spark, smaller).collect()} == {1, 2, 4}


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    from vicinity.streaming.refresh import append_epoch

    log = scratch(spark, "log")
    open_log(spark, log)
    batch = spark.createDataFrame([(1, "one", 1)], "id long, info string, n long")
    batch = batch.select("id", "info", F.timestamp_seconds("n").alias("changed_at"), "n")
    for _ in range(2):
        append_epoch(batch, 0, log, ["n"], Counting(tmp_path / "c"))
    assert spark.read.parquet(log).count() == 1


def test_a_new_checkpoint_a_late_change_and_the_latest_one(spark, tmp_path):
    source, log, model = str(tmp_path / "in"), scratch(spark, "log"), Counting(tmp_path / "calls")
    open_log(spark, log)
    feed(spark, source, "a", [(1, "one", 10), (2, "two", 20), (3, "three", 30)])
    run(spark, source, log, scratch(spark, "progress"), model)
    other = str(tmp_path / "more")
    feed(spark, other, "b", [(1, "one, late", 5), (3, "three, newer", 40), (4, "four", 41)])
    run(spark, other, log, scratch(spark, "progress"), model)
    now = {r.id: r.text_hash for r in current_vectors(spark, log).collect()}
    assert now == {1: sha("one"), 2: sha("two"), 3: sha("three, newer"), 4: sha("four")}
    run(spark, source, log, scratch(spark, "progress"), model)  # the first feed again, from its start
    assert {r.id: r.text_hash for r in current_vectors(spark, log).collect()} == now


def test_a_late_change_after_an_unchanged_and_a_blank_one(spark, tmp_path):
    source, log, progress = str(tmp_path / "in"), scratch(spark, "log"), scratch(spark, "progress")
    model = Counting(tmp_path / "calls")
    open_log(spark, log)
    epochs = [
        [(1, "same", 5), (2, "gone", 5), (3, "back", 5), (4, "", 9), (5, None, 9)],
        [(1, "same", 9), (2, "", 9), (3, None, 9)],
        [(1, "late", 7), (2, "late", 7), (3, "back", 11), (4, "late", 7), (5, "late", 7)],
    ]
    for n, rows in enumerate(epochs):
        feed(spark, source, str(n), rows)
        run(spark, source, log, progress, model)
    now = {r.id: (r.text_hash, r.embedding, r.embedded_at.second) for r in current_vectors(spark, log).collect()}
    assert now == {1: (sha("same"), [4.0, 1.0], 9), 3: (sha("back"), [4.0, 1.0], 11)}
    calls = sorted((tmp_path / "calls").read_text().splitlines())
    assert calls == ["back", "back", "gone", "same"]  # the same text isn't encoded again

    smaller = scratch(spark, "log")
    compact_log(spark, log, smaller)
    feed(spark, source, "3", [(2, "later still", 8), (4, "new", 10)])
    run(spark, source, smaller, progress, model)
    assert {r.id: r.text_hash for r in current_vectors(spark, smaller).collect()} == {
        1: sha("same"), 3: sha("back"), 4: sha("new"),
    }


def test_an_epoch_reads_touched_divisions_only(spark, tmp_path):
    from vicinity.streaming.refresh import append_epoch, read_log

    log = scratch(spark, "log")
    open_log(spark, log)
    rows = [(i, f"text {i}", 1) for i in range(50)]
    batch = spark.createDataFrame(rows, "id long, info string, n long").withColumn("changed_at", F.timestamp_seconds("n"))
    append_epoch(batch, 0, log, ["n"], Counting(tmp_path / "c"))
    plan = read_log(spark, log).filter(F.col("bucket").isin(3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and read_log(spark, log).select("bucket").distinct().count() > 8


def test_embed_on_write_in_a_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, "oak")], "id long, info string").withColumn("changed_at", now())
    row = embed_on_write(df, Counting(tmp_path / "c")).first()
    assert row.embedding == [3.0, 1.0] and row.text_hash == sha("oak") and row.embedded_at == row.changed_at
