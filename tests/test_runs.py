from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_upkeep import sha

from vicinity.operators.fresh import throughput
from vicinity.operators.runs import read_runs, recorded, refresh_table
from vicinity.session import scratch, stored_once
from vicinity.sources.catalog import empty_catalog, load_and_record, read_meta
from vicinity.streaming.refresh import append_epoch, current_vectors, open_log

ROWS = "id long, info string, text_hash string, embedding array<float>, embedded_at timestamp"
T = datetime(2024, 1, 1)


def clock():
    ticks = iter(range(100))
    return lambda: datetime(2024, 1, 1, 0, next(ticks))


def test_a_refresh_returns_and_logs_what_it_embedded(spark, tmp_path):
    rows = [(1, "done", sha("done"), [9.0], T), (2, "new", None, None, None), (3, "edited", sha("old"), [9.0], T), (4, "", None, None, None)]
    log, first, second = (str(tmp_path / n) for n in ("log", "a", "b"))
    df = spark.createDataFrame(rows, ROWS)
    as_of = F.lit(datetime(2024, 5, 1))
    assert refresh_table(df, first, as_of, log, run_id="a", clock=clock()) == 2
    assert refresh_table(spark.read.parquet(first), second, as_of, log, run_id="b", clock=clock()) == 0
    runs = {r.run_id: r for r in read_runs(spark, log).collect()}
    assert {i: (r.rows, r.counts["total"], r.counts["with_vector"], r.status) for i, r in runs.items()} == {
        "a": (2, 4, 3, "succeeded"), "b": (0, 4, 3, "succeeded"),
    }
    assert {r.id: r.text_hash for r in spark.read.parquet(second).collect()}[3] == sha("edited")
    assert throughput(read_runs(spark, log), 1, 100).first().met is True
    refresh_table(df, first, as_of, log, run_id="a")  # the same run again replaces its entry
    assert read_runs(spark, log).count() == 2


def test_a_failed_run_is_logged_and_raises(spark, tmp_path):
    def write(_):
        raise OSError("disk")

    with pytest.raises(OSError):
        recorded(spark.range(3), write, {"rows": F.count("*")}, str(tmp_path / "log"), run_id="x", clock=clock())
    row = read_runs(spark, str(tmp_path / "log")).first()
    assert (row.status, row.rows, row.started, row.ended) == ("failed", None, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1))


def test_an_empty_table_counts_zero(spark, tmp_path):
    df = spark.createDataFrame([], ROWS)
    assert refresh_table(df, str(tmp_path / "t"), F.lit(T), str(tmp_path / "log")) == 0


def test_an_epoch_counts_what_it_embedded(spark, tmp_path):
    log, runs = scratch(spark, "log"), str(tmp_path / "runs")
    open_log(spark, log)

    def batch(*rows):
        df = spark.createDataFrame(rows, "id long, info string, n long")
        return df.select("id", "info", F.timestamp_seconds("n").alias("changed_at"), "n")

    first = append_epoch(batch((1, "one", 1), (2, "two", 1), (3, "", 1)), 0, log, ["n"], runs=runs)
    second = append_epoch(batch((1, "one", 2), (2, "more", 2)), 1, log, ["n"], runs=runs)
    assert (first, second) == ({"rows": 2, "written": 3}, {"rows": 1, "written": 2})
    append_epoch(batch((1, "one", 2), (2, "more", 2)), 1, log, ["n"], runs=runs)  # replayed
    assert sorted((r.run_id, r.rows) for r in read_runs(spark, runs).collect()) == [("r1-0", 2), ("r1-1", 1)]
    assert {r.id for r in current_vectors(spark, log).collect()} == {1, 2}


def test_a_load_records_counts_and_provenance(spark, tmp_path):
    head = "Name,Country,Brand,Categories,Tasting Notes,ABV,IBU,Food Pairing,Rating,Rate Count,Description\n"
    lines = ["A,DE,x,ALE,,5%,10,,4.0,3,one", "A,DE,x,ALE,,5%,10,,4.0,3,again", "B,FR,y,ALE,,6%,10,,4.0,3,two", ",FR,y,ALE,,6%,10,,4.0,3,none"]
    (tmp_path / "c.csv").write_text(head + "\n".join(lines) + "\n")
    meta, log = str(tmp_path / "meta"), str(tmp_path / "log")
    args = (str(tmp_path / "c.csv"),)
    first = load_and_record(spark, *args, empty_catalog(spark), "2024-01-01 00:00:00", str(tmp_path / "1"), meta, log, {"source": "s", "version": "1"})
    assert first == {"rows": 2, "total": 2, "insert": 2, "update": 0, "keep": 0, "read": 4, "skipped": 1, "duplicates": 1}
    target = spark.read.parquet(str(tmp_path / "1"))
    second = load_and_record(spark, *args, target, "2024-01-02 00:00:00", str(tmp_path / "2"), meta, log, {"version": "2"})
    assert second["total"] == 2 and second["insert"] == 0
    got = {r.key: r.value for r in read_meta(spark, meta).collect()}
    assert got == {"source": "s", "version": "2", "load_timestamp": "2024-01-02 00:00:00", "row_count": "2"}
    assert read_runs(spark, log).count() == 2


def test_a_stored_table_follows_its_source(spark, tmp_path):
    source, calls = str(tmp_path / "s"), []

    def make():
        calls.append(1)
        return spark.read.parquet(source).selectExpr("id * 2 AS id")

    for rows in (3, 5):
        spark.range(rows).coalesce(1).write.mode("overwrite").parquet(source)
        for _ in range(2):
            assert stored_once(spark, "doubled", [source], make).count() == rows
    assert len(calls) == 2
