from types import SimpleNamespace

import pytest

from vicinity.plans import QUERIES
from vicinity.session import materialize, scratch, spread, table_stream
from vicinity.streaming.refresh import ONCE


def stand_in(master, folder=None):
    kept = {}
    conf = SimpleNamespace(get=lambda k, d: kept.get(k, folder or d), set=kept.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_written_tables_go_to_the_shared_folder():
    cluster = stand_in("yarn", "hdfs://shared/")
    one, two = scratch(cluster, "t"), scratch(cluster, "t")
    assert one.startswith("hdfs://shared/t-") and one != two


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(stand_in("spark://host:7077"), "t")


def test_a_local_session_keeps_the_folder_it_made():
    local = stand_in("local[2]")
    assert scratch(local, "a").rsplit("/", 1)[0] == scratch(local, "b").rsplit("/", 1)[0]


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.sql("SELECT id, array(CAST(id AS FLOAT)) AS v, CAST(NULL AS STRING) AS s FROM range(5)")
    back = materialize(df, "t")
    assert sorted(back.collect()) == sorted(df.collect())
    assert [(f.name, f.dataType.simpleString()) for f in back.schema] == [(f.name, f.dataType.simpleString()) for f in df.schema]


def test_only_small_tables_in_few_files_are_dealt_out(spark):
    cores = spark.sparkContext.defaultParallelism
    few = materialize(spark.range(100).coalesce(1), "few")
    many = materialize(spark.range(100).repartition(cores * 2), "many")
    assert spread(few).rdd.getNumPartitions() == cores and spread(few).count() == 100
    assert spread(many) is many
    made = spark.range(3)
    assert spread(made) is made


def test_a_table_of_one_or_of_many_files_is_streamed_whole(spark, tmp_path):
    rows = spark.range(20).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    rows.repartition(3).write.parquet(f"{tmp_path}/many/documents.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_path}/made")
    (tmp_path / "one").mkdir()
    next((tmp_path / "made").glob("*.parquet")).rename(tmp_path / "one" / "documents.parquet")
    (tmp_path / "one" / "other.parquet").write_text("no table")
    for folder in ("many", "one"):
        out = scratch(spark, "streamed")
        writer = table_stream(spark, f"{tmp_path}/{folder}", "documents").writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", scratch(spark, "progress")).trigger(**ONCE).start().awaitTermination()
        assert sorted(spark.read.parquet(out).collect()) == sorted(rows.collect())


def test_rows_of_a_folder_of_files_are_embedded_on_write(spark, tmp_path):
    rows = spark.sql("SELECT id AS doc_id, 'some words' AS text FROM range(9)")
    rows.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["embed_rows_on_write"](spark, str(tmp_path)).collect()
    assert sorted(r.id for r in found) == [*range(9)] and {r.dims for r in found} == {384}
