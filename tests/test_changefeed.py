import pytest
from pyspark.sql import functions as F

from vicinity.operators.snapshots import Snapshots
from vicinity.sources.changefeed import register


def follow(spark, path, checkpoint, out, **options):
    """Everything up to the latest version, then stop."""
    register(spark)
    stream = spark.readStream.format("snapshot_changes").option("path", path)
    for k, v in options.items():
        stream = stream.option(k, v)
    job = stream.load().writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).start()
    job.processAllAvailable()
    job.stop()
    return spark.read.parquet(out)


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(40).select("id", F.concat(F.lit("text "), "id").alias("info"), F.array(F.lit(1.5).cast("float")).alias("embedding"))
    return Snapshots.create(rows, str(tmp_path / "t"), divisions=8)


def test_each_change_arrives_once_also_after_a_restart(spark, table, tmp_path):
    checkpoint, out = str(tmp_path / "c"), str(tmp_path / "o")
    first = follow(spark, table.path, checkpoint, out, since=1)
    assert first.count() == 0 and first.columns == ["change", "id", "info", "embedding"]
    new = spark.createDataFrame([(3, "three", [2.0]), (100, "more", None)], "id long, info string, embedding array<float>")
    table = table.change(new, spark.createDataFrame([(5,)], "id long"))
    got = sorted(map(tuple, follow(spark, table.path, checkpoint, out, since=1).collect()))
    want = [("delete", 5, "text 5", [1.5]), ("insert", 100, "more", None), ("update", 3, "three", [2.0])]
    assert got == want
    table = table.update(F.col("id") == 7, {"info": F.lit("seven")}).delete(F.col("id") == 100)
    rows = sorted(map(tuple, follow(spark, table.path, checkpoint, out, since=1).collect()))
    assert rows == sorted([*want, ("update", 7, "seven", [1.5]), ("delete", 100, "more", None)])
    assert follow(spark, table.path, checkpoint, out, since=1).count() == 5


def test_from_the_beginning_the_table_is_inserted(spark, table, tmp_path):
    got = follow(spark, table.path, str(tmp_path / "c"), str(tmp_path / "o"))
    assert {r.change for r in got.collect()} == {"insert"} and got.count() == 40
