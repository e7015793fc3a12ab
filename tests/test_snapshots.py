import pytest
from pyspark.sql import functions as F

from vicinity.operators.snapshots import Snapshots


@pytest.fixture
def divided(spark, tmp_path):
    rows = spark.range(200).select("id", F.concat(F.lit("text "), "id").alias("info"), (F.col("id") % 7).cast("int").alias("size"))
    return Snapshots.create(rows, str(tmp_path / "t"), divisions=16)


def content(snapshots, version=None):
    return sorted(map(tuple, snapshots.read(version).collect()))


def new(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, info string, size int")


def test_changes_touch_few_divisions_and_old_versions_stay(spark, divided):
    first = content(divided)
    assert len(first) == 200 and first[3] == (3, "text 3", 3)
    second = divided.change(new(spark, (3, "three", 0), (900, "more", None)), spark.createDataFrame([(5,), (77_777,)], "id long"))
    state = {r[0]: r for r in first} | {3: (3, "three", 0), 900: (900, "more", None)}
    state.pop(5)
    assert content(second) == sorted(state.values()) and content(second, 1) == first
    assert len(second.touched(1)) <= 4
    third = second.update(F.col("id").isin(8, 9), {"info": F.upper("info")})
    assert len(third.touched(2)) <= 2 and {r.id: r.info for r in third.look_up([8, 9, 10, 4242]).collect()} == {8: "TEXT 8", 9: "TEXT 9", 10: "text 10"}
    fourth = third.delete(F.col("id") == 900)
    assert fourth.touched(3) and 900 not in {r[0] for r in content(fourth)}
    feed = sorted(map(tuple, fourth.changes(since=1).collect()))
    assert feed == [("delete", 5, "text 5", 5), ("update", 3, "three", 0), ("update", 8, "TEXT 8", 1), ("update", 9, "TEXT 9", 2)]
    assert sorted(r.change for r in fourth.changes(1, 2).collect()) == ["delete", "insert", "update"]
    assert fourth.changes(since=4).collect() == []


def test_a_failed_change_and_a_second_writer(spark, divided, monkeypatch):
    before = content(divided)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Snapshots, "_publish", broken)
        with pytest.raises(OSError):
            divided.change(new(spark, (1, "one", 1)))
    again = Snapshots(spark, divided.path)
    assert again.version == divided.version and content(again) == before
    changed = again.change(new(spark, (1, "one", 1)))
    assert content(changed)[1] == (1, "one", 1)
    with pytest.raises(RuntimeError, match="newer"):
        divided.delete(F.col("id") == 2)


def test_nothing_to_do_and_odd_cases(spark, divided, tmp_path):
    assert divided.delete(F.col("id") < 0).version == divided.version
    assert divided.update(F.col("size") == F.lit(None), {"info": F.lit("x")}).version == divided.version
    with pytest.raises(ValueError):
        divided.update(F.lit(True), {"id": F.lit(1)})
    emptied = divided.delete(F.lit(True))
    assert content(emptied) == [] and content(emptied.change(new(spark, (1, None, None)))) == [(1, None, None)]
    empty = Snapshots.create(new(spark).limit(0), str(tmp_path / "e"), divisions=4)
    assert content(empty) == [] and content(empty.change(new(spark, (2, "two", 2)))) == [(2, "two", 2)]
