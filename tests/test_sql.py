import numpy as np
import pytest

from vicinity.search import search
from vicinity.session import materialize
from vicinity.sql import register

ROWS = [
    (1, "oak and smoke", "b", "s", "smoked oak over the fire"),
    (2, "lemon", "b", "s", "sour lemon"),
    (3, "more lemon", None, "s", "sour lemon"),
    (4, "nothing", "b", "s", None),
    (5, "silence", "b", "s", "!!"),
]


class Shout:
    """An encoder with a call log."""

    width, chunk = 2, 8

    def encode(self, texts):
        return np.array([[float(len(t)), 1.0] for t in (texts if isinstance(texts, list) else texts.to_pylist())])

    def info(self):
        return [("model", "shout")]


@pytest.fixture
def view(spark):
    from pyspark.sql import functions as F

    from vicinity.functions.encode import encode

    rows = spark.createDataFrame(ROWS, "id long, beer_name string, brewery string, style string, info string")
    rows = materialize(rows.withColumn("embedding", encode(F.col("info"))), "some-rows")
    rows.createOrReplaceTempView("some_rows")
    register(spark)
    return rows


def ask(spark, question, n):
    text = "NULL" if question is None else f"'{question}'"
    return [(r.id, round(r.distance, 9)) for r in spark.sql(f"SELECT * FROM nearest_rows(TABLE(some_rows), {text}, {n}) ORDER BY distance, id LIMIT {n}").collect()]


def test_same_rows_as_search(spark, view):
    for question, n in (("sour lemon", 2), ("oak fire", 3), ("lemon", 50)):
        want = [(r.id, r.distance) for r in search(view, question, n).collect() if r.distance is not None]
        got = ask(spark, question, n)
        assert [(i, round(d, 4)) for i, d in got] == want
    assert ask(spark, "sour lemon", 2)[0] == (2, 0.0) and ask(spark, "sour lemon", 2)[1] == (3, 0.0)


def test_odd_arguments(spark, view):
    assert ask(spark, None, 3) == [] and ask(spark, "lemon", 0) == []
    assert ask(spark, "", 3) == []
    empty = spark.sql("SELECT * FROM nearest_rows(TABLE(SELECT * FROM some_rows WHERE id > 99), 'lemon', 3)")
    assert empty.collect() == [] and empty.columns == ["id", "beer_name", "brewery", "style", "distance"]
    none = spark.sql("SELECT * FROM nearest_to_vector(TABLE(some_rows), (SELECT embedding FROM some_rows WHERE id = 4), 3)")
    assert none.collect() == []


def test_more_like_a_row(spark, view):
    hits = spark.sql(
        """SELECT id, distance FROM nearest_to_vector(TABLE(SELECT * FROM some_rows WHERE id <> 2),
        (SELECT embedding FROM some_rows WHERE id = 2), 1) ORDER BY distance, id LIMIT 1"""
    ).collect()
    assert [(r.id, round(r.distance, 9)) for r in hits] == [(3, 0.0)]


def test_settings_and_other_encoders(spark, view):
    got = {r.setting: r.value for r in spark.sql("SELECT * FROM encoder_settings()").collect()}
    assert got["model"] == "hashed-words" and got["dimensions"] == "384"
    register(spark, Shout(), prefix="> ")
    assert [r.value for r in spark.sql("SELECT * FROM encoder_settings()").collect()] == ["shout"]
    rows = [(1, "a", "b", "c", [3.0, 1.0]), (2, "a", "b", "c", [9.0, 1.0])]
    spark.createDataFrame(rows, "id long, beer_name string, brewery string, style string, embedding array<float>").createOrReplaceTempView("wide")
    assert [r.id for r in spark.sql("SELECT * FROM nearest_rows(TABLE(wide), '1234567', 2) ORDER BY distance, id").collect()] == [2, 1]
    register(spark)
