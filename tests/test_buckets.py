import numpy as np
import pytest
from pyspark.sql import functions as F
from test_cells import clustered, truth

from vicinity.operators.approx import recall_at_k
from vicinity.operators.buckets import bucket_search, bucket_search_many, planes, probed, share_read, with_buckets, write_buckets
from vicinity.operators.many import nearest_many

SCHEMA = "id long, embedding array<float>, kind string, price double"


@pytest.fixture(scope="module")
def rows():
    return [*clustered(1500, width=24, centres=60, seed=3), (9000, None, "a", 1.0)]


@pytest.fixture(scope="module")
def stored(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("buckets") / "b")
    write_buckets(spark.createDataFrame(rows, SCHEMA), path, tables=6, bits=8)
    return spark.read.parquet(path)


def test_buckets_are_those_of_the_planes(spark, rows):
    signs = planes(24, 3, 4)
    assert set(np.unique(signs)) == {-1.0, 1.0} and abs(signs.mean()) < 0.2
    frame = with_buckets(spark.createDataFrame(rows, SCHEMA), "embedding", 3, 4)
    got = {r.id: r.cells for r in frame.select("id", "cells").collect()}
    for i, v, *_ in rows[:50]:
        side = signs @ np.array(v)
        assert got[i] == [(t << 4) + sum(1 << b for b in range(4) if side[t, b] > 0) for t in range(3)]
    assert got[9000] is None


def test_probes_turn_the_nearest_planes_first():
    signs, v = planes(24, 2, 6), np.random.default_rng(1).normal(size=(5, 24))
    asked = probed(v, signs, 4).reshape(5, 2, 4)
    for row in range(5):
        for t in range(2):
            side = signs[t] @ v[row]
            turned = [int(a ^ asked[row, t, 0]).bit_length() - 1 for a in asked[row, t, 1:]]
            assert turned == np.argsort(np.abs(side))[:3].tolist()


def test_most_neighbours_in_a_tenth_of_the_rows(spark, rows):
    corpus = spark.createDataFrame(rows[:-1], SCHEMA).select("id", F.col("embedding").alias("vector"))
    queries = corpus.filter("id % 15 = 0").withColumnRenamed("id", "qid")
    way = {"tables": 4, "bits": 10, "probes": 4}
    found = bucket_search_many(queries, corpus, 10, **way)
    assert recall_at_k(found, nearest_many(queries, corpus, 10), 10).agg(F.avg("recall")).first()[0] >= 0.9
    assert share_read(queries, corpus, **way).first()[0] < 0.1


def test_one_question_is_ranked_exactly_inside_its_buckets(spark, stored, rows):
    signs = planes(24, 6, 8)
    query = rows[7][1]
    asked = set(probed(np.array([query]), signs, 3)[0].tolist())
    inside = [r for r in rows if r[1] is not None and asked & set(probed(np.array([r[1]]), signs, 1)[0].tolist())]
    hits = bucket_search(stored, query, 20, tables=6, bits=8, probes=3, where=F.col("kind") != "b", columns=["kind"]).collect()
    assert [r.id for r in hits] == truth(inside, query, 20, lambda r: r[2] != "b") and len({r.id for r in hits}) == 20


def test_equal_vectors_go_by_id(spark, tmp_path):
    frame = spark.createDataFrame([(i, [1.0, 2.0], "a", 0.0) for i in (5, 3, 9, 1)], SCHEMA)
    write_buckets(frame, str(tmp_path / "b"), tables=2, bits=2)
    hits = bucket_search(spark.read.parquet(str(tmp_path / "b")), [1.0, 2.0], 3, tables=2, bits=2)
    assert [r.id for r in hits.collect()] == [1, 3, 5]


def test_more_probes_than_planes(spark, rows):
    with pytest.raises(ValueError):
        with_buckets(spark.createDataFrame(rows, SCHEMA), "embedding", 1, 3, probes=5)
