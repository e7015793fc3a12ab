import pytest
from pyspark.sql import functions as F
from test_cells import clustered

from vicinity.operators.many import nearest_many
from vicinity.operators.pruned import _tiled, nearest_many_pruned, pairs_skipped, pruned_blocks


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, v) for i, v, *_ in clustered(900, width=16, centres=30, seed=5)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, rows[5][1]), (2003, rows[5][1])]
    return spark.createDataFrame(rows, "id long, vector array<float>")


@pytest.mark.parametrize("n,exclude_self", [(1, False), (7, True), (60, False)])
def test_same_rows_as_without_pruning(corpus, n, exclude_self):
    queries = corpus.filter("id % 3 = 0 or id > 1000").withColumnRenamed("id", "qid")
    way = {"exclude_self": exclude_self}
    got = nearest_many_pruned(queries, corpus, n, cells=40, block_rows=16, **way)
    want = nearest_many(queries, corpus, n, **way)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_same_rows_with_blocks_of_which_some_are_empty(corpus):
    queries = corpus.filter("id % 5 = 0").withColumnRenamed("id", "qid")
    got = nearest_many_pruned(queries, corpus, 7, cells=40, block_rows=2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, nearest_many(queries, corpus, 7).collect()))


def test_most_block_pairs_of_clusters_are_skipped(corpus):
    queries = corpus.filter("id % 3 = 0").withColumnRenamed("id", "qid")
    row = pairs_skipped(queries, corpus, 5, cells=40, block_rows=16).first()
    assert 0 < row.looked_at < row.block_pairs / 4


def test_few_rows_and_none(spark, corpus):
    few, none = corpus.filter("id < 3"), corpus.limit(0)
    asked = few.withColumnRenamed("id", "qid")
    got = nearest_many_pruned(asked, few, 5).orderBy("qid", "rank").collect()
    assert [r.qid for r in got] == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert nearest_many_pruned(none.withColumnRenamed("id", "qid"), few, 5).collect() == []
    assert nearest_many_pruned(asked, none, 5).collect() == []


def test_blocks_travel_in_few_tiles(corpus):
    queries = corpus.withColumnRenamed("id", "qid")
    _, pairs, blocks = pruned_blocks(queries, corpus, 5, 40, 2)
    placed = _tiled(blocks, 2)
    for side in ("query", "corpus"):
        rows = placed.filter(placed.side == side).orderBy("place").collect()
        assert len({r.place for r in rows}) == len(rows) > 300
        assert max(r.tile for r in rows) < 8
