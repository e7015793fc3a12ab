import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vicinity.operators import cells
from vicinity.operators.approx import recall_at_k
from vicinity.operators.cells import CellIndex, descend, train_tree
from vicinity.operators.many import nearest_many
from vicinity.operators.topk import nearest

SCHEMA = "id long, embedding array<float>, kind string, price double"


def clustered(n, width=12, centres=20, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    out = []
    for i in range(n):
        v = middle[i % centres] + 0.15 * rng.normal(size=width)
        out.append((i, [float(np.float32(x)) for x in v], "abcd"[i % 4], float(i % 97)))
    return out


@pytest.fixture(scope="module")
def rows():
    return clustered(800)


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([*rows, (9000, None, "a", 1.0)], SCHEMA)


@pytest.fixture
def index(table, tmp_path):
    return CellIndex.build(table, str(tmp_path / "index"), cells=25, attributes=["kind", "price"])


def truth(rows, query, n, keep=lambda r: True):
    q = np.array(query)
    dist = []
    for r in rows:
        if r[1] is not None and keep(r):
            v = np.array(r[1])
            dist.append((1 - v @ q / math.sqrt((v @ v) * (q @ q)), r[0]))
    return [i for _, i in sorted(dist)[:n]]


def ids(hits):
    return [r[0] for r in hits.collect()]


def live(index):
    """Every row of the index as searches see it."""
    every = [r[0] for r in index.manifest.select("cell").distinct().collect()]
    return sorted(r[0] for r in index.rows_of(every).select("id").collect())


def test_all_cells_give_the_exact_answer_and_few_cells_most_of_it(index, rows):
    for at in (3, 77, 400):
        assert ids(index.search(rows[at][1], 5, probes=1000)) == truth(rows, rows[at][1], 5)
    hits = [len(set(ids(index.search(rows[i][1], 5, probes=4))) & set(truth(rows, rows[i][1], 5))) for i in range(0, 800, 80)]
    assert sum(hits) >= 0.9 * 5 * len(hits)


def test_recall_for_many_queries(spark, index, table):
    queries = table.filter("id % 10 = 0 and embedding is not null").select(F.col("id").alias("qid"), F.col("embedding").alias("vector"))
    corpus = table.filter("embedding is not null").select("id", F.col("embedding").alias("vector"))
    recall = recall_at_k(index.search_many(queries, 5, probes=4), nearest_many(queries, corpus, 5), 5)
    assert recall.agg(F.avg("recall")).first()[0] >= 0.9


def test_changes_are_found_where_they_are_now(spark, index, rows):
    state = {r[0]: r for r in rows}
    new = [(5000 + i, [x + 0.01 for x in rows[i][1]], "d", 1.0) for i in range(30)]
    moved = [(i, rows[(i + 7) % 800][1], "a", 2.0) for i in range(0, 100, 10)]  # to another cell
    same = [(i, rows[i][1], "b", -1.0) for i in (1, 2, 3)]  # stays in its cell
    index = index.change(spark.createDataFrame([*new, *moved, *same], SCHEMA))
    state |= {r[0]: r for r in [*new, *moved, *same]}
    index = index.change(gone=spark.createDataFrame([(i,) for i in (5, 5001, 10, 123456)], "id long"))
    for i in (5, 5001, 10):
        state.pop(i)
    stages = [lambda i: i, lambda i: i.fold(), lambda i: i.fold(most_rows=20)]
    again = index
    for stage in stages:
        again = stage(again)
        assert live(again) == sorted(state)
        for at in (0, 1, 2, 7, 17, 400):
            assert ids(again.search(rows[at][1], 6, probes=1000)) == truth(state.values(), rows[at][1], 6)
        assert ids(again.search(new[4][1], 1, probes=1)) == [5004]
    got = {r.id: r.price for r in again.search(rows[1][1], 1, probes=1, columns=["price"]).collect()}
    assert got == {1: -1.0}
    with pytest.raises(RuntimeError, match="newer"):
        index.change(gone=spark.createDataFrame([(7,)], "id long"))


def test_a_change_writes_touched_cells_only(spark, index):
    row = [(7777, [1.0] * 12, "a", 0.0)]
    changed = index.change(spark.createDataFrame(row, SCHEMA))
    entries = changed.manifest.filter(F.col("gen") == 2).collect()
    assert [(e.rows, e.marks) for e in entries] == [(1, 0)]
    assert changed.manifest.filter(F.col("gen") == 1).count() == index.manifest.count()


def test_a_failed_change_leaves_the_last_version(spark, index, rows, monkeypatch):
    before = live(index)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(CellIndex, "_publish", broken)
        with pytest.raises(OSError):
            index.change(spark.createDataFrame([(4000, rows[0][1], "a", 0.0)], SCHEMA))
    again = CellIndex(spark, index.path)
    assert again.version == index.version and live(again) == before
    assert 4001 in live(again.change(spark.createDataFrame([(4001, rows[0][1], "a", 0.0)], SCHEMA)))


def test_overfull_cells_are_split(spark, index, rows):
    more = [(10_000 + i, [x + random.Random(i).gauss(0, 0.05) for x in rows[0][1]], "a", 0.0) for i in range(400)]
    grown = index.change(spark.createDataFrame(more, SCHEMA))
    split = grown.fold(most_rows=120)
    sizes = [r[0] for r in split.manifest.groupBy("cell").agg(F.sum("rows")).select("sum(rows)").collect()]
    assert sum(sizes) == 1200 and max(sizes) < 400 and split.centroids.count() > index.centroids.count()
    assert ids(split.search(more[9][1], 1, probes=2)) == [10_009]
    assert live(grown) == live(split)


@pytest.mark.parametrize("streamed", [False, True])
def test_descent_is_the_same_in_a_stream(spark, table, rows, monkeypatch, streamed):
    groups, centroids = train_tree(table, 25, "embedding")
    if streamed:
        monkeypatch.setattr(cells, "SENT_BYTES", 0)
        monkeypatch.setattr(cells, "STREAM_ROWS", 50)
    got = {r.id: r.cell for r in descend(table, groups, centroids, "embedding").select("id", "cell").collect()}
    top = {r.group: np.array(r.centroid) for r in groups.collect()}
    low = centroids.collect()
    for i, v, *_ in rows:
        near = lambda m: round(1 - m @ np.array(v) / np.linalg.norm(m) / np.linalg.norm(v), 12)
        group = min(top, key=lambda g: (near(top[g]), g))
        assert got[i] == min((near(np.array(r.centroid)), r.cell) for r in low if r.group == group)[1]
    assert got[9000] is None


def test_a_large_tree_answers_many_queries_group_by_group(spark, index, table, monkeypatch):
    queries = table.filter("id < 40").select(F.col("id").alias("qid"), F.col("embedding").alias("vector"))
    monkeypatch.setattr(cells, "SENT_BYTES", 0)
    found = CellIndex(spark, index.path)
    assert {r.qid: r.id for r in found.search_many(queries, 1, probes=1).collect()} == {i: i for i in range(40)}
    assert ids(found.search(clustered(1)[0][1], 1, probes=1, wide=1)) == [0]


def test_statistics_tell_how_far_to_widen(spark, index, rows):
    query, everywhere = rows[8][1], index._cells(rows[8][1])
    cases = [({"kind": "b"}, 5), ({"price": (10.0, 60.0)}, 8), ({"kind": "c", "price": (0.0, 90.0)}, 3), ({"kind": "zz"}, 3), ({}, 7)]
    changed = index.change(spark.createDataFrame([(i, rows[i][1], "z", -5.0) for i in range(0, 200, 2)], SCHEMA))
    state = {r[0]: r for r in rows} | {i: (i, rows[i][1], "z", -5.0) for i in range(0, 200, 2)}
    for idx, held in ((index, rows), (changed, list(state.values()))):
        for wanted, n in cases:
            def passes(r, wanted=wanted):
                return all((w[0] <= r[k] <= w[1]) if isinstance(w, tuple) else r[k] == w for a, w in wanted.items() for k in [{"kind": 2, "price": 3}[a]])

            reached = idx.reach(query, wanted, n)
            inside = {r[0] for r in idx.rows_of(reached).select("id").collect()}
            there = [r for r in held if r[0] in inside and passes(r)]
            assert reached == everywhere or len(there) >= n
            assert ids(idx.search_where(query, wanted, n)) == truth(there, query, n)
    assert len(index.reach(query, {"kind": "b"}, 5)) < len(everywhere) / 3
    assert index.reach(query, {"kind": "zz"}, 3) == everywhere


def test_an_empty_table(spark, tmp_path):
    index = CellIndex.build(spark.createDataFrame([], SCHEMA), str(tmp_path / "empty"), attributes=["kind"])
    assert index.search([1.0] * 12, 3).collect() == [] and index.search_where([1.0] * 12, {"kind": "a"}).collect() == []
    nothing = nearest(spark.createDataFrame([], SCHEMA), [1.0] * 12, 3)
    assert nothing.collect() == []
