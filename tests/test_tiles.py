import glob

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vicinity.operators import many
from vicinity.operators.many import nearest_many, pair_distances
from vicinity.operators.tiles import read_tile, write_tiles
from vicinity.sources.files import reachable, shared_folder


def table(spark, kinds, **columns):
    arrays = [pa.array(list(c), kind) for c, kind in zip(columns.values(), kinds)]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)))


def points(seed, rows, width=6):
    """Around a few directions, some of them copies of others."""
    rng = np.random.default_rng(seed)
    out = (rng.random((7, width)) ** 3)[rng.integers(7, size=rows)] + 0.3 * rng.random((rows, width)) ** 4
    out[rows // 3 : rows // 2] = out[: rows // 2 - rows // 3]
    return out.astype("float32")


def expected(vectors, skip, ids, rows, n, metric):
    dist = pair_distances(rows.astype("float64"), vectors.astype("float64"), metric)
    dist[np.asarray(skip)[:, None] == ids[None, :]] = np.inf
    dist[np.isnan(dist)] = np.inf
    order = np.lexsort((np.broadcast_to(ids, dist.shape), dist), axis=1)[:, :n]
    return [[(int(ids[c]), pytest.approx(dist[q, c], abs=1e-11)) for c in order[q] if dist[q, c] < np.inf] for q in range(len(vectors))]


def found(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r.qid, r.rank)):
        out.setdefault(r.qid, []).append((r.id, r.distance))
    return out


def test_rows_of_many_tiles_are_written_once_not_once_per_tile_of_the_other_side(spark):
    rows = points(1, 20_000)
    ids = np.random.default_rng(2).permutation(20_000)
    df = table(spark, (pa.int64(), pa.list_(pa.float32())), id=ids, vector=rows)
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/tiles-*"))
    hits = nearest_many(df.withColumnRenamed("id", "qid"), df, 5, exclude_self=True)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan and "explode" not in plan
    (folder,) = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/tiles-*")) - before
    written = [read_tile(f)[0] for f in glob.glob(f"{folder}/*.arrow")]
    assert sum(len(c["qid"]) for c in written if "qid" in c) == 20_000
    assert sorted(i for c in written if "id" in c for i in c["id"].tolist()) == sorted(ids)
    got = found(hits)
    assert len(got) == 20_000
    some = range(0, 20_000, 97)
    want = expected(rows[some], ids[some], ids, rows, 5, "cosine")
    assert [got[ids[q]] for q in some] == want


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip", "l1"])
@pytest.mark.parametrize("kind", [pa.float32(), pa.float64()])
def test_tiles_in_files_give_the_nearest_rows(spark, monkeypatch, metric, kind):
    for name, value in {"COPIES": -1, "HELD_ROWS": 300, "HELD_QUERIES": 40, "LEAST_ROWS": 30, "TASKS": 8, "CLUSTER_ROWS": 16}.items():
        monkeypatch.setattr(many, name, value)
    monkeypatch.setattr(many, "CLUSTERED_PAIRS", 1 if kind == pa.float32() else 1 << 24)
    rows = points(3, 700).astype(kind.to_pandas_dtype())
    rows[5:9] = 0  # no direction
    if kind == pa.float64():
        rows[10:20] += 1e-9  # not in single precision
    ids = np.random.default_rng(4).permutation(2000)[:700]
    vectors = [None if i in (20, 30) else r.tolist() for i, r in enumerate(rows)]
    corpus = table(spark, (pa.int64(), pa.list_(kind)), id=ids, vector=vectors)
    asked = table(spark, (pa.int64(), pa.list_(kind), pa.int64()), qid=np.arange(150), vector=vectors[:150], skip=[None if i % 2 else int(ids[i]) for i in range(150)])
    got = found(nearest_many(asked, corpus, 4, metric=metric, block_rows=50))
    there = np.array([v is not None for v in vectors])
    want = expected(rows[:150], [-1 if i % 2 else ids[i] for i in range(150)], ids[there], rows[there], 4, metric)
    assert got == {q: w for q, w in enumerate(want) if there[q] and w}


def test_queries_and_rows_that_come_twice_are_found_twice(spark, monkeypatch):
    rows = points(5, 90)
    corpus = table(spark, (pa.int64(), pa.list_(pa.float32())), id=np.append(np.arange(90), np.arange(90)), vector=[*rows, *rows])
    asked = table(spark, (pa.int64(), pa.list_(pa.float32())), qid=[0, 1, 1, 2], vector=[rows[0], rows[1], rows[1], rows[2]])
    want = sorted(map(tuple, nearest_many(asked, corpus, 6).collect()))
    monkeypatch.setattr(many, "COPIES", -1)
    monkeypatch.setattr(many, "LEAST_ROWS", 20)
    assert sorted(map(tuple, nearest_many(asked, corpus, 6).collect())) == want


def test_no_rows_or_no_queries_give_none(spark, monkeypatch):
    monkeypatch.setattr(many, "COPIES", -1)
    some = table(spark, (pa.int64(), pa.list_(pa.float32())), id=[1, 2], vector=[[1.0, 2.0], [2.0, 1.0]])
    asked = some.withColumnRenamed("id", "qid")
    assert nearest_many(asked, some.limit(0), 2).collect() == []
    assert nearest_many(asked.limit(0), some, 2).collect() == []
    assert nearest_many(asked, some.withColumn("vector", F.lit(None).cast("array<float>")), 2).collect() == []


def test_vectors_of_other_dimensions_raise(spark, monkeypatch):
    monkeypatch.setattr(many, "COPIES", -1)
    kinds = (pa.int64(), pa.list_(pa.float32()))
    asked = table(spark, kinds, qid=[1], vector=[[1.0, 2.0]])
    with pytest.raises(Exception, match="different vector dimensions"):
        nearest_many(asked, table(spark, kinds, id=[1], vector=[[1.0, 2.0, 3.0]]), 2).collect()


def test_a_key_of_many_rows_gets_several_tiles(spark):
    rows = points(6, 500)
    df = table(spark, (pa.int64(), pa.list_(pa.float32())), id=[7] * 500, vector=rows)
    files = write_tiles(df, "id", 3, 120, shared_folder(spark, "one-key"), lambda columns, rows: np.arange(len(rows)), block_rows=50)
    read = [read_tile(f) for f in files]
    assert [len(c["id"]) for c, _, _ in read] == [100] * 5
    assert sorted(map(tuple, np.concatenate([r for _, r, _ in read]).tolist())) == sorted(map(tuple, rows.tolist()))


def test_a_query_without_a_number_raises(spark, monkeypatch):
    monkeypatch.setattr(many, "COPIES", -1)
    kinds = (pa.int64(), pa.list_(pa.float32()))
    corpus = table(spark, kinds, id=[1], vector=[[1.0, 2.0]])
    with pytest.raises(Exception, match="a query has no qid"):
        nearest_many(table(spark, kinds, qid=[1, None], vector=[[1.0, 2.0]] * 2), corpus, 2).collect()


def test_a_store_that_only_spark_opens_has_rows_shuffled(spark, monkeypatch):
    assert not reachable("nosuchstore://place/folder") and reachable("file:///tmp")
    monkeypatch.setattr(many, "COPIES", -1)
    monkeypatch.setattr(many, "reachable", lambda folder: False)
    df = table(spark, (pa.int64(), pa.list_(pa.float32())), id=[1, 2], vector=[[1.0, 2.0], [2.0, 1.0]])
    hits = nearest_many(df.withColumnRenamed("id", "qid"), df, 1)
    assert "CoGroup" in hits._jdf.queryExecution().optimizedPlan().toString()
    assert found(hits) == {1: [(1, 0.0)], 2: [(2, 0.0)]}
