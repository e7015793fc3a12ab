import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vicinity.functions.encode import HashedWords, encode, encode_text, encoder_info, loaded
from vicinity.operators.approx import (
    assign_cells,
    cell_search,
    cell_search_many,
    hashed_search,
    mean_vectors,
    recall_at_k,
    train_centroids,
    widening_search,
    write_cells,
)
from vicinity.operators.many import nearest_many
from vicinity.operators.topk import (
    candidate_sweep,
    compare_pairs,
    nearest,
    rank_results,
    row_vector,
    row_vectors,
    vector_by_name,
)
from vicinity.search import answer_requests, more_like, search, search_json

WIDTH = 384


def axis(*parts):
    v = np.zeros(WIDTH)
    for i, x in parts:
        v[i] = x
    return [float(x) for x in v / np.linalg.norm(v)]


@pytest.fixture(scope="module")
def shelf(spark):
    rows = [
        (1, "wheat", axis((0, 1.0))),
        (2, "citrus", axis((0, 0.9), (1, 0.1))),
        (3, "stout", axis((50, 1.0))),
        (4, "brown", axis((51, 1.0))),
        (5, "lager", axis((100, 1.0))),
        (6, "unembedded", None),
    ]
    return spark.createDataFrame(rows, "id long, beer_name string, embedding array<float>").cache()


def ids(df):
    return [r["id"] for r in df.collect()]


def test_order_by_distance_and_ties_by_id(shelf):
    hits = nearest(shelf, axis((0, 1.0)), 5, columns=["beer_name"]).collect()
    assert [h.beer_name for h in hits] == ["wheat", "citrus", "stout", "brown", "lager"]
    assert hits[0].distance == pytest.approx(0.0, abs=1e-6)
    assert hits[4].distance == pytest.approx(1.0, abs=1e-6)


def test_rows_without_a_vector_are_never_hits(shelf):
    assert 6 not in ids(nearest(shelf, axis((0, 1.0)), 50))


def test_a_zero_vector_ranks_behind_all_others_and_before_nothing(spark, shelf):
    more = shelf.unionByName(spark.createDataFrame([(0, "flat", [0.0] * WIDTH), (7, "none", None)], shelf.schema))
    for options in ({}, {"where": F.lit(True), "mode": "iterative"}, {"where": F.lit(True), "mode": "postfilter"}):
        hits = nearest(more, axis((0, 1.0)), 50, **options).collect()
        assert [h.id for h in hits] == [1, 2, 3, 4, 5, 0]
        assert hits[-1].distance is None


def test_limit_and_exclusion(shelf):
    assert ids(nearest(shelf, axis((0, 1.0)), 2)) == [1, 2]
    assert ids(nearest(shelf, axis((0, 1.0)), 2, where=F.col("id") != 1)) == [2, 3]


def test_point_lookups(shelf):
    assert row_vector(shelf, 3)[50] == 1.0
    assert vector_by_name(shelf, "lager", "beer_name")[100] == 1.0
    with pytest.raises(LookupError, match="row 99 not found"):
        row_vector(shelf, 99)
    with pytest.raises(LookupError, match="row 6 has no embedding yet"):
        row_vector(shelf, 6)
    with pytest.raises(LookupError):
        vector_by_name(shelf, "nobody", "beer_name")


def test_status_of_many_rows(spark, shelf):
    asked = spark.createDataFrame([(1,), (6,), (99,)], "id long")
    got = {r["id"]: r["status"] for r in row_vectors(shelf, asked).collect()}
    assert got == {1: "ok", 6: "no embedding", 99: "not found"}


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(400, 8)).astype("float32")
    points[[30, 31, 32]] = points[5]  # ties
    rows = [(i, int(i % 10 == 0), [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id long, rare int, embedding array<float>").repartition(7).cache()
    return df, points.astype("float64")


def brute(points, query, metric="cosine"):
    if metric == "cosine":
        d = 1 - points @ query / (np.linalg.norm(points, axis=1) * np.linalg.norm(query))
    elif metric == "l2":
        d = np.linalg.norm(points - query, axis=1)
    elif metric == "ip":
        d = -(points @ query)
    else:
        d = np.abs(points - query).sum(axis=1)
    return np.lexsort((np.arange(len(d)), np.round(d, 10)))


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip", "l1"])
def test_nearest_matches_brute_force(cloud, metric):
    df, points = cloud
    assert ids(nearest(df, points[5], 12, metric=metric)) == list(brute(points, points[5], metric)[:12])


def test_modes_on_a_rare_attribute(cloud):
    df, points = cloud
    order = brute(points, points[7])
    rare = [i for i in order if i % 10 == 0]
    where = F.col("rare") == 1
    assert ids(nearest(df, points[7], 10, where=where)) == rare[:10]
    for ef in (1, 15, 40, 400):
        among = [i for i in order[:ef] if i % 10 == 0][:10]
        assert ids(nearest(df, points[7], 10, where=where, mode="postfilter", ef=ef)) == among
        assert ids(nearest(df, points[7], 10, where=where, mode="iterative", max_scan=ef)) == among
    assert ids(nearest(df, points[7], 10, where=where, mode="iterative")) == rare[:10]
    with pytest.raises(ValueError):
        nearest(df, points[7], 10, where=where, mode="postfilter", ef=1001)
    with pytest.raises(ValueError):
        nearest(df, points[7], 10, mode="magic")


def test_sweep_counts_rows_returned_per_width(cloud):
    df, points = cloud
    order = brute(points, points[7])
    widths = [1, 10, 40, 100, 400, 1000]
    got = {r["ef"]: r["rows_returned"] for r in candidate_sweep(df, points[7], F.col("rare") == 1, 10, widths).collect()}
    assert got == {w: min(10, sum(i % 10 == 0 for i in order[:w])) for w in widths}


def test_no_row_passes(cloud):
    df, points = cloud
    nothing = F.col("rare") == 2
    assert ids(nearest(df, points[7], 10, where=nothing, mode="iterative")) == []
    assert {r[1] for r in candidate_sweep(df, points[7], nothing, 10, [10, 40]).collect()} == {0}


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip", "l1"])
@pytest.mark.parametrize("options", [{}, {"block_rows": 64, "query_block_rows": 48}])
def test_many_queries_match_brute_force(cloud, metric, options):
    df, points = cloud
    corpus = df.select("id", F.col("embedding").alias("vector"))
    queries = corpus.withColumnRenamed("id", "qid")
    got = {}
    for r in nearest_many(queries, corpus, 4, metric=metric, exclude_self=True, **options).collect():
        got.setdefault(r.qid, {})[r["rank"]] = r.id
    assert len(got) == 400
    for q, ranked in got.items():
        expected = [i for i in brute(points, points[q], metric) if i != q][:4]
        assert [ranked[k] for k in sorted(ranked)] == expected


def test_many_queries_without_queries(spark, cloud):
    df, _ = cloud
    none = spark.createDataFrame([], "qid long, vector array<float>")
    assert nearest_many(none, df.select("id", F.col("embedding").alias("vector"))).count() == 0


def test_skip_column_leaves_out_one_row_per_query(spark, shelf):
    asked = spark.createDataFrame([(7, axis((0, 1.0)), 1), (8, axis((0, 1.0)), None)], "qid long, vector array<float>, skip long")
    corpus = shelf.select("id", F.col("embedding").alias("vector"))
    got = {(r.qid, r.id) for r in nearest_many(asked, corpus, 2).collect()}
    assert got == {(7, 2), (7, 3), (8, 1), (8, 2)}


def test_pairs(spark, shelf):
    pairs = spark.createDataFrame([("same", 1, 1), ("apart", 1, 5)], "label string, a long, b long")
    got = {r.label: r for r in compare_pairs(shelf, pairs, attributes=["beer_name"]).collect()}
    assert got["same"].distance == pytest.approx(0.0, abs=1e-6)
    assert got["apart"].distance == pytest.approx(1.0) and got["apart"].beer_name_b == "lager"


def test_cells_given_trained_and_stored(spark, cloud, tmp_path):
    df, points = cloud
    given = mean_vectors(df.withColumn("g", F.col("id") % 6), "g").select(F.col("g").cast("int").alias("cell"), "centroid")
    trained = train_centroids(df, cells=9)
    for centroids, cells in ((given, 6), (trained, 9)):
        path = str(tmp_path / f"cells{cells}")
        write_cells(assign_cells(df, centroids), path)
        stored = spark.read.parquet(path)
        assert stored.count() == 400
        exact = list(brute(points, points[9])[:10])
        found = [len(set(exact) & set(ids(cell_search(stored, centroids, points[9], 10, p)))) for p in (1, 3, cells)]
        assert found == sorted(found) and found[-1] == 10
        assert ids(cell_search(stored, centroids, points[9], 10, cells)) == exact
        plan = cell_search(stored, centroids, points[9], 10, 1)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [(cell" in plan


def test_recall_grows_with_probes_in_both_ways(cloud):
    df, _ = cloud
    centroids = train_centroids(df, cells=8)
    corpus = assign_cells(df, centroids).select("id", "cell", F.col("embedding").alias("vector"))
    queries = corpus.select(F.col("id").alias("qid"), "vector")
    exact = nearest_many(queries, corpus.drop("cell"), 5).cache()
    before = 0.0
    for probes in (1, 3, 8):
        one = cell_search_many(queries, corpus, centroids, 5, probes)
        other = cell_search_many(queries, corpus, centroids, 5, probes, block_rows=16, query_block_rows=8)
        key = lambda d: sorted((r.qid, r["rank"], r.id) for r in d.collect())
        assert key(one) == key(other)
        recall = recall_at_k(one, exact, 5).agg(F.avg("recall")).first()[0]
        assert recall >= before
        before = recall
    assert before == 1.0


def test_widening_reaches_enough_rows(cloud):
    df, points = cloud
    centroids = train_centroids(df, cells=8)
    stored = assign_cells(df, centroids)
    where = F.col("rare") == 1
    assert len(ids(widening_search(stored, centroids, points[3], where, 10))) == 10
    everything = widening_search(stored, centroids, points[3], where, 40)
    assert ids(everything) == [i for i in brute(points, points[3]) if i % 10 == 0]
    assert len(ids(widening_search(stored, centroids, points[3], where, 10, max_scan=1))) < 10


def test_hashing_finds_the_row_itself(cloud):
    df, points = cloud
    assert ids(hashed_search(df, points[100], 3))[0] == 100


def test_hashed_words(spark):
    model = HashedWords(64)
    a, b, none = model.encode(["Sour cherry, sour!", "sour CHERRY sour", "…"])
    assert np.allclose(a, b) and np.isclose(np.linalg.norm(a), 1.0) and not none.any()
    assert model.encode([]).shape == (0, 64)
    assert encode_text("x", model) == [float(v) for v in model.encode(["x"])[0]]
    assert {r.setting for r in encoder_info(spark).collect()} >= {"model", "dimensions"}


def test_encode_column_keeps_null_and_uses_the_prefix(spark):
    df = spark.createDataFrame([(1, "oak"), (2, None), (3, "")], "id long, t string")
    rows = df.select("id", encode(F.col("t")).alias("v"), encode(F.col("t"), prefix="ask: ").alias("p")).orderBy("id").collect()
    assert rows[1].v is None and rows[1].p is None
    assert len(rows[0].v) == WIDTH and not any(rows[2].v)
    assert rows[0].p == encode_text("ask: oak")


def test_model_is_opened_once_per_key():
    calls = []
    key = ("test", object())
    assert loaded(key, lambda: calls.append(1) or "m") == "m" and loaded(key, lambda: calls.append(1)) == "m"
    assert len(calls) == 1


@pytest.fixture(scope="module")
def texts(spark):
    rows = [
        (1, "Lemon Wit", "A", "Wheat", "lemon and coriander wheat beer"),
        (2, "Citra", "B", "IPA", "lemon citrus hops"),
        (3, "Night", "C", "Stout", "dark roast coffee"),
        (4, "Night Two", "C", "Stout", "dark roast coffee"),
    ]
    df = spark.createDataFrame(rows, "id long, beer_name string, brewery string, style string, info string")
    return df.withColumn("embedding", encode(F.col("info"))).cache()


def test_search_and_more_like(texts):
    hits = search(texts, "lemon citrus", 2).collect()
    assert [h.id for h in hits] == [2, 1]
    assert hits[0].asDict().keys() == {"id", "beer_name", "brewery", "style", "distance"}
    assert [h.id for h in search(texts, "lemon", 5, where=F.col("info").ilike("%WHEAT%")).collect()] == [1]
    like = more_like(texts, 3, 1).collect()
    assert [(h.id, h.distance) for h in like] == [(4, 0.0)]
    assert len(search(texts, "lemon", 200).collect()) == 4
    assert len(more_like(texts, 3, 51).collect()) == 3
    with pytest.raises(ValueError, match="between 1 and 50"):
        search_json(texts, "lemon", 51)


def test_json_answer(texts):
    found = json.loads(search_json(texts, "lemon citrus", 3).first()[0])
    assert [f["id"] for f in found] == [2, 1, 3]
    assert set(found[0]) == {"id", "beer_name", "brewery", "style", "info", "distance"}
    for line in ("", ":like 3", "a" * 4001):
        with pytest.raises(ValueError):
            search_json(texts, line)


def test_request_lines_answered_together(spark, texts):
    asked = [(10, "lemon citrus"), (11, ":like 3"), (12, ":help"), (13, ":like 99"), (14, ":LIKE 3")]
    lines = spark.createDataFrame(asked, "qid long, line string")
    got = {}
    for r in answer_requests(lines, texts, n=2).collect():
        got.setdefault(r.qid, {})[r["rank"]] = r.id
    assert got[10] == {1: 2, 2: 1}
    assert got[11][1] == 4 and got[14] == got[11]
    assert 12 not in got and 13 not in got


def test_ranks(texts):
    assert [(r["rank"], r.id) for r in rank_results(search(texts, "coffee", 2)).orderBy("rank").collect()] == [(1, 3), (2, 4)]


def test_means_are_weighted(spark):
    df = spark.createDataFrame([(1, 1.0, [0.0, 2.0]), (1, 3.0, [4.0, 2.0]), (2, 1.0, None)], "g int, w double, embedding array<float>")
    assert [(r.g, r.centroid) for r in mean_vectors(df, "g", weight="w").collect()] == [(1, [3.0, 2.0])]
    assert mean_vectors(df).first().centroid == [2.0, 2.0]


def test_rows_travel_once_per_tile_not_once_per_block(spark):
    """However small the blocks, a side is copied as often as the other one has tiles."""
    corpus = spark.range(3000).selectExpr("id", "array(float(id % 7 + 1), float(id % 11), float(id)) AS vector")
    queries = corpus.withColumnRenamed("id", "qid")
    found = nearest_many(queries, corpus, 3, exclude_self=True, block_rows=16, query_block_rows=16)
    plan = found._jdf.queryExecution().executedPlan()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, nearest_many(queries, corpus, 3, exclude_self=True).collect()))
    copies = [int(n) for n in re.findall(r"Generate.*?number of output rows: (\d+)", metrics(plan))]
    assert len(copies) == 2 and max(copies) <= 2 * 3000


def metrics(plan):
    """The rows that each Generate of an executed plan has made, as text."""
    out, open_ = [], [plan]
    while open_:
        node = open_.pop()
        if node.nodeName() == "Generate":
            out.append(f"Generate number of output rows: {node.metrics().apply('numOutputRows').value()}")
        if node.nodeName() == "AdaptiveSparkPlan":
            open_.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            open_.append(node.plan())
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return "\n".join(out)


def test_encoder_keeps_slots_of_a_bounded_number_of_words():
    model = HashedWords(48)
    texts = [" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(300)]
    once = model.encode(texts[:2])
    for start in range(0, 300, 20):
        model.encode(texts[start : start + 20])
    assert len(loaded(("slots", 48), dict)) <= (1 << 17) + 20_001
    assert (model.encode(texts[:2]) == once).all()
