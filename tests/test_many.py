import numpy as np
import pytest

from vicinity.operators import many
from vicinity.operators.many import NO_SKIP, _Best, _look_by_clusters, pair_distances


def tile(seed, rows, width=24, kinds=12):
    """Rows around a few directions, some far from all of them, and copies."""
    rng = np.random.default_rng(seed)
    middle = rng.random((kinds, width)) ** 4
    out = middle[rng.integers(kinds, size=rows)] + rng.choice([0.02, 0.1, 1.0], (rows, 1), p=[0.6, 0.3, 0.1]) * rng.random((rows, width))
    copies = min(40, rows // 2)
    out[rows // 2 : rows // 2 + copies] = out[:copies]
    return rng.permutation(rows * 2)[:rows], out.astype("float32")


def brute(queries, skip, ids, rows, n):
    dist = pair_distances(rows.astype("float64"), queries, "cosine")
    dist[skip[:, None] == ids[None, :]] = np.inf
    order = np.lexsort((np.broadcast_to(ids, dist.shape), dist), axis=1)[:, :n]
    return {(q, int(ids[c])): pytest.approx(dist[q, c], abs=1e-11) for q in range(len(queries)) for c in order[q] if dist[q, c] < np.inf}


def answers(best):
    return {(q, i): d for q, i, d in zip(*(c.to_pylist() for c in best.batch().columns))}


@pytest.mark.parametrize(("rows", "n", "cluster_rows", "waiting"), [(3000, 5, 64, 1 << 20), (3000, 5, 64, 500), (700, 50, 512, 1 << 20), (90, 5, 2, 1), (3, 5, 2, 1)])
def test_tiles_looked_at_by_clusters_give_the_nearest_rows(monkeypatch, rows, n, cluster_rows, waiting):
    monkeypatch.setattr(many, "CLUSTER_ROWS", cluster_rows)
    monkeypatch.setattr(many, "WAITING", waiting)
    ids, vectors = tile(1, rows)
    queries = np.concatenate([vectors[:200], tile(2, 100)[1]]).astype("float64")
    skip = np.concatenate([ids[:200], np.full(100, NO_SKIP)])
    best = _Best(queries, np.arange(len(queries)), skip, n, "cosine")
    _look_by_clusters(best, ids, vectors)
    assert answers(best) == brute(queries, skip, ids, vectors, n)


def test_rows_of_one_vector_go_by_their_ids():
    ids = np.random.default_rng(0).permutation(2000)
    best = _Best(np.ones((3, 8)), np.arange(3), np.array([0, 7, NO_SKIP]), 4, "cosine")
    _look_by_clusters(best, ids, np.ones((2000, 8), "float32"))
    assert answers(best) == {(q, i): 0.0 for q, found in enumerate(([1, 2, 3, 4], [0, 1, 2, 3], [0, 1, 2, 3])) for i in found}


def test_most_pairs_of_a_clustered_tile_are_never_multiplied(monkeypatch):
    monkeypatch.setattr(many, "CLUSTER_ROWS", 64)
    ids, vectors = tile(3, 4000)
    best, pairs = _Best(vectors[:500].astype("float64"), ids[:500], ids[:500], 5, "cosine"), []
    near = best._near
    best._near = lambda part, found, *rest: pairs.append(len(part) * len(found)) or near(part, found, *rest)
    _look_by_clusters(best, ids, vectors)
    assert sum(pairs) < 0.5 * 500 * 4000


def test_exact_distances_wait_until_the_limits_are_known(monkeypatch):
    """A query passes dozens of rows that are the best so far; few are among the last."""
    ids, vectors = tile(4, 8000)
    best, settled = _Best(vectors[:300].astype("float64"), ids[:300], ids[:300], 5, "cosine"), []
    keep = best._keep
    best._keep = lambda owner, *rest: settled.append(len(owner)) or keep(owner, *rest)
    _look_by_clusters(best, ids, vectors)
    assert 300 * 5 <= sum(settled) < 300 * 8
