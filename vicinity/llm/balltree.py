"""Exact top-k inner products by ball trees, branch and bound.

Candidates are dealt to shards of bounded size; each shard's ball tree is built and
written once. A block of queries walks a tree with all its queries at once: a node is
visited by the queries whose upper bound (inner product with the centre plus query
length times radius) reaches their current kth score, the better child first. Scores
found in one shard are shared: blocks search a home shard first, then a few more, then
all others, and take their kth scores from wave to wave as lower limits, so that later
shards prune from the start. Trees stand still: query blocks are sorted behind the tree of
their shard and stream past it.

Vectors are whole numbers, floor(scale * x) with x as double, of any finite size. Scores
are exact: where products and sums may pass 2**53, vectors are split into parts of few
enough bits and the parts' products are added as Python integers. Ranks follow exact
scores; a score beyond a long is given as the nearest long.

Vectors that are null, empty or hold a null or non-finite component take no part, nor do
rows without id; only vectors of equal dimension are compared. A candidate with the
query's own id is never its hit. Rows that repeat an id are candidates each, and a
repeated query id is asked once per row. Ties go to the smaller id; fewer candidates than
k give all; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinity.llm.common import written

SHARD_BYTES = 16 << 20  # of vectors of a tree
SHARD = 16_384  # vectors of a tree, at most
LEAF = 128
BLOCK = 256  # queries that walk together
LONG = (1 << 63) - 1


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); Python integers where a double can't hold a component."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * float(scale))
    if np.isfinite(scaled).all():
        return scaled
    # a component that large is a whole number already
    return np.array([[int(v) * scale if abs(v) > 1e300 else int(w) for v, w in zip(r, s)] for r, s in zip(x, scaled)], object)


def estimates(v: np.ndarray) -> np.ndarray:
    """Doubles near whole vectors; infinite where a component is beyond doubles."""
    if v.dtype != object:
        return v
    return np.array([[float(x) if abs(x) < 10**300 else np.inf if x > 0 else -np.inf for x in r] for r in v], np.float64)


def limbs(v: np.ndarray, bits: int) -> list[np.ndarray]:
    """Whole doubles as signed parts of ``bits`` bits, lowest first; every step is exact."""
    sign, rest, out = np.sign(v), np.abs(v), []
    while rest.any():
        high = np.floor(rest / 2.0**bits)
        out.append(sign * (rest - high * 2.0**bits))
        rest = high
    return out


def exact_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """All inner products of whole vectors: doubles where these are exact, else Python
    integers."""
    if not len(q) or not len(v):
        return np.zeros((len(q), len(v)))
    if q.dtype == object or v.dtype == object:
        ints = lambda m: m if m.dtype == object else np.array([[int(x) for x in r] for r in m], object)
        return ints(q) @ ints(v).T
    if int(np.abs(q).max()) * int(np.abs(v).max()) * q.shape[1] < 1 << 53:
        return q @ v.T
    bits = (53 - q.shape[1].bit_length()) // 2
    total = np.zeros((len(q), len(v)), object)
    for i, a in enumerate(limbs(q, bits)):
        for j, b in enumerate(limbs(v, bits)):
            part = (a @ b.T).astype(np.int64).astype(object)
            total += part * (1 << bits * (i + j))
    return total


def order_key(score: int) -> str:
    """Text that sorts as scores do, the highest first."""
    digits = str(abs(score))
    if score < 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}" + digits.translate(_COMPLEMENT)


_COMPLEMENT = str.maketrans("0123456789", "9876543210")


def score_of(key: str) -> int:
    return -int(key[5:]) if key[0] == "1" else int(key[5:].translate(_COMPLEMENT))


class BallTree:
    """Nodes in preorder: bounds of their rows, children, centre, radius."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        # bounds are estimates with room for rounding; beyond doubles they prune nothing
        near = estimates(self.vectors)
        self.rows = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, int]] = []
        centres: list[np.ndarray] = []
        radii: list[float] = []
        stack = [(0, len(ids), -1, 0)]
        while stack:
            low, high, parent, side = stack.pop()
            at = len(self.nodes)
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, at, right) if side == 0 else (a, b, left, at)
            some = near[self.rows[low:high]]
            centre = some.mean(axis=0)
            away = ((some - centre) ** 2).sum(axis=1)
            centres.append(centre)
            radii.append(float(np.sqrt(away.max())) * (1 + 1e-9) + 1e-6 + 1e-12 * float(np.abs(some).max()))
            self.nodes.append((low, high, -1, -1))
            if high - low > LEAF and away.max() > 0:
                # towards the row farthest from the centre, and the one farthest from that
                one = some[int(away.argmax())]
                two = some[int(((some - one) ** 2).sum(axis=1).argmax())]
                along = some @ (two - one)
                half = (high - low) // 2
                self.rows[low:high] = self.rows[low:high][np.argpartition(along, half)]
                stack += [(low + half, high, at, 1), (low, low + half, at, 0)]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def search(
        self, ids: np.ndarray, queries: np.ndarray, best: list[list[tuple[int, int]]], k: int, limits: list[int | None]
    ) -> int:
        """Improve ``best``, each query's (-score, id) list in order; ``limits`` holds
        scores that hits must reach. Returns the number of scores computed."""
        q = estimates(queries)
        lengths = np.sqrt((q * q).sum(axis=1)) * (1 + 1e-9)
        sizes = np.sqrt((self.centres * self.centres).sum(axis=1))
        bounds = q @ self.centres.T + lengths[:, None] * (self.radii + 1e-9 * sizes) + 1e-3
        bounds = np.where(np.isnan(bounds), np.inf, bounds)
        limits = list(limits)
        least = np.array([-np.inf if v is None else below(v) for v in limits])
        done = 0
        stack = [(0, np.arange(len(ids)))]
        while stack:
            node, asking = stack.pop()
            asking = asking[bounds[asking, node] >= least[asking]]
            if not len(asking):
                continue
            low, high, left, right = self.nodes[node]
            if left >= 0:
                first = bounds[asking, left] >= bounds[asking, right]
                for group, near, far in ((asking[~first], right, left), (asking[first], left, right)):
                    if len(group):
                        stack += [(far, group), (near, group)]
                continue
            rows = np.sort(self.rows[low:high])
            scores = exact_scores(queries[asking], self.vectors[rows])
            done += scores.size
            others = self.ids[rows][None, :] != ids[asking][:, None]
            if scores.dtype == object:
                reach = np.array([[limits[i] is None or s >= limits[i] for s in r] for i, r in zip(asking, scores)], bool)
            else:
                reach = scores >= least[asking][:, None]
            reaching = others & reach
            for n in np.flatnonzero(reaching.any(axis=1)):
                i = asking[n]
                hits = np.flatnonzero(reaching[n])
                found = [-int(s) for s in scores[n, hits].tolist()]
                best[i] = sorted([*best[i], *zip(found, self.ids[rows[hits]].tolist(), strict=True)])[:k]
                if len(best[i]) == k and (limits[i] is None or -best[i][-1][0] > limits[i]):
                    limits[i] = -best[i][-1][0]
                    least[i] = below(limits[i])
        return done


def below(score: int) -> float:
    """A double that is not above a score."""
    try:
        near = float(score)
    except OverflowError:
        return -np.inf if score < 0 else np.finfo(float).max
    return near if near <= score else float(np.nextafter(near, -np.inf))


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and ``vector`` (array of double) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(id_col).isNotNull()
        & (F.size(x) > 0)
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    return rows.filter(usable).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("vector"))


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


HITS = "query_no long, query_id long, vec_id long, key string"


def build_trees(placed: DataFrame, scale: int) -> DataFrame:
    """(size, shard, vec_id, vector) to one tree per shard and size."""

    def run(table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore", invalid="ignore"):
            tree = BallTree(table.column("vec_id").to_numpy(), whole(matrix(table.column("vector")), scale))
        names = ["size", "shard", "tree"]
        return pa.table([table.column("size").slice(0, 1), table.column("shard").slice(0, 1), pa.array([pickle.dumps(tree, 5)], pa.binary())], names=names)

    return placed.groupBy("size", "shard").applyInArrow(run, "size int, shard long, tree binary")


def search_shards(trees: DataFrame, asked: DataFrame, k: int, scale: int) -> DataFrame:
    """``trees``: (size, shard, part, tree); ``asked``: rows of queries with size, shard and
    part. A task holds one tree at a time and one block of queries, whatever their number."""
    nothing = F.lit(None)
    left = trees.select("size", "shard", "part", F.lit(0).alias("side"), "tree", *[nothing.cast(t).alias(c) for c, t in QUERY])
    right = asked.select("size", "shard", "part", F.lit(1).alias("side"), nothing.cast("binary").alias("tree"), *[c for c, _ in QUERY])
    every = left.unionByName(right)
    tasks = int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = every.repartition(tasks, "size", "shard", "part").sortWithinPartitions("size", "shard", "part", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at = None, None
        for batch in batches:
            place = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            start = 0
            while start < len(place):
                if place[start][3] == 0:
                    tree, at = pickle.loads(batch.column(4)[start].as_py()), place[start][:3]
                    start += 1
                    continue
                stop = start
                while stop < len(place) and place[stop] == place[start] and stop - start < BLOCK:
                    stop += 1
                if at == place[start][:3]:  # else no candidate has the queries' size
                    yield walk(tree, batch.slice(start, stop - start), k, scale)
                start = stop

    return dealt.mapInArrow(run, HITS)


QUERY = (("query_no", "long"), ("query_id", "long"), ("vector", "array<double>"), ("limit", "string"))


def walk(tree: BallTree, block: pa.RecordBatch, k: int, scale: int) -> pa.RecordBatch:
    numbers, ids = block.column(5).to_pylist(), block.column(6).to_numpy()
    limits = [None if x is None else score_of(x) for x in block.column(8).to_pylist()]
    best: list[list[tuple[int, int]]] = [[] for _ in numbers]
    with np.errstate(over="ignore", invalid="ignore"):
        tree.search(ids, whole(matrix(block.column(7)), scale), best, k, limits)
    out = [(no, q, i, order_key(-s)) for no, q, hits in zip(numbers, ids.tolist(), best, strict=True) for s, i in hits]
    columns = list(zip(*out, strict=True)) if out else [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = ["query_no", "query_id", "vec_id", "key"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def as_long(key: Column) -> Column:
    """A key's score, or the nearest long."""
    digits = F.substring(key, 6, 10_000)
    high = F.substring(key, 1, 1) == "0"
    size = F.when(high, F.translate(digits, "0123456789", "9876543210")).otherwise(digits)
    most = F.lit(LONG).cast("decimal(20,0)")
    size = F.least(most, F.when(F.length(size) > 19, most).otherwise(size.try_cast("decimal(20,0)")))
    return F.when(high, size).otherwise(-size).cast("long")


def top_k(
    rows: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row that
    ``is_query`` (a condition on its vec_id) selects."""
    # rows are numbered once, when they are written
    numbered = usable_vectors(rows, id_col, vector_col).select("*", F.size("vector").alias("size"), F.monotonically_increasing_id().alias("row"))
    vectors = written(numbered, "vectors")
    n_rows, widest = vectors.agg(F.count("*"), F.max("size")).first()
    shards = max(1, -(-n_rows // min(SHARD, max(1, SHARD_BYTES // (8 * (widest or 1))))))
    # dealt by row, not by key: copies of a vector or an id spread over all shards
    turn = F.pmod(F.shiftright("row", 33) * 7919 + F.col("row"), F.lit(shards))
    trees = written(build_trees(vectors.withColumn("shard", turn), scale), "trees")
    # few shards are searched by several tasks each, so that all tasks have work
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    trees = trees.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    hashed = F.xxhash64("row")
    queries = vectors.filter(is_query).select(
        F.col("row").alias("query_no"),
        F.col("vec_id").alias("query_id"),
        "vector",
        "size",
        F.pmod(hashed, F.lit(shards)).alias("home"),
        F.pmod(F.shiftright(hashed, 32), F.lit(parts)).alias("part"),
    )
    order = F.struct("key", F.col("vec_id").alias("i"))
    # each query's next shards: its home, some more, and all others
    waves = sorted({0, 1, min(shards, 1 + round(shards**0.5)), shards})
    best = None
    for begin, end in zip(waves, waves[1:]):
        asked = queries.withColumn("limit", F.lit(None).cast("string"))
        if best is not None:
            limit = F.when(F.size("hits") == k, F.element_at("hits", -1)["key"]).alias("limit")
            asked = queries.join(best.select("query_no", limit), "query_no", "left")
        away = F.explode(F.sequence(F.lit(begin).cast("long"), F.lit(end - 1).cast("long")))
        asked = asked.withColumn("away", away).withColumn("shard", F.pmod(F.col("home") + F.col("away"), F.lit(shards)))
        found = search_shards(trees, asked, k, scale).select("query_no", "query_id", order.alias("hit"))
        if best is not None:
            found = found.unionByName(best.select("query_no", "query_id", F.explode("hits").alias("hit")))
        # at most k hits of each query from each shard meet here
        ranked = found.groupBy("query_no", "query_id").agg(F.slice(F.sort_array(F.collect_list("hit")), 1, k).alias("hits"))
        best = written(ranked, "hits")
    hit = best.select("query_id", F.posexplode("hits").alias("at", "hit"))
    return hit.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.i").alias("vec_id"), as_long(F.col("hit.key")).alias("score")
    )
