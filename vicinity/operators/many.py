"""Nearest rows for many queries at once.

Queries and corpus are dealt into tiles of many rows. Inside cells, or if there are few
tiles, every tile of queries meets every tile of the corpus in a task of its own, block by
block; such a pair of tiles hands on at most ``n`` rows per query, and a row travels once
per tile of the other side. Where many copies of rows would travel so, tiles are written
to the shared folder once, and a task reads a tile of queries and one corpus tile after
the other: what is written grows with the rows, not with the pairs of tiles.

The answer is exact over the cells a query looks into. Without cells that is the whole
corpus: every query meets every row, which a caller chooses by giving no cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vicinity.functions.vectors import METRICS, to_matrix
from vicinity.operators.tiles import check_width, read_tile, write_tiles
from vicinity.sources.files import reachable, shared_folder

# Rows of a block: as many are compared at one time inside a task.
BLOCK_ROWS = 8192
QUERY_BLOCK_ROWS = 4096
# A side is dealt into TILES tiles, of LEAST_ROWS rows (inside a cell CELL_ROWS) at least
# and TILE_ROWS at most: at 384 dimensions a full tile is 100 MB.
TILES, LEAST_ROWS, CELL_ROWS, TILE_ROWS = 8, 2048, 16_384, 65_536
# Beyond COPIES rows that would travel besides the first time, tiles are kept in files: of
# about HELD_ROWS rows (queries: HELD_QUERIES) as they come, so that few pass TILE_ROWS, for
# TASKS tasks at least and three per core, as far as there are tiles.
COPIES, HELD_ROWS, HELD_QUERIES, TASKS = 1 << 17, 50_000, 25_000, 32
PAIRS_AT_ONCE = 1 << 20  # distances held at one time inside a task
NUMBERS_AT_ONCE = 1 << 21  # components of vectors copied at one time for exact distances
ROUNDED = 4e-12  # by which distances computed in two ways may differ
# Tiles that have as many pairs are looked at by clusters of about CLUSTER_ROWS rows, found in
# DIRECTIONS directions from LOOKED_AT rows of the tile, moved MOVES times.
CLUSTERED_PAIRS, CLUSTER_ROWS, DIRECTIONS, LOOKED_AT, MOVES = 1 << 24, 512, 4, 8192, 6
WAITING = 1 << 20  # pairs that wait for exact distances at one time
ROOM = 1e-6  # of chords, for rounding
FEW = 64  # rows that may be near to a query; beyond that a block is looked at as a whole
OUT = "qid long, id long, distance double"
NO_SKIP = np.iinfo("int64").min


def pair_distances(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """All distances between two blocks, one row per query.

    Rounded at 12 places: a matrix product may differ in the last bit between
    equal rows, and ties must stay ties for the id to break them.
    """
    if metric == "l1":
        out = np.stack([np.abs(rows - q).sum(axis=1) for q in queries])
    else:
        dots = queries @ rows.T
        if metric == "ip":
            out = -dots
        else:
            row_sq = np.einsum("ij,ij->i", rows, rows)
            query_sq = np.einsum("ij,ij->i", queries, queries)
            if metric == "l2":
                out = np.sqrt(np.maximum(query_sq[:, None] + row_sq[None, :] - 2 * dots, 0.0))
            else:
                lengths = np.sqrt(query_sq)[:, None] * np.sqrt(row_sq)[None, :]
                with np.errstate(divide="ignore", invalid="ignore"):
                    out = np.clip(1.0 - dots / lengths, 0.0, 2.0)
                out[lengths == 0] = np.nan
    return np.round(out, 12) + 0.0


def best_of(owner: np.ndarray, ids: np.ndarray, dist: np.ndarray, n: int):
    """The ``n`` nearest entries per owner, ties to the lower id."""
    order = np.lexsort((ids, dist, owner))
    owner, ids, dist = owner[order], ids[order], dist[order]
    keep = _places(owner) < n
    return owner[keep], ids[keep], dist[keep]


def directed(rows: np.ndarray) -> np.ndarray:
    """Which rows have a direction; others have no cosine distance to any."""
    return np.isfinite(rows).all(axis=1) & (np.einsum("ij,ij->i", rows, rows) > 0)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows with a direction at length one, in single precision."""
    return (rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]).astype("float32")


def enough_copies(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Which rows can be among the ``n`` best of a query that leaves out one id: of equal
    rows those with the lowest ids."""
    if not len(ids):
        return np.empty(0, "int64")
    mark = np.einsum("ij,j->i", rows, np.sqrt(np.arange(2.0, rows.shape[1] + 2)))
    order = np.lexsort((ids, mark))
    first = np.append(True, (rows[order[1:]] != rows[order[:-1]]).any(axis=1))
    starts = np.flatnonzero(first)
    place = np.arange(len(ids)) - starts[np.cumsum(first) - 1]
    most = n + np.unique(ids, return_counts=True)[1].max()
    return np.sort(order[place < most])


def _places(owner: np.ndarray) -> np.ndarray:
    """Place of each entry among those of its owner, entries of an owner being neighbours."""
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.empty(0, "int64")
    return np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))


class _Best:
    """Running best ``n`` rows per query inside one task.

    By cosine, products of single precision rule out the rows that are farther than the
    ``n`` best by more than their error; the distances of the others are computed exactly.
    Queries and rows must then have a direction.
    """

    def __init__(self, queries: np.ndarray, qids: np.ndarray, skip: np.ndarray, n: int, metric: str, most: int = QUERY_BLOCK_ROWS):
        self.queries, self.qids, self.n, self.metric, self.most = queries, qids, n, metric, most
        self.skip = skip  # id to leave out per query, NO_SKIP for none
        self.limit = np.full(len(qids), np.inf)  # distance of the n-th best so far
        self.ids, self.dist = np.zeros((len(qids), n), "int64"), np.full((len(qids), n), np.inf)
        if metric == "cosine":
            self.units = units(queries)
            self.alike = np.full((len(qids), n), -np.inf, "float32")  # highest products so far
            self.error = (queries.shape[1] + 16) * 1.2e-7  # of a product of unit vectors, bits of the bound included
            self.room = np.empty(0, "float32")  # for the products of a block, used again

    def add(self, ids: np.ndarray, rows: np.ndarray, unit: np.ndarray | None = None) -> None:
        """Look at some corpus rows for all queries; ``unit``: their ``units``, if known."""
        if not len(ids) or not len(self.qids):
            return
        if self.metric == "cosine":
            self.settle(*self.near(np.arange(len(self.qids)), ids, rows, unit), ids, rows)
            return
        step = max(1, min(self.most, PAIRS_AT_ONCE // len(ids)))
        parts = (np.arange(start, min(start + step, len(self.qids))) for start in range(0, len(self.qids), step))
        self._keep(*(np.concatenate(column) for column in zip(*[self._all(part, ids, rows) for part in parts])))

    def _keep(self, owner: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> None:
        """Take over exact distances."""
        touched = np.unique(owner)
        at, place = np.nonzero(self.dist[touched] < np.inf)
        at = touched[at]
        held = (at, self.ids[at, place], self.dist[at, place])
        owner, ids, dist = best_of(*(np.concatenate(x) for x in zip(held, (owner, ids, dist))), self.n)
        self.ids[owner, _places(owner)], self.dist[owner, _places(owner)] = ids, dist
        self.limit[touched] = np.minimum(self.limit[touched], self.dist[touched, -1])

    def _all(self, part: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple:
        dist = pair_distances(rows, self.queries[part], self.metric)
        # NaN (no direction) compares false, so such pairs drop out here.
        close = dist <= self.limit[part][:, None]
        if (self.skip[part] != NO_SKIP).any():
            close &= self.skip[part][:, None] != ids[None, :]
        if len(ids) > self.n:
            nth = np.partition(np.where(close, dist, np.inf), self.n - 1, axis=1)[:, self.n - 1]
            close &= dist <= nth[:, None]
        at, col = np.nonzero(close)
        return part[at], ids[col], dist[at, col]

    def near(self, wanted: np.ndarray, ids: np.ndarray, rows: np.ndarray, unit: np.ndarray | None = None) -> tuple:
        """Pairs of the wanted queries (their places) and rows (theirs) that may be among the
        ``n`` best, by products of single precision, and those: owner, row, product."""
        unit = units(rows) if unit is None else unit
        step = max(1, min(self.most, PAIRS_AT_ONCE // len(ids)))
        parts = (wanted[start : start + step] for start in range(0, len(wanted), step))
        found = [self._near(part, ids, rows, unit) for part in parts]
        return tuple(np.concatenate(column) for column in zip(*found))

    def _near(self, part: np.ndarray, ids: np.ndarray, rows: np.ndarray, unit: np.ndarray) -> tuple:
        size = len(part) * len(ids)
        if len(self.room) < size:
            self.room = np.empty(size, "float32")
        alike = self.room[:size].reshape(len(part), len(ids))
        np.matmul(self.units.take(part, axis=0), unit.T, out=alike)
        low = np.maximum(1 - self.limit[part] - self.error, -3)
        self._lift(np.flatnonzero(np.isinf(self.limit[part])), low, part, ids, alike)
        some = np.flatnonzero(alike.max(axis=1) >= low.astype("float32"))
        if 2 * len(some) < len(part):
            part, low, alike = part[some], low[some], alike[some]
        hits = lambda: np.divmod(np.flatnonzero((alike >= low.astype("float32")[:, None]).ravel()), len(ids))
        at, col = hits()
        crowded = np.flatnonzero(np.bincount(at, minlength=len(part)) > FEW + self.n)
        if len(crowded):
            self._lift(crowded, low, part, ids, alike)
            at, col = hits()
        likeness = alike[at, col]
        many = np.bincount(at, minlength=len(part)) > FEW + self.n
        if many.any():
            dist = pair_distances(rows.astype("float64"), self.queries[part[many]], self.metric)
            dist[self.skip[part[many]][:, None] == ids[None, :]] = np.inf
            most = self.limit[part[many]]
            if len(ids) > self.n:
                most = np.minimum(most, np.partition(dist, self.n - 1, axis=1)[:, self.n - 1])
            at_, col_ = np.nonzero((dist <= most[:, None] + ROUNDED) & (dist < np.inf))
            few = ~many[at]
            at, col = np.append(at[few], np.flatnonzero(many)[at_]), np.append(col[few], col_)
            likeness = np.append(likeness[few], (1 - dist[at_, col_]).astype("float32"))
        owner = part[at]
        kept = self.skip[owner] != ids[col]
        owner, col, likeness = owner[kept], col[kept], likeness[kept]
        touched = np.unique(owner)
        place = np.repeat(touched, self.n)
        each, _, high = best_of(np.append(place, owner), np.zeros(len(place) + len(owner), "int8"), -np.append(self.alike[touched], likeness), self.n)
        self.alike[touched] = -high.reshape(len(touched), self.n)
        nth = self.alike[touched, -1].astype("float64")
        self.limit[touched] = np.minimum(self.limit[touched], 1 - nth + self.error)
        return owner, col, likeness

    def _lift(self, these: np.ndarray, low: np.ndarray, part: np.ndarray, ids: np.ndarray, alike: np.ndarray) -> None:
        """Raise the least product of these queries to what the block alone asks for."""
        own = these[np.isin(self.skip[part[these]], ids)]
        alike[own] = np.where(self.skip[part[own]][:, None] == ids[None, :], np.float32(-4), alike[own])
        if len(ids) > self.n and len(these):
            place = len(ids) - self.n
            low[these] = np.maximum(low[these], np.partition(alike[these], place, axis=1)[:, place] - 2 * self.error)

    def settle(self, owner: np.ndarray, at: np.ndarray, likeness: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Exact distances of the pairs that may still be among the ``n`` best."""
        near = likeness >= (1 - self.limit[owner] - self.error).astype("float32")
        owner, at = owner[near], at[near]
        step = max(1, NUMBERS_AT_ONCE // self.queries.shape[1])
        # equal pairs get equal bits here, whatever block they are in
        for start in range(0, len(at), step):
            a, c = owner[start : start + step], at[start : start + step]
            asked, stored = self.queries[a], rows[c].astype("float64")
            dots = np.einsum("ij,ij->i", asked, stored)
            lengths = np.sqrt(np.einsum("ij,ij->i", asked, asked)) * np.sqrt(np.einsum("ij,ij->i", stored, stored))
            dist = np.round(np.clip(1.0 - dots / lengths, 0.0, 2.0), 12) + 0.0
            kept = dist <= self.limit[a]
            self._keep(a[kept], ids[c[kept]], dist[kept])

    def batch(self) -> pa.RecordBatch:
        owner, place = np.nonzero(self.dist < np.inf)
        columns = [self.qids[owner], self.ids[owner, place], self.dist[owner, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["qid", "id", "distance"])


def _flat(unit: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors in few directions and, as one more, the length of their rest. Two of
    them are at most as far from each other here as they were."""
    part = unit @ basis
    rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", part, part), 0))
    return np.concatenate([part, rest[:, None]], axis=1)


def _gaps(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of points to centres, one row per point."""
    square = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", centres, centres)[None, :]
    return np.sqrt(np.maximum(square - 2 * points @ centres.T, 0))


def _centres(points: np.ndarray, most: int) -> np.ndarray:
    """Centres of about equal parts of some points, moved to their means a few times."""
    order = np.lexsort(points.T[::-1])
    centres = points[order[np.linspace(0, len(points) - 1, min(most, len(points))).astype("int64")]]
    for _ in range(MOVES):
        nearest = _gaps(points, centres).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(centres))
        sums = np.stack([np.bincount(nearest, x, len(centres)) for x in points.T], axis=1)
        centres = sums[count > 0] / count[count > 0, None]
    return centres


def _clusters(rows: np.ndarray) -> tuple[np.ndarray, dict]:
    """The order of rows by cluster; directions, centres, ends and radii of the clusters.

    Distances are chords between unit vectors, as in ``pruned``, taken in the few
    directions in which the rows differ most, where clusters are narrow.
    """
    sample = _of_length_one(rows[np.linspace(0, len(rows) - 1, min(len(rows), LOOKED_AT)).astype("int64")].astype("float64"))
    basis = np.linalg.eigh(sample.T @ sample)[1][:, -DIRECTIONS:]
    centres = _centres(_flat(sample, basis), max(1, len(rows) // CLUSTER_ROWS))
    nearest, gap = [], []
    for piece in _pieces(rows):
        far = _gaps(_flat(_of_length_one(piece), basis), centres)
        nearest.append(far.argmin(axis=1))
        gap.append(far.min(axis=1))
    nearest, gap = np.concatenate(nearest), np.concatenate(gap)
    ends = np.cumsum(np.bincount(nearest, minlength=len(centres)))
    radius = np.zeros(len(centres))
    np.maximum.at(radius, nearest, gap)
    return np.argsort(nearest, kind="stable"), {"basis": basis, "centres": centres, "ends": ends, "radius": radius}


def _of_length_one(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _pieces(rows: np.ndarray) -> Iterator[np.ndarray]:
    return (rows[i : i + BLOCK_ROWS].astype("float64") for i in range(0, len(rows), BLOCK_ROWS))


def _look_by_clusters(best: _Best, ids: np.ndarray, rows: np.ndarray, clusters: dict | None = None) -> None:
    """Look at all rows, by clusters: a query first meets the cluster nearest to it, then
    those that its distance to their centre and their radius leave room for. ``clusters``:
    those of rows that are in their order already."""
    order = np.arange(len(ids))
    if clusters is None:
        order, clusters = _clusters(rows)
    basis, centres, ends, radius = (clusters[k] for k in ("basis", "centres", "ends", "radius"))
    least, home = np.empty((len(centres), len(best.qids)), "float32"), np.empty(len(best.qids), "int64")
    start = 0
    for piece in _pieces(best.queries):
        far = _gaps(_flat(_of_length_one(piece), basis), centres)
        least[:, start : start + len(piece)] = (far - radius).T
        home[start : start + len(piece)] = far.argmin(axis=1)
        start += len(piece)
    waiting, count = [], 0
    for first in (True, False):
        for i, (begin, end) in enumerate(zip(np.append(0, ends), ends)):
            wanted = (least[i] <= np.sqrt(2 * (best.limit + ROUNDED)) + ROOM) & ((home == i) == first)
            if begin == end or not wanted.any():
                continue
            held = order[begin:end]
            owner, at, likeness = best.near(np.flatnonzero(wanted), ids[held], part := rows[held], units(part.astype("float64")))
            waiting.append((owner, held[at], likeness))
            count += len(owner)
            if count > WAITING:
                best.settle(*(np.concatenate(x) for x in zip(*waiting)), ids, rows)
                waiting, count = [], 0
    if waiting:
        best.settle(*(np.concatenate(x) for x in zip(*waiting)), ids, rows)


def _merge(partial: DataFrame, n: int, repeated: bool) -> DataFrame:
    """Top ``n`` per query out of the top ``n`` of every task, each row once."""
    if repeated:
        partial = partial.groupBy("qid", "id").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("qid").orderBy("distance", "id")
    ranked = partial.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= n).select("qid", "id", "distance", "rank")


def _tiles(rows: Column, least: int) -> Column:
    side = F.greatest(F.lit(least), F.least(F.lit(TILE_ROWS), F.ceil(rows / TILES)))
    return F.greatest(F.lit(1), F.ceil(rows / side)).cast("long")


def _number_of_tiles(rows: int, most: int) -> int:
    """``_tiles`` of a whole table, known before the plan is made."""
    return max(1, -(-rows // max(LEAST_ROWS, min(most, -(-rows // TILES)))))


def _counts(queries: DataFrame, corpus: DataFrame) -> tuple[int, int]:
    sides = [df.agg(F.lit(i).alias("side"), F.count("*").alias("rows")) for i, df in enumerate((queries, corpus))]
    return tuple(r.rows for r in sorted(sides[0].unionAll(sides[1]).collect()))


def _with_sizes(df: DataFrame, sizes: dict[str, DataFrame | int], keys: list[str]) -> DataFrame:
    """Add the numbers of tiles: of the row's cell, or of the whole table."""
    for name, size in sizes.items():
        df = df.join(size, keys) if keys else df.withColumn(name, F.lit(size).cast("long"))
    return df


def vectors_of(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [to_matrix(chunk, width) for chunk in column.chunks]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _block_join(
    queries: DataFrame, corpus: DataFrame, n: int, metric: str, block_rows: int, query_block_rows: int, repeated: bool, sizes: dict[str, int]
) -> DataFrame:
    """Query tiles meet corpus tiles on (cell, group, tile); each pair gives top ``n``.

    A big cell is split into as many tiles as it needs, so no key holds more than a tile
    of each side, however unevenly the cells are filled. Without cells ``sizes`` has the
    numbers of tiles.
    """

    keys = ["cell"] if "cells" in queries.columns else []
    if keys:
        queries = queries.withColumn("cell", F.explode("cells")).drop("cells")
        sizes = {
            name: df.groupBy("cell").agg(_tiles(F.count("*"), CELL_ROWS).alias(name))  # one row per cell
            for df, name in ((corpus, "tiles"), (queries, "groups"))
        }
    number = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    at = lambda key, c: F.pmod(F.xxhash64(key), F.col(c))
    on = [*keys, "group", "tile"]
    left = _with_sizes(queries, sizes, keys).withColumn("group", at("qid", "groups")).withColumn("tile", number("tiles"))
    right = _with_sizes(corpus, sizes, keys).withColumn("tile", at("id", "tiles")).withColumn("group", number("groups"))
    # new names, as both sides may be of one table
    left = left.select(*[F.col(c).alias(c) for c in (*on, "qid", "skip", "vector")])
    right = right.select(*[F.col(c).alias(c) for c in (*on, "id", "vector")])

    def search(asked: pa.Table, stored: pa.Table) -> pa.Table:
        width = pc.max(pc.list_value_length(asked["vector"])).as_py() if len(asked) and len(stored) else None
        if not width:
            return pa.table({"qid": pa.array([], "int64"), "id": pa.array([], "int64"), "distance": pa.array([], "float64")})
        # rows without a vector are dropped here: as a filter in the plan, the
        # test would have a computed vector computed twice
        matrix, asks = vectors_of(asked["vector"], width)
        qids, skip = asked["qid"].to_numpy()[asks], asked["skip"].to_numpy()[asks]
        if metric == "cosine":
            asks = directed(matrix)
            matrix, qids, skip = matrix[asks], qids[asks], skip[asks]
        best = _Best(matrix, qids, skip, n, metric, query_block_rows)
        clustered = metric == "cosine" and len(asked) * len(stored) >= CLUSTERED_PAIRS
        if clustered:
            double = pa.types.is_float64(stored["vector"].type.value_type)
            kept, every, end = np.empty(len(stored), "int64"), np.empty((len(stored), width), "float64" if double else "float32"), 0
        for start in range(0, len(stored), block_rows):
            block = stored.slice(start, block_rows)
            rows, there = vectors_of(block["vector"], width)
            ids = block["id"].to_numpy()[there]
            if metric == "cosine":
                there = directed(rows)
                ids, rows = ids[there], rows[there]
                there = enough_copies(ids, rows, n)
                ids, rows = ids[there], rows[there]
            if clustered:
                kept[end : end + len(ids)], every[end : end + len(ids)] = ids, rows
                end += len(ids)
            else:
                best.add(ids, rows)
        if clustered and end and len(qids):
            _look_by_clusters(best, kept[:end], every[:end])
        return pa.Table.from_batches([best.batch()])

    met = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(search, OUT)
    return _merge(met, n, repeated)


def _held_join(
    queries: DataFrame, corpus: DataFrame, n: int, metric: str, block_rows: int, query_block_rows: int, repeated: bool, counts: tuple[int, int], folder: str
) -> DataFrame:
    """Tiles of both sides are written once; a task reads a tile of queries and its share
    of the corpus tiles, and hands on the top ``n`` of all those."""
    spark = corpus.sparkSession
    queries = queries.withColumn("qid", F.coalesce("qid", F.raise_error(F.lit("a query has no qid")).cast("long")))
    groups, tiles = _number_of_tiles(counts[0], HELD_QUERIES), _number_of_tiles(counts[1], HELD_ROWS)
    cosine = metric == "cosine"
    clustered = cosine and counts[0] / groups * (counts[1] / tiles) >= CLUSTERED_PAIRS

    def keep(columns: dict, rows: np.ndarray) -> np.ndarray:
        if not cosine:
            return np.arange(len(rows))
        kept = np.flatnonzero(directed(rows))
        return kept[enough_copies(columns["id"][kept], rows[kept], n)] if "id" in columns else kept

    stored = write_tiles(corpus, "id", tiles, TILE_ROWS, folder, keep, _clusters if clustered else None, block_rows)
    asked = write_tiles(queries, "qid", groups, TILE_ROWS // 2, folder, keep)
    # shares of the corpus: one, unless there would be too few tasks
    shares = min(len(stored), -(-max(TASKS, 3 * spark.sparkContext.defaultParallelism) // max(1, len(asked))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                columns, queries, _ = read_tile(asked[task // shares])
                best = _Best(queries.astype("float64"), columns["qid"], columns["skip"], n, metric, query_block_rows)
                for uri in stored[task % shares :: shares]:
                    columns, rows, clusters = read_tile(uri)
                    check_width(rows.shape[1], queries.shape[1])
                    if clusters:
                        _look_by_clusters(best, columns["id"], rows, clusters)
                        continue
                    for start in range(0, len(rows), block_rows):
                        here = slice(start, start + block_rows)
                        best.add(columns["id"][here], rows[here].astype("float64"))
                yield best.batch()

    tasks = len(asked) * shares
    met = spark.range(0, tasks, 1, max(1, tasks)).mapInArrow(search, OUT)
    return _merge(met, n, repeated)


def nearest_many(
    queries: DataFrame,
    corpus: DataFrame,
    n: int = 5,
    *,
    metric: str = "cosine",
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    query_block_rows: int = QUERY_BLOCK_ROWS,
    repeated: bool = False,
) -> DataFrame:
    """The ``n`` nearest corpus rows of every query: qid, id, distance, rank.

    ``queries`` has ``qid`` and ``vector``, ``corpus`` has ``id`` and ``vector``.
    A ``skip`` column on the queries names a corpus id to leave out
    (``exclude_self``: the query's own). With a ``cells`` array on the queries
    and a ``cell`` on the corpus, a query looks only into its cells. ``repeated``: a
    corpus row may lie in several cells.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, use one of {METRICS}")
    celled = "cells" in queries.columns
    skip = F.col("qid") if exclude_self else F.col("skip") if "skip" in queries.columns else F.lit(None)
    queries = queries.select(
        F.col("qid").cast("long").alias("qid"),
        "vector",
        F.coalesce(skip.cast("long"), F.lit(int(NO_SKIP))).alias("skip"),
        *(["cells"] if celled else []),
    )
    corpus = corpus.select(
        F.col("id").cast("long").alias("id"), "vector", *(["cell"] if celled else [])
    )
    options = (n, metric, block_rows, query_block_rows, repeated)
    if celled:
        return _block_join(queries, corpus, *options, {})
    asked, stored = counts = _counts(queries, corpus)
    sizes = {"tiles": _number_of_tiles(stored, TILE_ROWS), "groups": _number_of_tiles(asked, TILE_ROWS)}
    if asked * (sizes["tiles"] - 1) + stored * (sizes["groups"] - 1) > COPIES:
        folder = shared_folder(corpus.sparkSession, "tiles")
        if reachable(folder):
            return _held_join(queries, corpus, *options, counts, folder)
    return _block_join(queries, corpus, *options, sizes)
