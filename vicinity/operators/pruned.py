"""Exact nearest rows for many queries, without the blocks that can't hold one.

Rows and queries are put into cells (see ``cells``) and packed into blocks, each with a
centre and a radius. First every query is ranked in its own cell, which gives it a limit:
the distance of its n-th best so far. A pair of blocks is then looked at only if the
triangle inequality leaves room for a distance within the largest limit of its queries;
groups of cells are ruled out before the blocks inside them. Distances are chords between
unit vectors, in the order of cosine distance, for which the inequality holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vicinity.functions.vectors import to_matrix
from vicinity.operators.cells import SENT_BYTES, descend, train_tree
from vicinity.operators.many import BLOCK_ROWS as BLOCK_ROWS_AT_ONCE
from vicinity.operators.many import LEAST_ROWS, NO_SKIP, OUT, TILE_ROWS, TILES, _Best, _merge, nearest_many, units
from vicinity.session import materialize

BLOCK_ROWS = 2048
ROOM = 1e-6  # of chords, for rounding

_BLOCK = "cell int, no long, rows array<struct<id: long, vector: array<float>, skip: long, most: double>>, centre array<double>, radius double, most double"


def _packed(placed: DataFrame, block_rows: int) -> DataFrame:
    """(cell, id, vector, skip, most) to blocks of a cell with centre, radius and limit."""
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("blocks"))
    numbered = placed.join(sizes, "cell").withColumn("no", F.pmod(F.xxhash64("id"), F.col("blocks")))
    rows = F.collect_list(F.struct("id", "vector", "skip", "most")).alias("rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column(2)[i].values
                unit = _unit(held.field("vector"))
                centre = unit.mean(axis=0)
                radius = float(np.sqrt(((unit - centre) ** 2).sum(axis=1).max()))
                one = batch.slice(i, 1)
                most = pc.max(held.field("most")).as_py()
                columns = [*one.columns, pa.array([centre.tolist()]), pa.array([radius]), pa.array([most], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "no", "rows", "centre", "radius", "most"])

    return numbered.groupBy("cell", "no").agg(rows).mapInArrow(run, _BLOCK)


def _unit(vectors: pa.Array) -> np.ndarray:
    rows, _ = to_matrix(vectors, pc.max(pc.list_value_length(vectors)).as_py())
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def chord(distance: float | np.ndarray) -> float | np.ndarray:
    return np.sqrt(2 * np.maximum(distance, 0)) + ROOM


def pruned_blocks(
    queries: DataFrame, corpus: DataFrame, n: int, cells: int | None = None, block_rows: int = BLOCK_ROWS, exclude_self: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hits inside each query's own cell, pairs of blocks left to look at (query_cell,
    query_no, cell, no), and the blocks of queries and corpus (side, cell, no, rows)."""
    # vectors without a direction are no hits and have none
    has = F.exists("vector", lambda x: x != 0)
    corpus = materialize(corpus.filter(has).select(F.col("id").cast("long").alias("id"), "vector"), "pruned-corpus")
    skip = F.col("qid") if exclude_self else F.lit(None)
    queries = queries.filter(has).select(F.col("qid").cast("long").alias("qid"), "vector", F.coalesce(skip.cast("long"), F.lit(int(NO_SKIP))).alias("skip"))
    groups, centroids = train_tree(corpus, cells or max(2, round((corpus.count() / 64) ** 0.5 * 2)), "vector")
    placed = materialize(descend(corpus, groups, centroids, "vector"), "placed-corpus")
    asked = materialize(descend(queries, groups, centroids, "vector"), "placed-queries")
    own = nearest_many(asked.withColumn("cells", F.array("cell")), placed, n)
    own = materialize(own, "own-cell")
    limits = own.filter(F.col("rank") == n).select("qid", F.col("distance").alias("most"))
    unlimited = F.coalesce("most", F.lit(2.0)).alias("most")
    asked = asked.join(limits, "qid", "left").select("cell", F.col("qid").alias("id"), "vector", "skip", unlimited)
    nothing = placed.select("cell", "id", "vector", F.lit(0).cast("long").alias("skip"), F.lit(0.0).alias("most"))
    sides = [_packed(f, block_rows).withColumn("side", F.lit(s)) for s, f in (("query", asked), ("corpus", nothing))]
    blocks = materialize(sides[0].unionByName(sides[1]), "blocks")

    of_group = centroids.select("cell", "group")
    stored = blocks.filter("side = 'corpus'").select("cell", "no", "centre", "radius").join(of_group, "cell")
    held = _group_bounds(stored, groups)
    asking = blocks.filter("side = 'query'").select("cell", "no", "centre", "radius", "most")
    sent = queries.sparkSession.sparkContext.broadcast(held)

    @F.arrow_udf("array<int>")
    def open_groups(centre: pa.Array, radius: pa.Array, most: pa.Array) -> pa.Array:
        numbers, matrix, radii = sent.value
        if not len(numbers):
            return pa.array([[]] * len(centre), pa.list_(pa.int32()))
        rows = np.array(centre.to_pylist())
        reach = (radius.to_numpy() + chord(most.to_numpy()))[:, None] + radii
        near = np.sqrt(np.maximum(((rows[:, None, :] - matrix[None]) ** 2).sum(axis=2), 0)) <= reach + ROOM
        return pa.array([numbers[x].tolist() for x in near], pa.list_(pa.int32()))

    opened = asking.withColumn("group", F.explode(open_groups("centre", "radius", "most")))
    opened = opened.select(F.col("cell").alias("query_cell"), F.col("no").alias("query_no"), "group", *[F.col(c).alias(f"query_{c}") for c in ("centre", "radius")], "most")
    gap = F.sqrt(F.aggregate(F.zip_with("query_centre", "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    room = F.col("query_radius") + F.col("radius") + F.sqrt(2 * F.col("most")) + 2 * ROOM
    pairs = opened.join(stored, "group").filter((F.col("query_cell") != F.col("cell")) & (gap <= room))
    return own, materialize(pairs.select("query_cell", "query_no", "cell", "no"), "block-pairs"), blocks


def _group_bounds(stored: DataFrame, groups: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, centre and radius of each group that has blocks; about the square root of
    the cells, checked."""
    unit = groups.select("group", F.col("centroid").alias("middle"))
    away = F.sqrt(F.aggregate(F.zip_with("middle", "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    found = stored.join(unit, "group").groupBy("group").agg(F.max(away + F.col("radius")).alias("radius"), F.first("middle").alias("middle"))
    size = found.agg(F.sum(F.size("middle").cast("long") * 8)).first()[0] or 0
    if size > SENT_BYTES:
        raise ValueError("the groups are too large to be sent; use fewer cells")
    rows = sorted(found.select("group", "middle", "radius").collect())
    return np.array([r[0] for r in rows], "int32"), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])


def nearest_many_pruned(
    queries: DataFrame, corpus: DataFrame, n: int = 5, *, cells: int | None = None, block_rows: int = BLOCK_ROWS, exclude_self: bool = False
) -> DataFrame:
    """The rows of ``nearest_many`` by cosine: qid, id, distance, rank.

    Blocks travel in tiles of many blocks: a query block goes once to each tile of the corpus
    that holds a block it has to look at, with the numbers of those, and a corpus block once
    to each tile of queries that has to look at it.
    """
    own, pairs, blocks = pruned_blocks(queries, corpus, n, cells, block_rows, exclude_self)
    tiles = _tiled(blocks, block_rows)
    asking = tiles.filter("side = 'query'").select(*[F.col(c).alias(f"query_{c}") for c in ("cell", "no", "tile")])
    looked = tiles.filter("side = 'corpus'").select("cell", "no", "tile", "place")
    pairs = pairs.join(asking, ["query_cell", "query_no"]).join(looked, ["cell", "no"])
    pairs = materialize(pairs, "tile-pairs")
    left = pairs.groupBy("query_cell", "query_no", "query_tile", "tile").agg(F.collect_list("place").alias("places"))
    asked = blocks.filter("side = 'query'").select(F.col("cell").alias("query_cell"), F.col("no").alias("query_no"), F.col("rows").alias("asked"))
    left = left.join(asked, ["query_cell", "query_no"]).select("query_tile", "tile", "places", "asked")
    right = pairs.select("cell", "no", "query_tile", "tile", "place").distinct()
    stored = blocks.filter("side = 'corpus'").select("cell", "no", F.col("rows").alias("stored"))
    right = right.join(stored, ["cell", "no"]).select("query_tile", "tile", "place", "stored")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])

    def search(asking: pa.Table, held: pa.Table) -> pa.Table:
        found = [pa.table({"qid": pa.array([], "int64"), "id": pa.array([], "int64"), "distance": pa.array([], "float64")})]
        if not len(asking) or not len(held):
            return found[0]
        held = held.sort_by("place").combine_chunks()
        lists = held["stored"].chunk(0)
        flat = lists.flatten()
        width = pc.max(pc.list_value_length(flat.field("vector"))).as_py()
        ids, rows = flat.field("id").to_numpy(), to_matrix(flat.field("vector"), width)[0]
        unit = units(rows)
        ends = np.cumsum(lists.value_lengths().to_numpy())
        of_place = {p: i for i, p in enumerate(held["place"].to_pylist())}
        for batch in asking.to_batches(max_chunksize=1):
            block = batch.column("asked")[0].values
            best = _Best(to_matrix(block.field("vector"), width)[0], block.field("id").to_numpy(), block.field("skip").to_numpy(), n, "cosine")
            best.limit = block.field("most").to_numpy().copy()
            wanted = sorted(of_place[p] for p in batch.column("places")[0].as_py())
            for first, last in _runs(wanted, ends):
                best.add(ids[first:last], rows[first:last], unit[first:last])
            found.append(pa.Table.from_batches([best.batch()]))
        return pa.concat_tables(found)

    met = left.groupBy("query_tile", "tile").cogroup(right.groupBy("query_tile", "tile")).applyInArrow(search, OUT)
    return _merge(own.select("qid", "id", "distance").unionByName(met), n, False)


def _tiled(blocks: DataFrame, block_rows: int) -> DataFrame:
    """Number of the tile of each block, cells of one tile being neighbours in number, and
    its own place among the blocks of the side (side, cell, no, tile, place)."""
    cells = blocks.groupBy("side", "cell").agg((F.max("no") + 1).alias("blocks"))  # a row per cell; some numbers may be of no rows
    order = Window.partitionBy("side").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.withColumn("before", F.coalesce(F.sum("blocks").over(order), F.lit(0)))
    total = cells.groupBy("side").agg(F.sum("blocks").alias("total"))
    most = max(1, TILE_ROWS // block_rows)
    side = F.greatest(F.lit(min(most, max(1, LEAST_ROWS // block_rows))), F.least(F.lit(most), F.ceil(F.col("total") / TILES)))
    numbered = blocks.select("side", "cell", "no").join(before, ["side", "cell"]).join(total, "side")
    place = F.col("before") + F.col("no")
    return materialize(numbered.select("side", "cell", "no", F.floor(place / side).alias("tile"), place.alias("place")), "tiles")


def _runs(wanted: list[int], ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring blocks as ranges of rows, of about as many rows as are compared at one time."""
    first = last = 0
    for i in wanted:
        a, b = int(ends[i - 1]) if i else 0, int(ends[i])
        if last > first and (a != last or b - first > BLOCK_ROWS_AT_ONCE):
            yield first, last
            first = a
        elif last == first:
            first = a
        last = b
    if last > first:
        yield first, last


def pairs_skipped(queries: DataFrame, corpus: DataFrame, n: int = 5, **options) -> DataFrame:
    """One row: pairs of a query block and a corpus block, and how many are looked at,
    those of the same cell included."""
    _, pairs, blocks = pruned_blocks(queries, corpus, n, **options)
    count = lambda s: F.count_if(F.col("side") == s)
    same = blocks.groupBy("cell").agg((count("query") * count("corpus")).alias("same")).agg(F.coalesce(F.sum("same"), F.lit(0)).alias("own"))
    every = blocks.agg((count("query") * count("corpus")).alias("block_pairs"))
    looked = pairs.agg(F.count("*").alias("others"))
    return every.crossJoin(same).crossJoin(looked).select("block_pairs", (F.col("own") + F.col("others")).alias("looked_at"))
