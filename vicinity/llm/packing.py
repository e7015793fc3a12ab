"""Packing token sequences with a grouping genetic algorithm on islands.

Pieces are dealt to regions of bounded size; each region is packed by several islands
at once. An island keeps a small population of packings (which bin holds which piece).
Crossover injects whole well-filled bins of one parent into the other, removes the
bins that hold a copy of an injected piece, and places the displaced pieces by best
fit. Between epochs the best packings of an island migrate to the next one. The best
island of a region counts; its worst-filled bins are opened again and packed with
those of neighbouring regions, until one region is left.

Only ids and lengths of pieces travel; their number per region is bounded, and an
island stops once its packing has as few bins as any can.

Null and empty texts are one piece of their end id. Rows with equal ids are packed
each for itself, a null id is kept, an empty table gives no rows. Only the two named
columns are read.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from vicinity.llm.common import pieces as cut_batches
from vicinity.llm.common import written
from vicinity.llm.words import word_encoder

REGION = 4096  # pieces that are packed together
FAN_IN = 64  # regions whose opened bins are packed together next
OPENED = 4  # worst-filled bins that a region opens again
ISLANDS, EPOCHS, POPULATION, GENERATIONS, ELITES = 2, 2, 6, 12, 2

PIECE = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
    ]
)


def cut_pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each whole text and its end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in cut_batches(batches, "text"):
            rows = []
            ids = encoder.packed_all(batch.column(1).to_pylist())
            for doc, body in zip(batch.column(0).to_pylist(), ids, strict=True):
                packed = body + end
                for k, at in enumerate(range(0, len(packed), step)):
                    part = packed[at : at + step]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=PIECE.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECE)


# --- one island -----------------------------------------------------------------


class Island:
    def __init__(self, lengths: list[int], capacity: int, seed: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.sizes = np.array(lengths, np.int64)
        self.rng = random.Random(seed)
        over_half = int((2 * self.sizes > capacity).sum())
        self.least = max(-(-int(self.sizes.sum()) // capacity), over_half)

    def best_fit(self, order: list[int], bins: np.ndarray, loads: list[int]) -> tuple[np.ndarray, list[int]]:
        """Place pieces in order, each into the fullest bin that has room for it."""
        room = sorted((self.capacity - load) << 32 | b for b, load in enumerate(loads) if load < self.capacity)
        for i in order:
            size = self.lengths[i]
            at = bisect_left(room, size << 32)
            if at < len(room):
                key = room.pop(at)
                b, left = key & 0xFFFFFFFF, (key >> 32) - size
                loads[b] += size
            else:
                b, left = len(loads), self.capacity - size
                loads.append(size)
            bins[i] = b
            if left:
                insort(room, left << 32 | b)
        return bins, loads

    def fresh(self, spread: float) -> np.ndarray:
        """Best fit in falling order of length, each length blurred by ``spread``."""
        blurred = [n * (1 + spread * self.rng.random()) for n in self.lengths]
        order = sorted(range(len(blurred)), key=lambda i: -blurred[i])
        return self.best_fit(order, np.full(len(order), -1, np.int64), [])[0]

    def loads(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, self.sizes).astype(np.int64)

    def cost(self, bins: np.ndarray) -> tuple[int, int]:
        """Bins, then evenness: of as many bins, full and empty ones are better."""
        loads = self.loads(bins)
        return len(loads), -int((loads * loads).sum())

    def cross(self, into: np.ndarray, source: np.ndarray) -> np.ndarray:
        loads = self.loads(source)
        full = np.flatnonzero(loads >= np.quantile(loads, 0.5 + 0.4 * self.rng.random()))
        chosen = np.zeros(len(loads), bool)
        chosen[self.rng.sample(full.tolist(), 1 + self.rng.randrange(len(full)))] = True
        injected = chosen[source]
        # the receiving bins that hold an injected piece go, with all their pieces
        broken = np.zeros(into.max() + 1, bool)
        broken[into[injected]] = True
        displaced = np.flatnonzero(broken[into] & ~injected)
        child = np.full(len(into), -1, np.int64)
        stay = ~broken[into]
        kept, child[stay] = np.unique(into[stay], return_inverse=True)
        moved, places = np.unique(source[injected], return_inverse=True)
        child[injected] = len(kept) + places
        held = child >= 0
        new_loads = np.bincount(child[held], self.sizes[held], len(kept) + len(moved)).astype(np.int64).tolist()
        order = sorted(displaced.tolist(), key=lambda i: -self.lengths[i])
        return self.best_fit(order, child, new_loads)[0]

    def evolve(self, arrived: list[np.ndarray]) -> list[np.ndarray]:
        """The best packings found; the search ends where one can't be better."""
        ranked: list[tuple] = []
        for k in range(max(POPULATION, len(arrived))):
            new = arrived[k] if k < len(arrived) else self.fresh(0.15 * (k - len(arrived)))
            insort(ranked, (self.cost(new), k, new), key=lambda x: x[:2])
            if ranked[0][0][0] <= self.least:
                break
        for k in range(GENERATIONS):
            if ranked[0][0][0] <= self.least:
                break
            first, second = self.rng.sample(range(len(ranked)), 2)
            child = self.cross(ranked[max(first, second)][2], ranked[min(first, second)][2])
            insort(ranked, (self.cost(child), POPULATION + k, child), key=lambda x: x[:2])
            ranked.pop()
        return [p for _, _, p in ranked[:ELITES]]


STATE = StructType(
    [
        StructField("region", LongType()),
        StructField("island", IntegerType()),
        StructField("lengths", ArrayType(IntegerType())),
        StructField("elites", ArrayType(ArrayType(IntegerType()))),
        StructField("bins", IntegerType()),
        StructField("uneven", LongType()),
    ]
)


def epoch(state: DataFrame, capacity: int, number: int) -> DataFrame:
    """Every island of every region evolves on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("region", pa.int64()),
                ("island", pa.int32()),
                ("lengths", pa.list_(pa.int32())),
                ("elites", pa.list_(pa.list_(pa.int32()))),
                ("bins", pa.int32()),
                ("uneven", pa.int64()),
            ]
        )
        for batch in batches:
            for row in batch.to_pylist():
                island = Island(row["lengths"], capacity, hash((row["region"], row["island"], number)))
                best = island.evolve([np.array(e, np.int64) for e in row["elites"] or []])
                bins, uneven = island.cost(best[0])
                out = row | {"elites": [b.tolist() for b in best], "bins": bins, "uneven": uneven}
                yield pa.RecordBatch.from_pylist([{k: out[k] for k in schema.names}], schema)

    tasks = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return state.repartition(tasks, "region", "island").mapInArrow(run, STATE)


def migrate(state: DataFrame) -> DataFrame:
    """Each island hands its best packings to the next one of its region."""
    ring = Window.partitionBy("region").orderBy("island")
    whole = Window.partitionBy("region").orderBy("island").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    arrived = F.coalesce(F.lag("elites").over(ring), F.last("elites").over(whole))
    return state.withColumn("elites", F.concat(F.slice("elites", 1, 1), arrived))


PLACED = StructType(
    [
        *PIECE.fields,
        StructField("region", LongType()),
        StructField("bin", IntegerType()),
        StructField("offset", LongType()),
        StructField("opened", IntegerType()),
    ]
)


def pack_regions(regions: DataFrame, capacity: int, last: bool) -> DataFrame:
    """Rows of (region, items) to one row per piece with its bin and offset there;
    ``opened`` is 1 in the worst-filled bins, unless this is the last round."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                items, bins = row["items"], np.array(row["best"], np.int64)
                sizes = np.array([i["length"] for i in items], np.int64)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(sizes[order])
                loads = np.bincount(bins, sizes).astype(np.int64)
                starts = np.concatenate([[0], np.cumsum(loads)])[:-1]
                offsets = np.empty(len(bins), np.int64)
                offsets[order] = ends - sizes[order] - starts[bins[order]]
                worst = np.argsort(loads, kind="stable")[:OPENED]
                opened = np.zeros(len(loads), np.int32)
                opened[worst[10 * loads[worst] < 9 * capacity]] = 0 if last else 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i["doc_id"] for i in items], pa.int64()),
                        pa.array([i["piece"] for i in items], pa.int32()),
                        pa.array([i["start"] for i in items], pa.int64()),
                        pa.array(sizes),
                        pa.array([i["ids_crc32"] for i in items], pa.int64()),
                        pa.array([row["region"]] * len(items), pa.int64()),
                        pa.array(bins, pa.int32()),
                        pa.array(offsets),
                        pa.array(opened[bins]),
                    ],
                    names=PLACED.names,
                )

    lengths = F.transform("items", lambda i: i["length"].cast("int"))
    state = regions.select(
        "region",
        F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        lengths.alias("lengths"),
        F.lit(None).cast("array<array<int>>").alias("elites"),
    )
    for number in range(EPOCHS):
        state = epoch(state if not number else migrate(state), capacity, number)
    rank = F.struct("bins", "uneven", "island")
    best = state.groupBy("region").agg(F.min_by(F.get("elites", F.lit(0)), rank).alias("best"))
    return regions.join(best, "region").mapInArrow(place, PLACED)


def gather(pieces: DataFrame) -> DataFrame:
    """One row per region with its pieces, longest first."""
    item = F.struct(F.col("length"), "doc_id", "piece", "start", "ids_crc32")
    return pieces.groupBy("region").agg(F.sort_array(F.collect_list(item), asc=False).alias("items"))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (as from ``cut_pieces``) with sequence_id and offset."""
    # numbered once, when they are written
    pieces = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    own = pieces.filter(F.col("length") == capacity).select(
        *PIECE.names, (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    part = pieces.filter(F.col("length") < capacity)
    regions = max(1, -(-part.count() // REGION))
    # rows dealt in turn, so that no key or length gathers in a region
    row = F.col("row")
    dealt = part.withColumn("region", F.pmod(F.shiftright(row, 33) * 7919 + row, F.lit(regions)))
    done, first = [own], 0
    while True:
        packed = written(pack_regions(written(gather(dealt), "regions"), capacity, regions == 1), "packed")
        number = (F.col("region") + first) * (1 << 20) + F.col("bin")
        done.append(packed.filter("opened = 0").select(*PIECE.names, number.alias("sequence_id"), "offset"))
        if regions == 1:
            break
        dealt = packed.filter("opened = 1").select(
            *PIECE.names, F.floor(F.col("region") / FAN_IN).cast("long").alias("region")
        )
        first, regions = first + regions, -(-regions // FAN_IN)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
