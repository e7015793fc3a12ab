"""An index of cells that follows its data.

Vectors lie in cells (nearest centroid) and a search ranks the rows of few cells. The
index is a folder:

* ``groups`` and ``centroids``: a tree of two levels. A row or a query goes to its nearest
  group and, among the group's centroids only, to its nearest cell. Small trees travel to
  the tasks; of a large one only the groups do, and rows meet the centroids of their group
  in a sorted stream, so the number of cells has no limit.
* ``rows/gen=g/cell=c``: a generation of rows per write. The build writes the first one;
  ``change`` adds one that holds the changed rows alone, in their cells, and a mark in the
  cell where a row's old version lies; ``fold`` rewrites cells that have several
  generations, and splits those that have grown too full.
* ``manifest/version=v``: which generation of each cell counts, with statistics of it. A
  version is there once it is written completely, and readers take the latest; a change
  that fails leaves the last one as it was.

Statistics count the rows of each cell in bins of some attributes. They tell a filtered
search how many cells it needs without looking at a row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from vicinity.functions.vectors import row_distances, to_matrix
from vicinity.operators.many import nearest_many, pair_distances
from vicinity.operators.topk import nearest
from vicinity.session import scratch

SENT_BYTES = 64 << 20  # of centroids that travel to every task; more are met in a stream
SAMPLE_PER_CELL = 64  # rows per cell that training looks at
STREAM_ROWS = 100_000  # rows of a group that one task takes through a large tree
KEPT_ENTRIES = 1 << 20  # manifest rows that an open index keeps in memory
BINS = 32  # of an attribute with many values
VALUES = 64  # different values that have bins of their own
ITERATIONS = 10


# --- the tree of centroids ---------------------------------------------------------


def kmeans(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Unit centroids of unit rows, at most k; empty ones are dropped."""
    rng = np.random.default_rng(seed)
    centres = rows[np.sort(rng.permutation(len(rows))[:k])]
    for _ in range(ITERATIONS):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        sums = sums[np.bincount(own, minlength=len(centres)) > 0]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def unit_rows(vectors: pa.Array) -> np.ndarray:
    width = pc.max(pc.list_value_length(vectors)).as_py() or 0
    rows, _ = to_matrix(vectors, width) if width else (np.zeros((0, 0)), None)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows[norms[:, 0] > 0] / norms[norms[:, 0] > 0] if len(rows) else rows


def train_tree(df: DataFrame, cells: int, vec_col: str, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(group, centroid) and (group, cell, centroid), learnt from a sample of
    ``SAMPLE_PER_CELL`` rows per cell: first the groups, from as many rows per group, in
    one task; then the cells of each group, in a task per group."""
    present = df.filter(F.col(vec_col).isNotNull()).select(F.col(vec_col).cast("array<double>").alias("v"))
    total = present.count()
    groups = max(1, round(cells**0.5))

    def sample(rows: int) -> DataFrame:
        share = min(1.0, rows / max(1, total))
        return present if share == 1.0 else present.sample(share, seed)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [unit_rows(b.column(0)) for b in batches if b.num_rows]
        held = [h for h in held if len(h)]
        found = kmeans(np.concatenate(held), groups, seed) if held else np.zeros((0, 1))
        names = ["group", "centroid"]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found)), pa.int32()), pa.array(found.tolist(), pa.list_(pa.float64()))], names=names)

    few = sample(SAMPLE_PER_CELL * groups).coalesce(1)
    top_level = _stored(few.mapInArrow(top, "group int, centroid array<double>"), "groups")
    per_group = -(-cells // max(1, groups))

    def inside(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        found = kmeans(unit_rows(table.column("v").combine_chunks()), per_group, seed + group)
        n = len(found)
        columns = [pa.array([group] * n, pa.int32()), pa.array(group * per_group + np.arange(n), pa.int32())]
        return pa.table([*columns, pa.array(found.tolist(), pa.list_(pa.float64()))], names=["group", "cell", "centroid"])

    placed = with_nearest(sample(SAMPLE_PER_CELL * cells), _matrix(top_level, "group"), "v", "group")
    low = placed.filter("group is not null").groupBy("group").applyInArrow(inside, "group int, cell int, centroid array<double>")
    return top_level, _stored(low, "centroids")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(centroids: DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted(centroids.select(key, "centroid").collect())
    return np.array([r[0] for r in rows], "int64"), np.array([r[1] for r in rows], "float64")


def with_nearest(df: DataFrame, known: tuple[np.ndarray, np.ndarray], vec_col: str, out: str) -> DataFrame:
    """Add the number of the nearest centroid by cosine, ties to the lower number."""
    sent = df.sparkSession.sparkContext.broadcast(known)

    @F.arrow_udf("int")
    def pick(vectors: pa.Array) -> pa.Array:
        numbers, matrix = sent.value
        if not len(numbers):
            return pa.nulls(len(vectors), pa.int32())
        rows, valid = to_matrix(vectors, matrix.shape[1])
        found = np.zeros(len(valid), "int32")
        if len(rows):
            found[valid] = numbers[closest(rows, matrix)]
        return pa.array(found, mask=~valid)

    return df.withColumn(out, pick(F.col(vec_col)))


def closest(rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    return np.nan_to_num(pair_distances(rows, matrix, "cosine"), nan=3.0).argmin(axis=0)


def descend(df: DataFrame, groups: DataFrame, centroids: DataFrame, vec_col: str) -> DataFrame:
    """Add ``cell``: the nearest centroid of the nearest group; null without a vector."""
    size = centroids.agg(F.sum(F.size("centroid").cast("long") * 8)).first()[0] or 0
    top = _matrix(groups, "group")
    if size > SENT_BYTES:
        return _in_stream(with_nearest(df, top, vec_col, "_group"), centroids, vec_col, "cell")
    rows = sorted(centroids.select("group", "cell", "centroid").collect())
    below: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g]
        below[g] = np.array([r[1] for r in mine], "int64"), np.array([r[2] for r in mine], "float64")
    sent = df.sparkSession.sparkContext.broadcast((*top, below))

    @F.arrow_udf("int")
    def pick(vectors: pa.Array) -> pa.Array:
        numbers, matrix, cells = sent.value
        if not len(numbers):
            return pa.nulls(len(vectors), pa.int32())
        rows, valid = to_matrix(vectors, matrix.shape[1])
        out, found = np.zeros(len(valid), "int32"), np.zeros(len(rows), "int32")
        if len(rows):
            group = numbers[closest(rows, matrix)]
            for g in np.unique(group):
                mine = group == g
                found[mine] = cells[g][0][closest(rows[mine], cells[g][1])]
        out[valid] = found
        return pa.array(out, mask=~valid)

    return df.withColumn("cell", pick(F.col(vec_col)))


def _in_stream(df: DataFrame, centroids: DataFrame, vec_col: str, out: str, take: int | None = None) -> DataFrame:
    """Rows (with ``_group``) sorted behind the centroids of their group, which one task
    holds at a time; a group of very many rows is dealt over several tasks. Adds the
    nearest cell, or the ``take`` nearest as an array."""
    columns = [c for c in df.columns if c != "_group"]
    kind = IntegerType() if take is None else ArrayType(IntegerType())
    packed = centroids.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("cell", "centroid"))).alias("known"))
    parts = df.groupBy("_group").agg(F.ceil(F.count("*") / STREAM_ROWS).cast("int").alias("parts"))
    parts = _stored(parts.filter("_group is not null"), "parts")  # a row per group
    known = packed.join(parts, packed["group"] == parts["_group"])
    number = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    front = known.select("_group", number.alias("_part"), F.lit(0).alias("_side"), "known")
    spread = df.filter("_group is not null").join(F.broadcast(parts), "_group")
    part = F.pmod(F.xxhash64(*columns), F.col("parts")).cast("int").alias("_part")
    dealt = spread.select("_group", part, F.lit(1).alias("_side"), F.struct(*columns).alias("row"))
    every = front.unionByName(dealt, allowMissingColumns=True).repartition("_group", "_part")
    ordered = every.sortWithinPartitions("_group", "_part", "_side").select("_group", "_part", "_side", "known", "row")
    fields = {f.name: f for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = matrix = None
        for batch in batches:
            side = batch.column(2).to_numpy()
            group = batch.column(0).to_numpy().astype("int64") * (1 << 31) + batch.column(1).to_numpy()
            edges = np.flatnonzero(np.append(True, (side[1:] != side[:-1]) | (group[1:] != group[:-1])))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(side)]):
                if side[a] == 0:
                    rows = batch.column(3)[a].as_py()
                    cells, matrix = np.array([r["cell"] for r in rows]), np.array([r["centroid"] for r in rows])
                    continue
                held = batch.column(4).slice(a, b - a)
                rows, _ = to_matrix(pc.struct_field(held, vec_col), matrix.shape[1])
                if take is None:
                    found = pa.array(cells[closest(rows, matrix)], pa.int32())
                else:
                    found = pa.array(nearest_cells(rows, cells, matrix, take), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([held, found], names=["row", out])

    schema = StructType().add("row", StructType([fields[c] for c in columns])).add(out, kind)
    placed = ordered.mapInArrow(run, schema).select("row.*", out)
    return placed.unionByName(df.filter("_group is null").select(*columns, F.lit(None).cast(kind).alias(out)))


def nearest_cells(rows: np.ndarray, cells: np.ndarray, matrix: np.ndarray, take: int) -> list[list[int]]:
    if not len(rows):
        return []
    dist = np.nan_to_num(pair_distances(rows, matrix, "cosine"), nan=3.0)
    return cells[np.argsort(dist, axis=0, kind="stable")[:take].T].tolist()


# --- attributes --------------------------------------------------------------------


def bins_of(df: DataFrame, attribute: str) -> dict:
    """Bins of an attribute: one per value where there are few, else between quantiles."""
    few = df.select(attribute).filter(F.col(attribute).isNotNull()).distinct().limit(VALUES + 1).collect()
    if len(few) <= VALUES:
        return {"values": sorted(r[0] for r in few)}
    if df.schema[attribute].dataType.typeName() in ("string", "boolean", "binary", "date", "timestamp", "array", "struct", "map"):
        return {"values": []}
    shares = [i / BINS for i in range(1, BINS)]
    return {"edges": sorted(set(df.agg(F.percentile_approx(F.col(attribute).cast("double"), shares)).first()[0]))}


def bin_number(attribute: str, bins: dict) -> Column:
    """Number of a row's bin; null where it has none."""
    x = F.col(attribute)
    if "values" in bins:
        known = F.array(*map(F.lit, bins["values"])) if bins["values"] else F.array().cast("array<string>")
        place = F.array_position(known, x).cast("int") if bins["values"] else F.lit(0)
        return F.when(place > 0, place - 1)
    number = x.cast("double")
    edges = F.array(*[F.lit(float(e)) for e in bins["edges"]])
    return F.when(x.isNotNull() & ~F.isnan(number), F.size(F.filter(edges, lambda e: e <= number)))


def sure_bins(bins: dict, wanted) -> list[int]:
    """Bins all of whose rows pass: a value, or a (low, high) range with both ends."""
    is_range = isinstance(wanted, tuple)
    if "values" in bins:
        return [i for i, v in enumerate(bins["values"]) if (wanted[0] <= v <= wanted[1] if is_range else v == wanted)]
    if not is_range:
        return []
    # the first and the last bin are open and never sure
    edges = bins["edges"]
    return [i for i in range(1, len(edges)) if wanted[0] <= edges[i - 1] and edges[i] <= wanted[1]]


def condition(wanted: Mapping) -> Column:
    passes = F.lit(True)
    for attribute, w in wanted.items():
        x = F.col(attribute)
        passes = passes & (x.between(*w) if isinstance(w, tuple) else x == F.lit(w))
    return passes


# --- the index ---------------------------------------------------------------------


class CellIndex:
    """An index of cells at ``path``, at its latest version or a given one."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.version = self._latest_version() if version is None else version
        about = spark.read.parquet(f"{self.path}/about/version={self.version}").first()
        self.id_col, self.vec_col, self.tree = about["id_col"], about["vec_col"], about["tree"]
        self.schema = StructType.fromJson(json.loads(about["schema"]))
        self.bins: dict[str, dict] = json.loads(about["bins"])
        self.next_gen, self.next_cell = about["next_gen"], about["next_cell"]
        self.groups = spark.read.schema("group int, centroid array<double>").parquet(f"{self.tree}/groups")
        self.centroids = spark.read.schema("group int, cell int, centroid array<double>").parquet(f"{self.tree}/centroids")
        entries = spark.read.schema(", ".join(f"{c} {t}" for c, t in _ENTRIES.items())).parquet(f"{self.path}/manifest/version={self.version}")
        self.manifest = entries
        self._held: dict[int, list] | None = None
        self._top: tuple | None = None
        self._low: dict[int, tuple] | None = None

    def _latest_version(self) -> int:
        # ``about`` is the last thing that a version writes
        return self.spark.read.parquet(f"{self.path}/about").select("version").agg(F.max("version")).first()[0]

    def _sole_writer(self) -> None:
        if self._latest_version() != self.version:
            raise RuntimeError("the index has a newer version; open it again")

    # building

    @classmethod
    def build(
        cls, rows: DataFrame, path: str, *, cells: int | None = None, tree: tuple[DataFrame, DataFrame] | None = None,
        id_col: str = "id", vec_col: str = "embedding", attributes: Sequence[str] = (), seed: int = 1,
    ) -> CellIndex:
        """Write a new index. ``cells``: about how many (default: sqrt(rows)); ``tree``: given
        groups (group, centroid) and centroids (group, cell, centroid) in their place.
        ``attributes``: columns with statistics. Ids must be unique; rows without a vector
        are kept in no cell and never found."""
        spark, path = rows.sparkSession, path.rstrip("/")
        if tree is None:
            present = rows.filter(F.col(vec_col).isNotNull()).count()
            tree = train_tree(rows, cells or max(2, round(present**0.5)), vec_col, seed)
        bins = {a: bins_of(rows, a) for a in attributes}
        self = cls.__new__(cls)
        self.spark, self.path, self.version = spark, path, 0
        self.id_col, self.vec_col, self.bins, self.schema = id_col, vec_col, bins, rows.schema
        self.next_gen, self.next_cell = 1, 0
        self._save_tree(*tree)
        placed = descend(rows, self.groups, self.centroids, vec_col).filter("cell is not null")
        self._write(placed.withColumn("_gone", F.lit(False)), 1)
        self._publish(self._statistics(1), 2)
        return cls(spark, path)

    def _save_tree(self, groups: DataFrame, centroids: DataFrame) -> None:
        self.tree = f"{self.path}/tree-{self.version + 1}"
        groups.select("group", F.col("centroid").cast("array<double>").alias("centroid")).write.mode("overwrite").parquet(f"{self.tree}/groups")
        low = centroids.select("group", "cell", F.col("centroid").cast("array<double>").alias("centroid"))
        low.repartition("group").write.mode("overwrite").partitionBy("group").parquet(f"{self.tree}/centroids")
        self.groups = self.spark.read.schema("group int, centroid array<double>").parquet(f"{self.tree}/groups")
        self.centroids = self.spark.read.schema("group int, cell int, centroid array<double>").parquet(f"{self.tree}/centroids")
        self.next_cell = max(self.next_cell, (self.centroids.agg(F.max("cell")).first()[0] or 0) + 1)

    def _write(self, rows: DataFrame, gen: int) -> None:
        """A generation, with what makes it: no version names it before it is complete."""
        spread = rows.hint("rebalance", "cell")
        spread.write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/rows/gen={gen}")

    def _stored_schema(self) -> StructType:
        return StructType(list(self.schema.fields)).add("_gone", "boolean").add("cell", "integer")

    def _read(self, gens: Sequence[int], cells: Sequence[int] | None = None) -> DataFrame:
        """Rows and marks of some generations, with ``_gen``."""
        base = f"{self.path}/rows"
        schema = self._stored_schema().add("gen", "integer")
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/gen={g}" for g in gens])
        rows = rows.withColumnRenamed("gen", "_gen")
        return rows if cells is None else rows.filter(F.col("cell").isin([int(c) for c in cells]))

    def _statistics(self, gen: int) -> DataFrame:
        """A manifest row per cell of a generation."""
        rows = self._read([gen])
        live = ~F.col("_gone")
        total = rows.groupBy("cell").agg(F.count_if(live).alias("rows"), F.count_if(F.col("_gone")).alias("marks"))
        total = total.withColumn("gen", F.lit(gen).cast("int"))
        if not self.bins:
            return total.withColumn("counts", F.lit(None).cast(_ENTRIES["counts"]))
        numbers = [F.struct(F.lit(a).alias("attribute"), bin_number(a, b).cast("int").alias("bin")) for a, b in self.bins.items()]
        each = rows.filter(live).select("cell", F.explode(F.array(*numbers)).alias("b")).select("cell", "b.*").filter("bin is not null")
        per_bin = each.groupBy("cell", "attribute", "bin").agg(F.count("*").alias("n"))
        bins = F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("bins")
        per_attribute = per_bin.groupBy("cell", "attribute").agg(bins)
        counts = F.map_from_entries(F.collect_list(F.struct("attribute", "bins"))).alias("counts")
        return total.join(per_attribute.groupBy("cell").agg(counts), "cell", "left")

    def _publish(self, manifest: DataFrame, next_gen: int) -> None:
        """The new version counts when its last small table is complete."""
        version = self.version + 1
        manifest.select(*_ENTRIES).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
        bins = json.dumps(self.bins, default=str)
        about = [(self.id_col, self.vec_col, self.tree, self.schema.json(), bins, next_gen, self.next_cell)]
        names = "id_col string, vec_col string, tree string, schema string, bins string, next_gen int, next_cell int"
        one = self.spark.createDataFrame(about, names).coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.path}/about/version={version}")

    # changes

    def change(self, rows: DataFrame | None = None, gone: DataFrame | None = None) -> CellIndex:
        """Insert or replace ``rows`` (the index's columns, one row per id) and delete the
        ids in ``gone``. Writes the touched cells' new rows and marks only."""
        self._sole_writer()
        gen = self.next_gen
        ids = [f.select(self.id_col) for f in (rows, gone) if f is not None]
        touched = ids[0] if len(ids) == 1 else ids[0].unionByName(ids[1]).distinct()
        old = self._locations().join(touched.hint("shuffle_hash"), self.id_col, "left_semi")
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name != self.id_col]
        new = old.select(self.id_col, *nothing, "cell", F.lit(True).alias("_gone"))
        if rows is not None:
            placed = descend(rows.select(*self.schema.names), self.groups, self.centroids, self.vec_col).filter("cell is not null")
            # a new version in the cell of the old one needs no mark beside it
            placed = _stored(placed.withColumn("_gone", F.lit(False)), "changed")
            new = new.join(placed.select(self.id_col, "cell"), [self.id_col, "cell"], "left_anti").unionByName(placed)
        self._write(new, gen)
        manifest = self.manifest.unionByName(self._statistics(gen))
        self._publish(manifest, gen + 1)
        return CellIndex(self.spark, self.path)

    def _locations(self) -> DataFrame:
        """id and cell of every row that counts; reads no vectors."""
        gens = [r[0] for r in self.manifest.select("gen").distinct().collect()]
        rows = self._read(gens).select(self.id_col, "cell", "_gen", "_gone")
        named = self.manifest.select("cell", F.col("gen").alias("_gen"))
        rows = rows.join(named, ["cell", "_gen"], "left_semi")
        return self._latest(rows).select(self.id_col, "cell")

    def _latest(self, rows: DataFrame) -> DataFrame:
        """The latest version of each row of a cell, unless it is a mark."""
        order = Window.partitionBy("cell", self.id_col).orderBy(F.desc("_gen"))
        return rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1 and not _gone").drop("_n", "_gone", "_gen")

    def fold(self, most_rows: int | None = None, seed: int = 1) -> CellIndex:
        """Rewrite the cells of several generations as one, and split cells of more than
        ``most_rows`` rows into as many as they need. Other cells stay as they are."""
        self._sole_writer()
        cells = self.manifest.groupBy("cell").agg(F.count("*").alias("gens"), (F.sum("rows") - F.sum("marks")).alias("n"))
        full = F.col("n") > F.lit(most_rows if most_rows is not None else (1 << 62))
        chosen = _stored(cells.withColumn("full", full).filter("gens > 1 or full"), "cells-to-fold")
        if chosen.isEmpty():
            return self
        gen = self.next_gen
        entries = self.manifest.join(chosen.select("cell"), "cell", "left_semi").select("cell", F.col("gen").alias("_gen"))
        gens = [r[0] for r in entries.select("_gen").distinct().collect()]
        rows = self._latest(self._read(gens).join(entries, ["cell", "_gen"], "left_semi"))
        split = chosen.filter("full")
        if most_rows is not None and not split.isEmpty():
            rows = _stored(rows, "rows-to-fold")
            self._split(rows, split, most_rows, seed)
            again = rows.join(split.select("cell"), "cell", "left_semi").drop("cell")
            again = descend(again, self.groups, self.centroids, self.vec_col)
            # a row near a border may go to another cell of its group, which then has two generations
            rows = rows.join(split.select("cell"), "cell", "left_anti").unionByName(again)
        self._write(rows.withColumn("_gone", F.lit(False)), gen)
        rest = self.manifest.join(chosen.select("cell"), "cell", "left_anti")
        self._publish(rest.unionByName(self._statistics(gen)), gen + 1)
        return CellIndex(self.spark, self.path)

    def _split(self, rows: DataFrame, split: DataFrame, most_rows: int, seed: int) -> None:
        """Replace the centroids of overfull cells by those of their parts."""
        vec_col, per_cell = self.vec_col, SAMPLE_PER_CELL
        wanted = split.select("cell", F.ceil(2 * F.col("n") / F.lit(most_rows)).cast("int").alias("parts"), "n")
        drawn = rows.join(wanted, "cell").filter(F.rand(seed) * F.col("n") <= per_cell * F.col("parts"))

        def run(table: pa.Table) -> pa.Table:
            cell, parts = table.column("cell")[0].as_py(), table.column("parts")[0].as_py()
            found = kmeans(unit_rows(table.column("v").combine_chunks()), parts, seed + cell)
            columns = [pa.array([cell] * len(found), pa.int32()), pa.array(found.tolist(), pa.list_(pa.float64()))]
            return pa.table(columns, names=["was", "centroid"])

        vectors = drawn.select("cell", "parts", F.col(vec_col).cast("array<double>").alias("v"))
        new = _stored(vectors.groupBy("cell").applyInArrow(run, "was int, centroid array<double>"), "parts-of-cells")
        order = Window.orderBy("was", F.col("centroid"))  # a row per part of a split cell
        numbered = new.withColumn("cell", (F.row_number().over(order) - 1 + self.next_cell).cast("int"))
        groups = self.centroids.select(F.col("cell").alias("was"), "group")
        numbered = numbered.join(groups, "was").select("group", "cell", "centroid")
        kept = self.centroids.join(split.select("cell"), "cell", "left_anti").select("group", "cell", "centroid")
        self._save_tree(self.groups, _stored(kept.unionByName(numbered), "split-centroids"))

    # search

    def _cells(self, query: Sequence[float], wide: int | None = None) -> list[int]:
        """Cells of the ``wide`` nearest groups (default: all), nearest first."""
        if self._top is None:
            self._top = _matrix(self.groups, "group")
            size = self.centroids.agg(F.sum(F.size("centroid").cast("long") * 8)).first()[0] or 0
            self._low = {} if size > SENT_BYTES else self._load(None)
        groups = _ranked(*self._top, query)[:wide]
        missing = [g for g in groups if g not in self._low]
        found = self._low if not missing else self._low | self._load(missing)
        held = [found[g] for g in groups if g in found]
        if not held:
            return []
        cells, matrix = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        return _ranked(cells, matrix, query)

    def _load(self, groups: Sequence[int] | None) -> dict[int, tuple]:
        some = self.centroids if groups is None else self.centroids.filter(F.col("group").isin([int(g) for g in groups]))
        out: dict[int, list] = {}
        for g, c, v in sorted(some.select("group", "cell", "centroid").collect()):
            out.setdefault(g, []).append((c, v))
        return {g: (np.array([c for c, _ in m], "int64"), np.array([v for _, v in m], "float64")) for g, m in out.items()}

    def _entries(self, cells: Sequence[int]) -> dict[int, list]:
        """Manifest rows of some cells; those of a small index are kept."""
        if self._held is None:
            some = self.manifest.limit(KEPT_ENTRIES + 1).collect()
            self._held = _by_cell(some) if len(some) <= KEPT_ENTRIES else {}
        if self._held:
            return self._held
        return _by_cell(self.manifest.filter(F.col("cell").isin([int(c) for c in cells])).collect())

    def rows_of(self, cells: Sequence[int]) -> DataFrame:
        """The rows of some cells as they are now, with ``cell``."""
        entries = self._entries(cells)
        base = f"{self.path}/rows"
        there = [(c, e["gen"]) for c in cells for e in entries.get(c, ())]
        if not there:
            return self.spark.createDataFrame([], self._stored_schema()).drop("_gone")
        schema = self._stored_schema().add("gen", "integer")
        paths = [f"{base}/gen={g}/cell={c}" for c, g in there]
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths).withColumnRenamed("gen", "_gen")
        if len(there) == len({c for c, _ in there}) and not any(e["marks"] for c in cells for e in entries.get(c, ())):
            return rows.drop("_gen", "_gone")
        return self._latest(rows)

    def search(
        self, query: Sequence[float], n: int = 5, *, probes: int = 1, wide: int | None = None, where: Column | None = None,
        columns: Sequence[str] = (), **options,
    ) -> DataFrame:
        """The ``n`` nearest rows of the ``probes`` nearest cells."""
        rows = self.rows_of(self._cells(query, wide)[:probes])
        return nearest(rows, query, n, where=where, columns=columns, id_col=self.id_col, vec_col=self.vec_col, **options)

    def reach(self, query: Sequence[float], wanted: Mapping, n: int, wide: int | None = None) -> list[int]:
        """Nearest cells that are sure to hold ``n`` rows which pass, by statistics; all
        cells where fewer are sure. ``wanted``: value or (low, high) by attribute."""
        order = self._cells(query, wide)
        entries = self._entries(order)
        sure = {a: sure_bins(self.bins[a], w) for a, w in wanted.items() if a in self.bins}
        if len(sure) < len(wanted):
            return order
        reached, passing = [], 0
        for cell in order:
            if passing >= n:
                break
            held = entries.get(cell, ())
            rows, marks = sum(e["rows"] for e in held), sum(e["marks"] for e in held)
            # replaced rows are counted with both versions until the cell is folded
            doubt = marks + sum(e["rows"] for e in held[1:])
            per = [sum((e["counts"] or {}).get(a, {}).get(b, 0) for e in held for b in bins) for a, bins in sure.items()]
            least = sum(per) - (len(per) - 1) * rows
            reached.append(cell)
            passing += max(0, least - doubt)
        return reached

    def search_where(
        self, query: Sequence[float], wanted: Mapping, n: int = 5, *, columns: Sequence[str] = (), wide: int | None = None, **options
    ) -> DataFrame:
        """The ``n`` nearest rows that pass, of as many cells as statistics ask for."""
        rows = self.rows_of(self.reach(query, wanted, n, wide))
        return nearest(
            rows, query, n, where=condition(wanted), columns=columns, id_col=self.id_col, vec_col=self.vec_col, **options
        )

    def search_many(self, queries: DataFrame, n: int = 5, *, probes: int = 1, **options) -> DataFrame:
        """``nearest_many`` of queries (qid, vector) in each one's ``probes`` nearest cells:
        of all cells, or of its group where the tree is too large to be sent."""
        size = self.centroids.agg(F.sum(F.size("centroid").cast("long") * 8)).first()[0] or 0
        if size > SENT_BYTES:
            grouped = with_nearest(queries, _matrix(self.groups, "group"), "vector", "_group")
            queries = _in_stream(grouped, self.centroids, "vector", "cells", probes)
        else:
            sent = self.spark.sparkContext.broadcast(_matrix(self.centroids, "cell"))

            @F.arrow_udf("array<int>")
            def pick(vectors: pa.Array) -> pa.Array:
                cells, matrix = sent.value
                rows, valid = to_matrix(vectors, matrix.shape[1] if len(cells) else 0)
                best = iter(nearest_cells(rows, cells, matrix, probes))
                return pa.array([next(best) if v else None for v in valid], pa.list_(pa.int32()))

            queries = queries.withColumn("cells", pick(F.col("vector")))
        gens = [r[0] for r in self.manifest.select("gen").distinct().collect()]
        named = self.manifest.select("cell", F.col("gen").alias("_gen"))
        rows = self._latest(self._read(gens).join(named, ["cell", "_gen"], "left_semi"))
        corpus = rows.select(F.col(self.id_col).alias("id"), "cell", F.col(self.vec_col).alias("vector"))
        return nearest_many(queries, corpus, n, **options)


_ENTRIES = {"cell": "int", "gen": "int", "rows": "long", "marks": "long", "counts": "map<string, map<int, long>>"}


def _by_cell(rows: list) -> dict[int, list]:
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["cell"], r["gen"])):
        out.setdefault(r["cell"], []).append(r)
    return out


def _ranked(numbers: np.ndarray, matrix: np.ndarray, query: Sequence[float]) -> list[int]:
    if not len(numbers):
        return []
    dist = np.nan_to_num(row_distances(matrix, np.asarray(query, "float64"), "cosine"), nan=3.0)
    return [int(x) for x in numbers[np.lexsort((numbers, np.round(dist, 12)))]]
