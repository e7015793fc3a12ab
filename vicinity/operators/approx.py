"""Approximate search: clustered cells (inverted file) and hashed buckets.

Cells: every vector belongs to its nearest centroid; a search ranks the rows of
the few cells nearest to the query. Written ``partitionBy('cell')``, the cell
filter prunes files. Centroids may be trained or given.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinity.functions.vectors import normalize, row_distances, to_matrix
from vicinity.operators.many import nearest_many, pair_distances
from vicinity.operators.topk import MAX_SCAN, nearest

SENT_BYTES = 1 << 30  # of centroids that may go to every task; more is refused


def mean_vectors(
    df: DataFrame, group: str | None = None, weight: str | None = None, vec_col: str = "embedding", unit: bool = False
) -> DataFrame:
    """Weighted mean vector per group; every task adds up its own share first."""
    present = df.filter(F.col(vec_col).isNotNull())
    mean = Summarizer.mean(array_to_vector(vec_col), *([F.col(weight).cast("double")] if weight else []))
    groups = [group] if group else []
    out = present.groupBy(*groups).agg(vector_to_array(mean).alias("centroid"))
    return out.withColumn("centroid", normalize(F.col("centroid"))) if unit else out


def train_centroids(
    df: DataFrame, cells: int | None = None, vec_col: str = "embedding", seed: int = 1, max_iter: int = 10
) -> DataFrame:
    """Centroids by cosine KMeans over all rows of ``df``: cell, centroid.

    Default cells: sqrt(rows). To train on a sample, pass the sample."""
    present = df.filter(F.col(vec_col).isNotNull()).select(array_to_vector(vec_col).alias("features"))
    cells = cells or max(2, round(present.count() ** 0.5))
    model = KMeans(k=cells, seed=seed, maxIter=max_iter, distanceMeasure="cosine").fit(present)
    found = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(found, "cell int, centroid array<double>")


def _centroid_matrix(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers and centroids on the driver, in cell order, size-checked."""
    size = centroids.agg(F.sum(F.size("centroid").cast("long") * 8)).first()[0] or 0
    if size > SENT_BYTES:
        raise ValueError(f"{size} bytes of centroids are more than {SENT_BYTES}; train fewer cells")
    rows = centroids.select("cell", "centroid").collect()
    rows.sort(key=lambda r: r[0])
    cells = np.array([r[0] for r in rows], "int64")
    return cells, np.array([r[1] for r in rows], "float64")


def assign_cells(df: DataFrame, centroids: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Add ``cell``: the nearest centroid by cosine, ties to the lower cell."""
    sent = df.sparkSession.sparkContext.broadcast(_centroid_matrix(centroids))

    @F.arrow_udf("int")
    def nearest_cell(vectors: pa.Array) -> pa.Array:
        cells, matrix = sent.value
        rows, valid = to_matrix(vectors, matrix.shape[1])
        out = np.zeros(len(valid), "int32")
        if len(rows):
            dist = np.nan_to_num(pair_distances(rows, matrix, "cosine"), nan=3.0)
            out[valid] = cells[dist.argmin(axis=0)]
        return pa.array(out, mask=~valid)

    return df.withColumn("cell", nearest_cell(F.col(vec_col)))


def write_cells(assigned: DataFrame, path: str) -> None:
    """Write by cell. ``rebalance`` splits an overfull cell over several tasks
    and gathers small ones, so neither one task nor a flood of files results."""
    assigned.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)


def cell_order(centroids: DataFrame, query: Sequence[float]) -> list[int]:
    """Cells from nearest to farthest centroid."""
    cells, matrix = _centroid_matrix(centroids)
    dist = row_distances(matrix, np.asarray(query, "float64"), "cosine")
    return [int(c) for c in cells[np.lexsort((cells, np.nan_to_num(dist, nan=3.0)))]]


def cell_search(
    assigned: DataFrame,
    centroids: DataFrame,
    query: Sequence[float],
    n: int = 5,
    probes: int = 1,
    where: Column | None = None,
    **options,
) -> DataFrame:
    """Exact ranking inside the ``probes`` nearest cells."""
    looked_at = cell_order(centroids, query)[:probes]
    return nearest(assigned.filter(F.col("cell").isin(looked_at)), query, n, where=where, **options)


def widening_search(
    assigned: DataFrame,
    centroids: DataFrame,
    query: Sequence[float],
    where: Column,
    n: int = 5,
    max_scan: int = MAX_SCAN,
    vec_col: str = "embedding",
    **options,
) -> DataFrame:
    """Add cells, nearest first, until ``n`` rows pass the filter or ``max_scan``
    rows were looked at; then rank what was reached.

    How far to go follows from one count per cell, which reads no vectors; only
    the cells that are reached get ranked.
    """
    present = assigned.filter(F.col(vec_col).isNotNull())
    counts = {
        r["cell"]: (r["rows"], r["passing"])
        for r in present.groupBy("cell").agg(F.count("*").alias("rows"), F.count_if(where).alias("passing")).collect()
    }
    reached, scanned, passing = [], 0, 0
    for cell in cell_order(centroids, query):
        if passing >= n or scanned >= max_scan:
            break
        rows, hits = counts.get(cell, (0, 0))
        reached.append(cell)
        scanned, passing = scanned + rows, passing + hits
    inside = assigned.filter(F.col("cell").isin(reached))
    return nearest(inside, query, n, where=where, vec_col=vec_col, **options)


def with_probes(queries: DataFrame, centroids: DataFrame, probes: int, vec_col: str = "vector") -> DataFrame:
    """Add ``cells``: the ``probes`` nearest cells of every query."""
    sent = queries.sparkSession.sparkContext.broadcast(_centroid_matrix(centroids))

    @F.arrow_udf("array<int>")
    def pick(vectors: pa.Array) -> pa.Array:
        cells, matrix = sent.value
        rows, valid = to_matrix(vectors, matrix.shape[1])
        take = min(probes, len(cells))
        flat = np.empty(0, "int32")
        if len(rows):
            dist = np.nan_to_num(pair_distances(rows, matrix, "cosine"), nan=3.0)
            flat = cells[np.argsort(dist, axis=0, kind="stable")[:take].T].astype("int32").ravel()
        ends = np.concatenate([[0], np.cumsum(valid) * take]).astype("int32")
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array(~valid))

    return queries.withColumn("cells", pick(F.col(vec_col)))


def cell_search_many(
    queries: DataFrame, assigned: DataFrame, centroids: DataFrame, n: int = 5, probes: int = 1, **options
) -> DataFrame:
    """``nearest_many`` inside each query's ``probes`` nearest cells."""
    return nearest_many(with_probes(queries, centroids, probes), assigned, n, **options)


def hashed_search(
    df: DataFrame,
    query: Sequence[float],
    n: int = 5,
    *,
    tables: int = 3,
    bucket_length: float = 2.0,
    seed: int = 1,
    columns: Sequence[str] = (),
    id_col: str = "id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Approximate top ``n`` by random projections on unit vectors, where the
    order by Euclidean distance is the order by cosine distance."""
    from pyspark.ml.linalg import Vectors

    unit = df.filter(F.col(vec_col).isNotNull()).select(
        id_col, *columns, array_to_vector(normalize(F.col(vec_col))).alias("features")
    )
    target = np.asarray(query, "float64")
    target = Vectors.dense(target / max(float(np.sqrt(target @ target)), 1e-12))
    hashing = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", numHashTables=tables, bucketLength=bucket_length, seed=seed
    )
    hits = hashing.fit(unit).approxNearestNeighbors(unit, target, n, distCol="l2")
    return hits.select(id_col, *columns, (F.col("l2") * F.col("l2") / 2).alias("distance"))


def recall_at_k(found: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """Share of the exact top ``k`` that was found, per query (qid, id columns)."""
    both = exact.join(found.select("qid", "id", F.lit(1).alias("_hit")), ["qid", "id"], "left")
    return both.groupBy("qid").agg((F.count("_hit") / F.lit(k)).alias("recall"))
