"""Approximate search by stored hash buckets.

A vector's code in a table is one bit per plane: the side it lies on. Planes have the
signs +1 and -1 of hashes of (table, bit, place), so that any writer and reader, SQL
too, finds the same. Rows are stored once per table, in the order of their codes, so that
the few codes a question asks for are a few row groups. A question asks for its own code
and for neighbouring ones, in which the bits of the planes it lies nearest to are turned;
rows found are ranked by their distance. Many questions meet the rows of their buckets
block by block; no pairs are made, and a bucket of very many rows is several blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinity.functions.vectors import to_matrix
from vicinity.operators.many import nearest_many
from vicinity.operators.topk import nearest

TABLES, BITS, PROBES = 8, 5, 2


def planes(width: int, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """Signs by table, bit and place (from 1)."""
    signs = np.empty((tables, bits, width))
    for t in range(tables):
        for b in range(bits):
            for i in range(width):
                h = int(hashlib.md5(f"{t}:{b}:{i + 1}".encode()).hexdigest()[:8], 16)
                signs[t, b, i] = -1.0 if h % 2 else 1.0
    return signs


def probed(rows: np.ndarray, signs: np.ndarray, probes: int) -> np.ndarray:
    """Buckets (table * 2**bits + code) by row: per table its own code, then those with
    the bit of the nearest plane turned, of the second nearest, ..."""
    tables, bits, _ = signs.shape
    out = np.empty((len(rows), tables, probes), "int64")
    for t in range(tables):
        side = rows @ signs[t].T
        code = ((side > 0) << np.arange(bits)).sum(axis=1)
        out[:, t, 0] = code
        near = np.argsort(np.abs(side), axis=1, kind="stable")[:, : probes - 1]
        out[:, t, 1:] = code[:, None] ^ (1 << near)
        out[:, t, :] += t << bits
    return out.reshape(len(rows), -1)


def with_buckets(df: DataFrame, vec_col: str, tables: int = TABLES, bits: int = BITS, probes: int = 1, out: str = "cells") -> DataFrame:
    """Add an array of buckets; null without a vector. ``probes``: 1 to bits + 1."""
    if not 1 <= probes <= bits + 1:
        raise ValueError("probes must be between 1 and bits + 1")

    @F.arrow_udf("array<int>")
    def pick(vectors: pa.Array) -> pa.Array:
        width = pc.max(pc.list_value_length(vectors)).as_py() or 0
        rows, valid = to_matrix(vectors, width)
        found = probed(rows, planes(width, tables, bits), probes) if width else np.zeros((0, tables * probes))
        ends = np.concatenate([[0], np.cumsum(valid) * tables * probes]).astype("int32")
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype("int32").ravel()), mask=pa.array(~valid))

    return df.withColumn(out, pick(F.col(vec_col)))


def write_buckets(df: DataFrame, path: str, vec_col: str = "embedding", tables: int = TABLES, bits: int = BITS) -> None:
    """Rows once per table, with ``bucket``, by table and in the order of buckets."""
    every = with_buckets(df, vec_col, tables, bits, out="_buckets").withColumn("bucket", F.explode("_buckets")).drop("_buckets")
    dealt = every.withColumn("table", F.shiftright("bucket", bits)).hint("rebalance", "table", "bucket")
    dealt.sortWithinPartitions("table", "bucket").write.mode("overwrite").partitionBy("table").parquet(path)


def bucket_search(
    stored: DataFrame, query: Sequence[float], n: int = 5, *, tables: int = TABLES, bits: int = BITS, probes: int = PROBES,
    where: Column | None = None, columns: Sequence[str] = (), id_col: str = "id", vec_col: str = "embedding", **options,
) -> DataFrame:
    """The ``n`` nearest rows of the buckets a query asks for, ties to the lower id."""
    target = np.asarray([query], "float64")
    asked = [int(b) for b in probed(target, planes(target.shape[1], tables, bits), probes)[0]]
    inside = stored.filter(F.col("table").isin([*range(tables)]) & F.col("bucket").isin(asked))
    # a row is there once per table at most
    most = nearest(inside, query, n * tables, where=where, columns=columns, id_col=id_col, vec_col=vec_col, **options)
    once = most.groupBy(id_col).agg(*[F.first(c).alias(c) for c in (*columns, "distance")])
    return once.orderBy(F.asc_nulls_last("distance"), id_col).limit(n)


def bucket_search_many(
    queries: DataFrame, corpus: DataFrame, n: int = 5, *, tables: int = TABLES, bits: int = BITS, probes: int = PROBES, **options
) -> DataFrame:
    """``nearest_many`` of queries (qid, vector) among the rows (id, vector) in their buckets."""
    asked = with_buckets(queries, "vector", tables, bits, probes)
    each = with_buckets(corpus, "vector", tables, bits).withColumn("cell", F.explode("cells")).drop("cells")
    return nearest_many(asked, each, n, repeated=True, **options)


def share_read(queries: DataFrame, corpus: DataFrame, *, tables: int = TABLES, bits: int = BITS, probes: int = PROBES) -> DataFrame:
    """``share``: rows that lie in a query's buckets, of all rows, on average; a row in the
    buckets of several tables counts each time."""
    in_bucket = with_buckets(corpus, "vector", tables, bits).select(F.explode("cells").alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    asked = with_buckets(queries, "vector", tables, bits, probes).select("qid", F.explode("cells").alias("b"))
    total = corpus.filter("vector is not null").agg(F.count("*").alias("total"))
    read = asked.join(in_bucket, "b", "left").groupBy("qid").agg(F.sum(F.coalesce("n", F.lit(0))).alias("rows"))
    return read.agg(F.avg("rows").alias("rows")).crossJoin(total).select((F.col("rows") / F.col("total")).alias("share"))
