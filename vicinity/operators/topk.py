"""Nearest rows to one vector: exact, filtered, post-filtered, widening.

The query vector is one row, read or computed once before the plan is built.
Ranking is ``orderBy(distance, id).limit(n)``, which Spark runs as a bounded heap
per partition and one small merge: no full sort, no shuffle of the corpus.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vicinity.functions.vectors import distance_between, distance_to

# Candidate width and scan limit of the approximate modes.
DEFAULT_EF = 40
MAX_EF = 1000
MAX_SCAN = 20_000


def row_vector(df: DataFrame, row_id: int, id_col: str = "id", vec_col: str = "embedding") -> list[float]:
    """Stored vector of one row, by point lookup."""
    row = df.filter(F.col(id_col) == row_id).select(vec_col).first()
    if row is None:
        raise LookupError(f"row {row_id} not found")
    if row[0] is None:
        raise LookupError(f"row {row_id} has no embedding yet")
    return list(row[0])


def vector_by_name(df: DataFrame, name: str, name_col: str, vec_col: str = "embedding", id_col: str = "id") -> list[float]:
    """Stored vector of the row with this exact name; the lowest id if several."""
    hit = df.filter((F.col(name_col) == name) & F.col(vec_col).isNotNull())
    row = hit.orderBy(id_col).select(vec_col).first()
    if row is None:
        raise LookupError(f"no embedded row is named {name!r}")
    return list(row[0])


def row_vectors(df: DataFrame, requested: DataFrame, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Vector and status (ok, not found, no embedding) of many requested ids."""
    found = df.select(id_col, F.col(vec_col).alias("vector"), F.lit(True).alias("_found"))
    status = (
        F.when(F.col("_found").isNull(), "not found")
        .when(F.col("vector").isNull(), "no embedding")
        .otherwise("ok")
    )
    return requested.join(found, id_col, "left").select(id_col, "vector", status.alias("status"))


def with_distance(
    df: DataFrame, query: Sequence[float], metric: str = "cosine", vec_col: str = "embedding"
) -> DataFrame:
    """The vector's distance to the query in its place: NULL without a vector, NaN
    without a direction."""
    return df.withColumn("distance", distance_to(F.col(vec_col), query, metric)).drop(vec_col)


def _first(df: DataFrame, n: int, id_col: str) -> DataFrame:
    """Top ``n``. Rows without a vector sort behind all others and drop out after
    the limit: a filter before it would have a computed vector computed twice."""
    return df.orderBy(F.asc_nulls_last("distance"), id_col).limit(n).filter(F.col("distance").isNotNull())


def _number_or_null(hits: DataFrame) -> DataFrame:
    return hits.withColumn("distance", F.nanvl("distance", F.lit(None).cast("double")))


def nearest(
    df: DataFrame,
    query: Sequence[float],
    n: int = 5,
    *,
    metric: str = "cosine",
    where: Column | None = None,
    columns: Sequence[str] = (),
    mode: str = "exact",
    ef: int = DEFAULT_EF,
    max_scan: int = MAX_SCAN,
    id_col: str = "id",
    vec_col: str = "embedding",
) -> DataFrame:
    """The ``n`` rows nearest to ``query``: id, the named columns, distance.

    ``exact`` filters first. ``postfilter`` takes the ``ef`` nearest rows and
    filters those, so it may return fewer than ``n``. ``iterative`` widens until
    ``n`` rows pass the filter or ``max_scan`` rows have been looked at.
    """
    keep = F.lit(True) if where is None else where
    if mode == "exact":
        df = df if where is None else df.filter(where)
        ranked = with_distance(df.select(id_col, *columns, vec_col), query, metric, vec_col)
        return _number_or_null(_first(ranked, n, id_col))

    slim = df.select(id_col, *columns, vec_col, keep.alias("_keep"))
    ranked = with_distance(slim, query, metric, vec_col)
    if mode == "postfilter":
        if not 1 <= ef <= MAX_EF:
            raise ValueError(f"ef must be between 1 and {MAX_EF}")
        candidates = _first(ranked, ef, id_col)
        return _number_or_null(_first(candidates.filter("_keep").drop("_keep"), n, id_col))
    if mode == "iterative":
        survivors = _with_global_rank(ranked, n, id_col)
        reached = survivors.filter(F.col("global_rank") <= max_scan)
        return _number_or_null(_first(reached.drop("global_rank"), n, id_col))
    raise ValueError(f"unknown mode {mode!r}")


def _with_global_rank(ranked: DataFrame, n: int, id_col: str) -> DataFrame:
    """The ``n`` nearest kept rows with their rank among all rows, kept or not.

    The rank is counted, not sorted: every row falls between two of the ``n``
    hits, and one partial aggregation counts the ``n + 1`` gaps. A heap of
    ``max_scan`` rows per partition never arises. The hits are one small array,
    computed once as a scalar subquery and used on both sides.
    """
    # Behind every number: first rows without a direction, then those without a vector.
    far = F.coalesce(F.nanvl("distance", F.lit(sys.float_info.max)), F.lit(float("inf")))
    hits = _first(ranked.filter("_keep").drop("_keep"), n, id_col)
    entry = F.struct(far.alias("d"), F.col(id_col).alias("i"), F.struct("*").alias("row"))
    marks = hits.agg(F.array_sort(F.collect_list(entry)).alias("marks"))  # at most n entries

    def not_after(mark: Column) -> Column:
        same = mark["d"] == F.col("_d")
        return (mark["d"] < F.col("_d")) | (same & (mark["i"] <= F.col("_i")))

    gaps = (
        ranked.select(far.alias("_d"), F.col(id_col).alias("_i"))
        .withColumn("marks", marks.scalar())
        .select(F.size(F.filter("marks", not_after)).alias("gap"))
        .groupBy("gap")
        .count()
    )
    counts = gaps.agg(F.collect_list(F.struct("gap", "count")).alias("counts"))  # at most n + 1
    places = (
        ranked.sparkSession.range(1)
        .select(F.explode(F.array(marks.scalar())).alias("marks"), counts.scalar().alias("counts"))
        .select(F.posexplode("marks").alias("pos", "mark"), "counts")
    )
    # The hit at position k is preceded by all rows in gaps 0..k.
    before = F.filter("counts", lambda gap: gap["gap"] <= F.col("pos"))
    rank = F.aggregate(before, F.lit(1).cast("long"), lambda total, gap: total + gap["count"])
    return places.select("mark.row.*", rank.alias("global_rank"))


def candidate_sweep(
    df: DataFrame,
    query: Sequence[float],
    where: Column,
    n: int,
    widths: Sequence[int],
    *,
    metric: str = "cosine",
    id_col: str = "id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Rows a post-filtered search returns for each candidate width."""
    slim = df.select(id_col, vec_col, where.alias("_keep"))
    ranked = with_distance(slim, query, metric, vec_col)
    hits = _with_global_rank(ranked, n, id_col).select("global_rank")
    counts = [F.count_if(F.col("global_rank") <= w).alias(str(w)) for w in widths]
    by_width = F.array(
        *[F.struct(F.lit(w).alias("ef"), F.col(str(w)).alias("rows_returned")) for w in widths]
    )
    return hits.agg(*counts).select(F.inline(by_width))


def rank_results(hits: DataFrame, id_col: str = "id") -> DataFrame:
    """Number a result from 1; meant for the few rows of a top-n report."""
    order = Window.orderBy(F.asc_nulls_last("distance"), id_col)
    return hits.withColumn("rank", F.row_number().over(order))


def compare_pairs(
    df: DataFrame,
    pairs: DataFrame,
    *,
    metric: str = "cosine",
    attributes: Sequence[str] = (),
    id_col: str = "id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Distance and attributes for each row of ``pairs`` (columns a, b, any more)."""

    def side(name: str) -> DataFrame:
        return df.select(
            F.col(id_col).alias(name),
            F.col(vec_col).alias(f"_{name}"),
            *[F.col(c).alias(f"{c}_{name}") for c in attributes],
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.withColumn("distance", distance_between(F.col("_a"), F.col("_b"), metric)).drop("_a", "_b")
