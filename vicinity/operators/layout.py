"""Files laid out for filters: rows in a space-filling order over several columns.

A table sorted by one column lets a reader skip files by that column alone. Here each
column (an attribute, or the cell of a vector) becomes a rank of few bits, and rows are
sorted by the interleaved bits of all ranks, so that every file covers a narrow range of
each column. Smallest and largest values per file are kept beside the files; a filter
picks the files that can hold passing rows from them alone, and the scan skips row groups
in those by its own statistics. Filters are applied to the rows in any case: the layout
decides what is read, never what is found.

A folder holds ``rows/batch=b``, ``files/batch=b`` (a row per file) and ``about/batch=b``,
which a batch writes last: a batch without it doesn't count. One writer at a time.

Null values pass no filter. Values equal in all columns, however many, are dealt over as
many files as others by a hash of the row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vicinity.operators.topk import nearest
from vicinity.session import exists

RANK_BITS = 8  # of a column; 255 borders
SAMPLE_ROWS = 32_768  # about as many rows are looked at to find the borders
STRING_HEAD = 64  # characters of a string that borders look at
ROWS_PER_FILE = 200_000
RANGES = 200  # of an order: for more, Spark's tasks hold all their rows to sort them before they deal them out


# --- the order ---------------------------------------------------------------------


def _comparable(name: str, df: DataFrame) -> Column:
    """What borders look at: strings by their heads, whose order agrees with that of the whole."""
    column = F.col(_quoted(name))
    return F.substring(column, 1, STRING_HEAD) if df.schema[name].dataType.typeName() == "string" else column


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def borders(df: DataFrame, by: Sequence[str], total: int, seed: int = 1) -> DataFrame:
    """One row with an array per column: values that cut a sample of ``SAMPLE_ROWS`` rows
    into parts of equal size. Only speed depends on the sample."""
    some = df if total <= SAMPLE_ROWS else df.sample(SAMPLE_ROWS / total, seed)
    held = some.agg(*[F.array_sort(F.collect_list(_comparable(name, df))).alias(f"c{i}") for i, name in enumerate(by)])
    parts = 1 << RANK_BITS

    def cut(values: Column) -> Column:
        places = F.sequence(F.lit(1), F.lit(parts - 1))
        cuts = F.transform(places, lambda k: F.get(values, F.floor(k * F.size(values) / parts).cast("int")))
        return F.array_compact(F.array_distinct(cuts))

    return held.select(*[cut(F.col(c)).alias(c) for c in held.columns])


def rank(value: Column, edges: Column) -> Column:
    """How many of the sorted edges (fewer than 256) are at most the value, by halving, as a
    share of 256, so that columns of few values count as much as others; 0 for null."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(RANK_BITS))])
    below = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) <= value, at + step).otherwise(at)
    )
    return F.floor(below * (1 << RANK_BITS) / (F.size(edges) + 1)).cast("int")


def interleaved(ranks: Sequence[Column]) -> Column:
    """Bits of the ranks in turn, highest first: the Z-order of a point."""
    key = F.lit(0).cast("long")
    for i, r in enumerate(ranks):
        for bit in range(RANK_BITS):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - i))
    return key


# --- files -------------------------------------------------------------------------


class LaidOut:
    """A table laid out at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        about = spark.read.parquet(f"{self.path}/about").orderBy("batch").collect()
        self.by: list[str] = json.loads(about[0]["by"])
        self.schema = StructType.fromJson(json.loads(about[0]["schema"]))
        self.batches = [row["batch"] for row in about]
        values = StructType([self.schema[name] for name in self.by])
        kept = StructType().add("file", "string").add("rows", "long").add("low", values).add("high", values)
        base = f"{self.path}/files"
        reader = spark.read.schema(kept.add("batch", "integer")).option("basePath", base)
        self.files = reader.parquet(*[f"{base}/batch={b}" for b in self.batches])

    @classmethod
    def write(
        cls, df: DataFrame, path: str, by: Sequence[str], *, rows_per_file: int = ROWS_PER_FILE, seed: int = 1
    ) -> LaidOut:
        """Lay a table out by up to seven columns of an orderable type. The table is read
        four times: to count it, for borders, for ranges and to write it."""
        if not 1 <= len(by) <= 7 or len(set(by)) < len(by):
            raise ValueError("one to seven different columns give the order")
        if exists(df.sparkSession, f"{path.rstrip('/')}/about"):
            raise FileExistsError(f"{path} holds a table; use append")
        return cls._batch(df, path.rstrip("/"), list(by), 0, rows_per_file, seed)

    def append(self, df: DataFrame, *, rows_per_file: int = ROWS_PER_FILE, seed: int = 1) -> LaidOut:
        """Add rows, laid out among themselves, as further files."""
        latest = self.spark.read.parquet(f"{self.path}/about").agg(F.max("batch")).first()[0]
        if latest != self.batches[-1]:
            raise RuntimeError("the table has newer rows; open it again")
        return self._batch(df.select(*map(_quoted, self.schema.names)), self.path, self.by, latest + 1, rows_per_file, seed)

    @classmethod
    def _batch(cls, df: DataFrame, path: str, by: list[str], batch: int, rows_per_file: int, seed: int) -> LaidOut:
        spark, total = df.sparkSession, df.count()
        edges = f"{path}/borders/batch={batch}"
        borders(df, by, total, seed).write.mode("overwrite").parquet(edges)
        cuts = spark.read.parquet(edges).first()
        ranks = []
        for i, name in enumerate(by):
            # at most 255 values, of at most STRING_HEAD characters
            known = F.array(*map(F.lit, cuts[f"c{i}"])).cast(f"array<{df.schema[name].dataType.simpleString()}>")
            ranks.append(rank(_comparable(name, df), known).alias(f"r{i}"))
        whole = F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias("row")
        keyed = df.select(whole, *ranks)
        key = interleaved([F.col(f"r{i}") for i in range(len(by))]).alias("key")
        # rows of one key are dealt by a hash, equal rows by where they come from
        tie = F.xxhash64(*[F.col("row").getField(f.name) for f in df.schema if _hashable(f.dataType)]).alias("tie")
        keyed = keyed.select("row", key, tie, F.spark_partition_id().alias("origin"))
        order = ("key", "tie", "origin")
        files = max(1, -(-total // rows_per_file))
        ranges = min(files, RANGES)  # of several files each, where there are more files
        most = 2 * rows_per_file if ranges == files else rows_per_file
        ordered = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("row.*")
        rows = f"{path}/rows/batch={batch}"
        ordered.write.mode("overwrite").option("maxRecordsPerFile", most).parquet(rows)
        written = spark.read.schema(df.schema).parquet(rows)
        per_file = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.count("*").alias("rows"),
            F.struct(*[F.min(_quoted(c)).alias(c) for c in by]).alias("low"),
            F.struct(*[F.max(_quoted(c)).alias(c) for c in by]).alias("high"),
        )
        per_file.write.mode("overwrite").parquet(f"{path}/files/batch={batch}")
        about = spark.createDataFrame([(json.dumps(by), df.schema.json())], "by string, schema string").coalesce(1)
        about.write.mode("overwrite").parquet(f"{path}/about/batch={batch}")
        return cls(spark, path)

    # reading

    def table(self) -> DataFrame:
        paths = [f"{self.path}/rows/batch={b}" for b in self.batches]  # none is a partition's column
        return self.spark.read.schema(self.schema).parquet(*paths)

    def files_for(self, wanted: Mapping) -> DataFrame:
        """The files that may hold rows which pass."""
        keep = F.lit(True)
        for name, want in wanted.items():
            if name in self.by:
                low, high = (F.col("low").getField(name), F.col("high").getField(name))
                keep = keep & F.coalesce(_may_hold(low, high, want), F.lit(False))
        return self.files.filter(keep)

    def rows(self, wanted: Mapping) -> DataFrame:
        """The rows that pass ``wanted``: by column a value, a (low, high) range with None for
        an open end, or a list of values and ranges of which one must hold."""
        passing = F.lit(True)
        for name, want in wanted.items():
            passing = passing & _passes(F.col(_quoted(name)), want)
        chosen = self.files_for(wanted).select("batch", "file").collect()
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/rows/batch={r['batch']}/{r['file']}" for r in chosen]
        return self.spark.read.schema(self.schema).parquet(*paths).filter(passing)

    def share(self, wanted: Mapping) -> DataFrame:
        """Files and rows, all and to be read for a filter: one row."""
        read = self.files_for(wanted).agg(F.count("*").alias("files_read"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"))
        every = self.files.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        return every.select("*", *[read.select(c).scalar().alias(c) for c in read.columns])

    def search(
        self, query: Sequence[float], n: int = 5, *, where: Mapping | None = None, centroids: DataFrame | None = None,
        probes: int = 1, columns: Sequence[str] = (), id_col: str = "id", vec_col: str = "embedding",
        cell_col: str = "cell", **options,
    ) -> DataFrame:
        """The ``n`` nearest rows that pass: exactly, or among the ``probes`` cells nearest to
        the query where ``centroids`` (cell, centroid) are given."""
        wanted = dict(where or {})
        if centroids is not None:
            if cell_col in wanted:
                raise ValueError(f"{cell_col} is chosen by the query")
            wanted[cell_col] = cell_ranges(nearest_cells(centroids, query, probes))
        return nearest(self.rows(wanted), query, n, columns=columns, id_col=id_col, vec_col=vec_col, **options)


def _hashable(kind) -> bool:
    return not any(name in kind.simpleString() for name in ("map<", "variant"))


def _may_hold(low: Column, high: Column, want) -> Column:
    if isinstance(want, list):
        some = F.lit(False)
        for w in want:
            some = some | _may_hold(low, high, w)
        return some
    first, last = want if isinstance(want, tuple) else (want, want)
    # a file with nulls alone has no smallest value
    keep = low.isNotNull()
    if first is not None:
        keep = keep & (high >= F.lit(first))
    if last is not None:
        keep = keep & (low <= F.lit(last))
    return keep


def _passes(value: Column, want) -> Column:
    if isinstance(want, list):
        some = F.lit(False)
        for w in want:
            some = some | _passes(value, w)
        return some
    first, last = want if isinstance(want, tuple) else (want, want)
    if first is not None and first == last:
        return value == F.lit(first)
    keep = value.isNotNull()
    if first is not None:
        keep = keep & (value >= F.lit(first))
    if last is not None:
        keep = keep & (value <= F.lit(last))
    return keep


def nearest_cells(centroids: DataFrame, query: Sequence[float], probes: int) -> list[int]:
    """The cells nearest to the query by cosine, ranked where the centroids lie."""
    return [r["cell"] for r in nearest(centroids, query, probes, id_col="cell", vec_col="centroid").collect()]


def cell_ranges(cells: Sequence[int]) -> list:
    """Numbers as few ranges that hold exactly them."""
    ranges: list[list[int]] = []
    for c in sorted(set(cells)):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return [(a, b) for a, b in ranges]
