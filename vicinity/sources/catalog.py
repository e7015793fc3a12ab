"""Catalogue source: CSV scan, guards, clean-up, and the table it becomes."""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinity.functions.text import (
    blank_to_null,
    clean,
    compose_info,
    fold_description,
    is_keg,
    text_hash,
    to_number,
    to_whole,
)
from vicinity.operators.changes import first_wins, load_report, upsert
from vicinity.operators.meta import update_meta
from vicinity.operators.runs import recorded
from vicinity.session import exists, materialize
from vicinity.sources.ranges import csv_columns, csv_records

# ---------------------------------------------------------------------------
# The file format and the table schema.
REQUIRED_COLUMNS = (
    "Name",
    "Country",
    "Brand",
    "Categories",
    "Tasting Notes",
    "ABV",
    "IBU",
    "Food Pairing",
    "Rating",
    "Rate Count",
    "Description",
)
POINTER_HEAD = "version https://git-lfs.github.com/spec/"
SCORES = (
    "astringency",
    "body",
    "alcohol",
    "bitter",
    "sweet",
    "sour",
    "salty",
    "fruits",
    "hoppy",
    "spices",
    "malty",
)
REVIEWS = ("review_aroma", "review_appearance", "review_palate", "review_taste", "review_overall")
NATURAL_KEY = ("beer_name", "brewery", "style")
CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("beer_name", T.StringType()),
        T.StructField("brewery", T.StringType()),
        T.StructField("style", T.StringType()),
        T.StructField("abv", T.DecimalType(5, 2)),
        T.StructField("min_ibu", T.IntegerType()),
        T.StructField("max_ibu", T.IntegerType()),
        *[T.StructField(c, T.IntegerType()) for c in SCORES],
        *[T.StructField(c, T.DecimalType(4, 3)) for c in REVIEWS],
        T.StructField("number_of_reviews", T.IntegerType()),
        T.StructField("info", T.StringType()),
        T.StructField("text_hash", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("embedded_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
# ---------------------------------------------------------------------------

ROWS_PER_FILE = 1 << 33  # monotonically_increasing_id leaves 33 bits per task
BYTES_PER_FILE = 1 << 43  # of files read in ranges, whose rows are numbered by bytes


class CatalogError(ValueError):
    """The file cannot be loaded; nothing was written."""


def file_heads(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files under a path by their first line. Refuses a missing path, and names a
    file that is empty or a large-file pointer."""
    try:
        lines = spark.read.text(path)
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise CatalogError(f"dataset not found at {path}") from problem
        raise
    files = lines.inputFiles()
    # every task hands on one line per file; a header is where the file begins
    begins = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).filter("block = 0")
    heads = begins.groupBy("file").agg(F.min_by("value", "line").alias("head"))
    by_head = {r["head"]: sorted(r["files"]) for r in heads.groupBy("head").agg(F.collect_list("file").alias("files")).collect()}
    found = {_plain(f) for group in by_head.values() for f in group}
    empty = sorted({_plain(f) for f in files} - found)
    if empty or not files:
        raise CatalogError(f"{empty[0] if empty else path} is empty, load aborted")
    for head, group in by_head.items():
        if head.startswith(POINTER_HEAD):
            raise CatalogError(f"{group[0]} is a Git-LFS pointer, not data, load aborted")
    return by_head


def _plain(uri: str) -> str:
    return re.sub(r"^file:/+", "/", uri)


def read_catalog(spark: SparkSession, path: str, in_ranges: bool = False) -> DataFrame:
    """All columns as cleaned text under trimmed headers, plus ``file_row``.

    Every file's own header says which column is which; a column that only some files
    have is empty in the others. ``file_row`` grows with the file name and the position
    in the file. Quoted fields may hold line breaks, so one task reads a whole file;
    ``in_ranges`` has many tasks read it instead, for files that write a quote in a field
    as two, inside quotes.
    """
    by_head = file_heads(spark, path)
    numbers = {f: i for i, f in enumerate(sorted(f for group in by_head.values() for f in group))}
    places = spark.createDataFrame(list(numbers.items()), "_path string, _file long")
    out = None
    for files in by_head.values():
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
        raw = reader.option("multiLine", True).option("encoding", "UTF-8").csv([unquote(f) for f in files])
        headers = [c.lstrip("\ufeff").strip() or f"_c{i}" for i, c in enumerate(raw.columns)]
        missing = sorted(set(REQUIRED_COLUMNS) - set(headers))
        if missing:
            raise CatalogError(f"{files[0]}: missing required columns: {missing}, load aborted")
        if in_ranges:
            fields = csv_columns(csv_records(spark, [unquote(f) for f in files]), len(headers)).filter("position > 0")
            cleaned = [clean(F.col(f"c{i}")).alias(h) for i, h in enumerate(headers)]
            rows = fields.select(*cleaned, "_path", F.col("position").alias("_row"))
        else:
            rows = raw.select(
                *[clean(F.col(f"`{c}`")).alias(h) for c, h in zip(raw.columns, headers)],
                F.col("_metadata.file_path").alias("_path"),
                (F.monotonically_increasing_id() % ROWS_PER_FILE).alias("_row"),
            )
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    columns = [c for c in out.columns if c not in ("_path", "_row")]
    # monotonically_increasing_id counts inside a task, and a task may read several
    # files; inside one file it still grows with the line
    placed = out.join(places, "_path")
    return placed.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns],
        (F.col("_file") * (BYTES_PER_FILE if in_ranges else ROWS_PER_FILE) + F.col("_row")).alias("file_row"),
    )


def is_usable() -> Column:
    """Has a name and is not a repeat of an item in another package size."""
    return (F.col("Name") != "") & ~is_keg(F.col("Name"), F.col("Description"))


def to_catalog(rows: DataFrame) -> DataFrame:
    """Source columns to table columns; scores and part reviews stay NULL."""
    info = compose_info(
        F.col("Name"),
        F.col("Categories"),
        fold_description(*[F.col(f"`{c}`") for c in ("Description", "Tasting Notes", "Food Pairing", "Country")]),
    )
    ibu = to_whole(F.col("IBU"))
    given = {
        "beer_name": F.col("Name"),
        "brewery": blank_to_null(F.col("Brand")),
        "style": blank_to_null(F.col("Categories")),
        "abv": to_number(F.col("ABV")),
        "min_ibu": ibu,
        "max_ibu": ibu,
        "review_overall": to_number(F.col("Rating")),
        "number_of_reviews": to_whole(F.col("`Rate Count`")),
        "info": info,
    }
    own = ("id", "text_hash", "embedding", "embedded_at", "updated_at")
    return rows.select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CATALOG_SCHEMA
            if f.name not in own
        ],
        text_hash(info).alias("text_hash"),
        "file_row",
    )


def clean_catalog(rows: DataFrame) -> DataFrame:
    """Usable rows in table form, first per natural key in file order."""
    return first_wins(to_catalog(rows.filter(is_usable())), NATURAL_KEY, "file_row")


def load_catalog(spark: SparkSession, path: str, target: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Read, clean and upsert a file: the next snapshot and the load's counts.

    The text file is parsed once and kept as columns; counting, deduplication
    and the two sides of the upsert read those. The snapshot has a ``change``
    column (insert, update, keep).
    """
    rows = materialize(read_catalog(spark, path), "catalog-rows")
    source = materialize(clean_catalog(rows), "catalog-source")
    merged = upsert(target, source, NATURAL_KEY, as_of, "file_row", change_col="change")
    return merged, load_report(rows, is_usable(), merged, "change")


def load_and_record(
    spark: SparkSession, path: str, target: DataFrame, as_of: str, snapshot: str, meta: str, log: str,
    facts: Mapping[str, str] | None = None, **run,
) -> dict[str, int]:
    """Load a file into ``target`` and write the next snapshot; the counts come out of that
    write, go to the run log, and with ``facts`` into the provenance table at ``meta``."""
    merged, report = load_catalog(spark, path, target, F.lit(as_of).cast("timestamp"))
    changes = {c: F.count_if(F.col("change") == c) for c in ("insert", "update", "keep")}
    counts = {"rows": F.count_if(F.col("change") != "keep"), "total": F.count(F.lit(1)), **changes}

    def write(observed: DataFrame) -> None:
        observed.drop("change").write.mode("overwrite").parquet(snapshot)

    found = recorded(merged, write, counts, log, **run)
    entries = [*(facts or {}).items(), ("load_timestamp", as_of), ("row_count", str(found["total"]))]
    new = spark.createDataFrame([(k, str(v)) for k, v in entries], "key string, value string")
    update_table(spark, meta, new)
    found |= report.select("read", "skipped").first().asDict()
    return found | {"duplicates": found["read"] - found["skipped"] - found["rows"]}


def update_table(spark: SparkSession, meta: str, new: DataFrame) -> None:
    """Merge entries into the provenance table: a new version beside the old ones."""
    version, old = 1, new.limit(0)
    if exists(spark, meta):
        version = spark.read.option("basePath", meta).parquet(meta).agg(F.max("version")).first()[0] + 1
        old = read_meta(spark, meta)
    update_meta(old, new).coalesce(1).write.mode("overwrite").parquet(f"{meta}/version={version}")


def read_meta(spark: SparkSession, meta: str) -> DataFrame:
    """The latest version of a provenance table (key, value)."""
    rows = spark.read.option("basePath", meta).parquet(meta)
    last = rows.agg(F.max("version")).first()[0]
    return rows.filter(F.col("version") == last).select("key", "value")


def empty_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CATALOG_SCHEMA)
