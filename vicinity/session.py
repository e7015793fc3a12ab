"""Session helpers: test tables and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers.

    The same as submitting it with ``--py-files``; once per application.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        name = f"{tempfile.mkdtemp(prefix='run-')}/{package.name}"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


SPREAD_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """Deal a small table out to all cores before costly work on its rows.

    Only for input in fewer files than there are cores and of at most 1 GB; a
    bigger table has enough pieces of its own and is left where it is.
    """
    spark, files = df.sparkSession, df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if not files or len(files) >= cores:
        return df
    listed = spark.read.format("binaryFile").load(files)
    small = (listed.agg(F.sum("length")).first()[0] or 0) <= SPREAD_BYTES
    return df.repartition(cores) if small else df


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def state_of(spark: SparkSession, path: str) -> tuple:
    """Time, bytes and number of files of a table: other ones after it was rewritten."""
    system, place = _place(spark, path)
    summary = system.getContentSummary(place)
    return system.getFileStatus(place).getModificationTime(), summary.getLength(), summary.getFileCount()


_SCHEMAS: dict[tuple, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read once per application and state of its files, as a
    catalogue would keep it, so that opening it again starts no job."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path, state_of(spark, path))
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a stream of its files: a folder's, or the one file it is."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    system, place = _place(spark, path)
    if system.getFileStatus(place).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables, under the folder the cluster shares.

    The shared folder is the session's ``spark.checkpoint.dir``. Only a local
    session may go without one; a cluster job that loses an executor must find
    its tables again, which a machine-local folder cannot promise.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several later steps use: they read columns of a file, not
    the whole lineage again, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_STORED: dict[tuple, str] = {}


def stored_once(spark: SparkSession, name: str, sources: list[str], make: Callable[[], DataFrame]) -> DataFrame:
    """A table made of others and written once, as vectors of texts are; it is made again
    when a source has changed."""
    states = tuple((s, *state_of(spark, s)) for s in sources)
    key = (spark.sparkContext.applicationId, name, states)
    if key not in _STORED:
        path = scratch(spark, name)
        df = make()
        df.write.parquet(path)
        _STORED[key] = path
        _SCHEMAS[key] = df.schema
    return spark.read.schema(_SCHEMAS[key]).parquet(_STORED[key])
