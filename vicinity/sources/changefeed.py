"""The changes of a divided table as a stream.

``spark.readStream.format("snapshot_changes").option("path", ...)`` follows the versions
of a table of ``operators.snapshots``: offsets are versions, and a micro-batch holds what
differs between two of them, each id once, as insert, update or delete with the row as it
is (or was last). A partition of the stream is a division whose generation has changed;
the others aren't read. The option ``since`` says after which version to start (default:
0, the whole table as inserts).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

CHANGE = "change"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri.removeprefix("file:")


def _versions(path: str) -> list[int]:
    """Versions that are written completely."""
    system, place = _open(f"{path}/manifest")
    found = system.get_file_info(pafs.FileSelector(place, recursive=True))
    done = (f.path.split("/")[-2] for f in found if f.path.endswith("/_SUCCESS") and "version=" in f.path)
    return sorted(int(d.removeprefix("version=")) for d in done)


def _manifest(path: str, version: int) -> list[dict]:
    if version == 0:  # before the first version there is nothing
        return []
    system, place = _open(f"{path}/manifest/version={version}")
    return pq.ParquetDataset(place, filesystem=system, partitioning=None).read().to_pylist()


class Division(InputPartition):
    def __init__(self, number: int, old: int | None, new: int | None) -> None:
        self.number, self.old, self.new = number, old, new


class ChangeReader(DataSourceStreamReader):
    def __init__(self, path: str, since: int, schema: StructType) -> None:
        self.path, self.since, self.schema = path, since, schema
        facts = next(r for r in _manifest(path, _versions(path)[-1]) if r["division"] == -1)
        self.id_col = facts["id_col"]

    def initialOffset(self) -> dict:
        return {"version": self.since}

    def latestOffset(self) -> dict:
        return {"version": max([self.since, *_versions(self.path)])}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        old, new = ({r["division"]: r["gen"] for r in _manifest(self.path, o["version"]) if r["division"] >= 0} for o in (start, end))
        return [Division(d, old.get(d), g) for d, g in sorted(new.items()) if old.get(d) != g]

    def read(self, partition: Division) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in self.schema if f.name != CHANGE]
        was, now = ({r[self.id_col]: r for r in self._rows(partition.number, g, names)} for g in (partition.old, partition.new))
        out = [{CHANGE: "delete", **r} for i, r in was.items() if i not in now]
        out += [{CHANGE: "update" if i in was else "insert", **r} for i, r in now.items() if was.get(i) != r]
        for at in range(0, len(out), 4096):
            yield pa.RecordBatch.from_pylist(out[at : at + 4096], to_arrow_schema(self.schema))

    def _rows(self, division: int, gen: int | None, names: list[str]) -> list[dict]:
        system, place = _open(f"{self.path}/rows/gen={gen}/division={division}")
        if gen is None or system.get_file_info(place).type != pafs.FileType.Directory:
            return []  # an empty division has no folder
        table = pq.ParquetDataset(place, filesystem=system, partitioning=None).read(columns=names)
        return table.select(names).to_pylist()

    def commit(self, end: dict) -> None:
        """Versions stay as they are."""


class SnapshotChanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "snapshot_changes"

    def schema(self) -> StructType:
        path = self.options["path"].rstrip("/")
        facts = next(r for r in _manifest(path, _versions(path)[-1]) if r["division"] == -1)
        return StructType([StructField(CHANGE, StringType()), *StructType.fromJson(json.loads(facts["schema"])).fields])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ChangeReader(self.options["path"].rstrip("/"), int(self.options.get("since", 0)), schema)


def register(spark: SparkSession) -> None:
    # the process that plans a stream doesn't see files added to the session
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SnapshotChanges)
