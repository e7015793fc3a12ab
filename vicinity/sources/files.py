"""Files that executors write and read themselves, in the folder the cluster shares."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession

from vicinity.session import scratch


def shared_folder(spark: SparkSession, label: str) -> str:
    """URI of a fresh folder for files that executors write themselves."""
    path = scratch(spark, label)
    return path if "://" in path else path.replace("file:", "", 1) if path.startswith("file:") else path


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri.replace("file:", "", 1)


def reachable(uri: str) -> bool:
    """Whether a Python process can open the store of a folder, as Spark does."""
    try:
        file_system(uri)
    except (pa.ArrowException, OSError):
        return False
    return True


def write_file(folder: str, ending: str, parts: list[bytes]) -> tuple[str, int]:
    """Write a file under a name of its own; a repeated task writes another one,
    and only the name that its successful attempt reports is ever read."""
    uri = f"{folder}/{uuid.uuid4().hex}{ending}"
    system, path = file_system(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    size = 0
    with system.open_output_stream(path) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    return uri, size
