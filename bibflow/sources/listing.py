"""Folders listed by executors.

The driver lists the year folders only; what they hold becomes rows of a
DataFrame, listed by one task per folder, so that audits are joins and filters
and the work on the driver does not grow with the number of files.

Executors list through Arrow's file systems (local, HDFS, object stores).  For
other schemes the names come from the driver's Hadoop client instead, a folder
at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from fnmatch import translate
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bibflow.session import ship_package
from bibflow.sources import fs

LISTING_SCHEMA = "folder STRING, file_path STRING, name STRING, size BIGINT"
# Schemes that Arrow opens (fixed names); ``s3a`` is Hadoop's name of S3.
ARROW_SCHEMES = {"": "file", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
_BATCH = 10_000
_SCHEMA = pa.schema([("folder", pa.string()), ("file_path", pa.string()), ("name", pa.string()), ("size", pa.int64())])


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    parts = urlsplit(folder)
    scheme = ARROW_SCHEMES[parts.scheme]
    if scheme == "file":
        return pa.fs.LocalFileSystem(), parts.path if parts.scheme else folder
    return pa.fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{parts.path}")


def _list_folders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            store, path = _open(folder)
            found = [e for e in store.get_file_info(pa.fs.FileSelector(path)) if e.type == pa.fs.FileType.File]
            for at in range(0, len(found), _BATCH):
                part = found[at:at + _BATCH]
                yield pa.RecordBatch.from_arrays([
                    pa.array([folder] * len(part)), pa.array([f"{folder.rstrip('/')}/{e.base_name}" for e in part]),
                    pa.array([e.base_name for e in part]), pa.array([e.size for e in part], pa.int64())], schema=_SCHEMA)


def folder_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a Hadoop glob (one per year)."""
    return [unquote(e.path) if e.path.startswith("file:") else e.path for e in fs.glob(spark, pattern) if e.is_dir]


def list_files(spark: SparkSession, folder_pattern: str) -> DataFrame:
    """The files of all folders that match, hidden and empty ones included: (folder, file_path, name, size)."""
    folders = folder_paths(spark, folder_pattern)
    if not folders:
        return spark.createDataFrame([], LISTING_SCHEMA)
    if urlsplit(folders[0]).scheme not in ARROW_SCHEMES:
        rows = [(d, e.path, e.name, e.size) for d in folders for e in fs.children(spark, d) if not e.is_dir]
        return spark.createDataFrame(rows, LISTING_SCHEMA)
    ship_package(spark)
    frame = spark.createDataFrame([(d,) for d in folders], "folder STRING")
    return frame.repartition(len(folders), "folder").mapInArrow(_list_folders, LISTING_SCHEMA)


def name_matches(name_glob: str, name: str = "name") -> Column:
    """Whether a file name fits a shell pattern (``*.json``)."""
    if name_glob == "*":
        return F.lit(True)
    regex = translate(name_glob).removeprefix("(?s:").removesuffix(")\\z").removesuffix(")\\Z")
    return F.col(name).rlike(f"(?s)^(?:{regex})$")


def split_pattern(pattern: str) -> tuple[str, str]:
    """``<folders>/<names>`` -> both parts."""
    m = re.fullmatch(r"(.*)/([^/]*)", pattern)
    return m.group(1), m.group(2)
