"""File-system metadata through the session's Hadoop configuration.

Only metadata (names, sizes) is listed here, as Spark's own file index does
when it plans a scan; file contents are always read by executors.  Works for
any Hadoop-compatible store (local, HDFS, object stores).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FileEntry:
    path: str
    name: str
    size: int
    is_dir: bool


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob(spark: SparkSession, pattern: str) -> list[FileEntry]:
    """Entries matching a Hadoop glob (``{a,b}``, ``*``, ``?`` ...)."""
    fs, p = _fs(spark, pattern)
    statuses = fs.globStatus(p) or []
    return [FileEntry(str(s.getPath().toString()), str(s.getPath().getName()), int(s.getLen()),
                      bool(s.isDirectory())) for s in statuses]


def children(spark: SparkSession, path: str) -> list[FileEntry]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [FileEntry(str(s.getPath().toString()), str(s.getPath().getName()), int(s.getLen()),
                      bool(s.isDirectory())) for s in fs.listStatus(p)]


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file (used to build audit fixtures)."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small metadata file as text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
