"""Small files and folders through the file system that Spark itself uses.

Paths are anything a Spark reader opens. Only metadata goes through here
(commit files, folder removal, listings); table data are read and written by
Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where it is absent."""
    fs, where = _open(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; a path that is gone already is fine."""
    fs, where = _open(spark, path)
    fs.delete(where, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder removed when the application ends."""
    fs, where = _open(spark, path)
    fs.mkdirs(where)
    fs.deleteOnExit(where)


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file; a path that exists already raises."""
    fs, where = _open(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def content(spark: SparkSession, path: str) -> str:
    fs, where = _open(spark, path)
    source = fs.open(where)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()
