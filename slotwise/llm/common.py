"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.session import run_dir
from slotwise.sources import files

#: Java pattern of the white space that separates words.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of written tables, per open recording.
_RECORDED: list[list[str]] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and scan it from there.

    It cuts lineage, survives lost executors and is computed once whoever
    reads it.
    """
    folder = run_dir(df.sparkSession, "llm")
    path = f"{folder}/{label}"
    df.write.parquet(path)
    if _RECORDED:
        _RECORDED[-1].append(folder)
    scan = df.sparkSession.read.schema(df.schema).parquet(path)
    scan._written_under = folder
    return scan


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`written` made, when all that is made from them is written too."""
    for t in tables:
        files.delete(t.sparkSession, t._written_under)


@contextmanager
def recording():
    """The folders of all tables written inside, for :func:`remove_unread`."""
    _RECORDED.append([])
    try:
        yield _RECORDED[-1]
    finally:
        _RECORDED.pop()


def remove_unread(folders: list[str], docs: DataFrame) -> list[str]:
    """Remove the folders that ``docs`` doesn't read; the others."""
    read = docs.inputFiles()
    needed = [f for f in folders if any(f.rsplit("/", 1)[1] in path for path in read)]
    for f in set(folders) - set(needed):
        files.delete(docs.sparkSession, f)
    return needed


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A plain reference inside a lambda is inlined by the optimizer and then
    evaluated once per array element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    The archive holds source code only; Spark's own file server delivers it.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    import slotwise

    package = os.path.dirname(os.path.abspath(slotwise.__file__ or slotwise.__path__[0] + "/__init__.py"))
    archive = os.path.join(tempfile.mkdtemp(prefix="slotwise-code-"), "slotwise_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
