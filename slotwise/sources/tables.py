"""Tables: create-or-replace as select, namespaces, listing, barriers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from slotwise.session import run_dir
from slotwise.sources import files
from slotwise.sources.versions import VersionedTable, show_table, show_version


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """A10: create-or-replace a parquet table at ``path`` and return a scan of it."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def parquet_materializer(spark: SparkSession, label: str = "stages"):
    """A barrier that writes each stage once to the shared folder.

    The written copy survives executor loss (unlike a local checkpoint) and
    later scans get column pruning and filter pushdown from parquet.
    """
    root = run_dir(spark, label)

    def materialize(df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{root}/{name}")

    materialize.root = root  # type: ignore[attr-defined]
    return materialize


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE SCHEMA IF NOT EXISTS."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{loc}")


def table_root(spark: SparkSession, name: str) -> str:
    """Folder of ``namespace.table`` under its namespace's location."""
    namespace, _, table = name.rpartition(".")
    return f"{spark.catalog.getDatabase(namespace or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{table}"


def save_table(df: DataFrame, name: str, path: str | None = None, keep: int = 2) -> DataFrame:
    """A10: create or replace table ``name`` atomically, under ``path`` or its namespace's folder.

    A new version is written beside the old one, committed, and shown under the
    name (:mod:`slotwise.sources.versions`); the newest ``keep`` versions stay
    for readers that started on them. A query may read the table it replaces.
    """
    spark = df.sparkSession
    table = VersionedTable(spark, path or table_root(spark, name))
    scan = table.publish(df)
    show_version(spark, name, table.path())
    table.expire(keep)
    return scan


def save_clustered(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None, keep: int = 2) -> DataFrame:
    """A10: :func:`save_table` with every version in ``buckets`` by ``keys``, each sorted by them.

    Tables clustered alike join and group by ``keys`` without an exchange. The
    catalog has to know the buckets, so each version is an external table of its
    own (``<name>__<version>``) and ``name`` is a view of the current one.
    """
    spark = df.sparkSession
    namespace, _, table = name.rpartition(".")
    root = path or table_root(spark, name)
    version = f"{table}__{uuid.uuid4().hex[:12]}"
    own = f"{namespace}.{version}" if namespace else version
    # One writer task per bucket, so that a bucket is one sorted file and not one per task.
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", f"{root.rstrip('/')}/{version}").saveAsTable(own))
    show_table(spark, name, own)
    former = [t for t in list_tables(spark, namespace or spark.catalog.currentDatabase()) if t.startswith(f"{table}__") and t != version]
    kept = _newest(spark, namespace, former, keep - 1)
    for t in set(former) - set(kept):
        where = spark.sql(f"DESCRIBE TABLE EXTENDED {namespace + '.' if namespace else ''}{t}").where("col_name = 'Location'").first()["data_type"]
        spark.sql(f"DROP TABLE {namespace + '.' if namespace else ''}{t}")
        files.delete(spark, where)
    return spark.table(name)


def _newest(spark: SparkSession, namespace: str, tables: list[str], n: int) -> list[str]:
    """The ``n`` tables created last."""
    def created(t: str) -> int:
        held = spark._jsparkSession.sessionState().catalog().getTableMetadata(
            spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(f"{namespace}.{t}" if namespace else t))
        return held.createTime()

    return sorted(tables, key=created, reverse=True)[: max(0, n)]


def point_table(spark: SparkSession, name: str, path: str) -> None:
    """Show the parquet folder at ``path`` under ``name``; readers meet the former folder or this one."""
    show_version(spark, name, path)


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    """Table names in a namespace."""
    return sorted(t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary)
