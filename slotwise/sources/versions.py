"""Tables published atomically: versioned folders and a commit log.

``<root>/v-<id>`` holds one whole version, written by an ordinary Spark job.
``<root>/_commits/<number>`` is a one-line file that names the version folder;
the highest complete one is current. A commit file is created, never
overwritten, so of two writers that commit the same number one fails; one that
lacks its line end is not complete and is passed over. Readers resolve the log
first and then scan a folder that no one changes: they see the old version or
the new one, and a writer that is killed leaves the old one. Superseded
versions go when ``expire`` is called, not before.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from slotwise.sources import files


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the log."""


@dataclass(frozen=True)
class Version:
    path: str
    base: int  #: number of the commit it was written on top of, -1 for none


class VersionedTable:
    """One table of versions under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def _log(self) -> str:
        return f"{self.root}/_commits"

    def commits(self) -> list[tuple[int, str]]:
        """(number, folder) of all complete commits, oldest first."""
        out = []
        for name in files.names(self.spark, self._log):
            if name.isdigit():
                line = files.content(self.spark, f"{self._log}/{name}")
                if line.endswith("\n"):
                    out.append((int(name), f"{self.root}/{line.strip()}"))
        return out

    def path(self) -> str | None:
        """Folder of the current version, None before the first."""
        found = self.commits()
        return found[-1][1] if found else None

    def read(self) -> DataFrame:
        path = self.path()
        if path is None:
            raise FileNotFoundError(f"no version committed under {self.root}")
        return self.spark.read.parquet(path)

    def write(self, df: DataFrame, partition_by: Sequence[str] = ()) -> Version:
        """A new version, not yet visible."""
        found = self.commits()
        path = f"{self.root}/v-{uuid.uuid4().hex[:12]}"
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
        return Version(path, found[-1][0] if found else -1)

    def commit(self, version: Version) -> str:
        """Make a version current; its folder."""
        found = self.commits()
        if (found[-1][0] if found else -1) != version.base:
            raise CommitConflict(f"{self.root} has moved past commit {version.base}")
        try:
            files.create(self.spark, f"{self._log}/{version.base + 1:010d}", version.path.rsplit("/", 1)[1] + "\n")
        except Exception as e:
            if files.exists(self.spark, f"{self._log}/{version.base + 1:010d}"):
                raise CommitConflict(f"{self.root} has moved past commit {version.base}") from e
            raise
        return version.path

    def publish(self, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write and commit; a scan of the new version."""
        return self.spark.read.parquet(self.commit(self.write(df, partition_by)))

    def expire(self, keep: int = 2) -> list[str]:
        """Remove all but the newest ``keep`` versions that were committed; their folders."""
        gone = [path for _, path in self.commits()[: -max(1, keep)] if files.exists(self.spark, path)]
        for path in gone:
            files.delete(self.spark, path)
        return gone


def show_version(spark: SparkSession, name: str, path: str) -> None:
    """Make catalog name ``name`` a view of the folder at ``path``.

    Replacing a view is one change in the catalog: readers meet the old folder or the new one.
    A name that a table holds is refused, as freeing it would leave a gap.
    """
    _show(spark, name, f"parquet.`{path}`")


def show_table(spark: SparkSession, name: str, table: str) -> None:
    """Make catalog name ``name`` a view of a catalog table, as :func:`show_version` does of a folder."""
    _show(spark, name, _quoted(table))


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _show(spark: SparkSession, name: str, source: str) -> None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table, not a view of versions")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {source}")
