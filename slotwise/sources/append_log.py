"""Tables that grow by whole batches: folders and a log of what counts.

Every batch is a folder of its own, written by an ordinary Spark job and then
named in the log; readers scan the folders the log names, so they see a batch
whole or not at all. A batch has a tag: appending the same tag again, as a
re-run micro-batch does, changes nothing. ``compact`` writes many small batches
as one folder and replaces them in one log entry, while others append; the
replaced folders stay until ``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slotwise.sources import files


class AppendTable:
    """One growing table under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _entries(self) -> list[tuple[int, list[str]]]:
        """(number, fields) of the complete log entries in order."""
        log = f"{self.root}/_log"
        out = []
        for name in files.names(self.spark, log):
            line = files.content(self.spark, f"{log}/{name}") if name.isdigit() else ""
            if line.endswith("\n"):
                out.append((int(name), line.split()))
        return out

    def _commit(self, line: str, stale: Callable[[], bool]) -> bool:
        """Add an entry after all others, unless what is there makes it ``stale``."""
        while not stale():
            entries = self._entries()
            path = f"{self.root}/_log/{entries[-1][0] + 1 if entries else 0:010d}"
            try:
                files.create(self.spark, path, line + "\n")
                return True
            except Exception:
                if not files.exists(self.spark, path):
                    raise
        return False

    def tags(self) -> list[str]:
        """Tags of all batches that were appended."""
        return [f[1] for _, f in self._entries() if f[0] == "add"]

    def folders(self) -> list[str]:
        """The folders that make up the table."""
        held: list[str] = []
        for _, (action, *rest) in self._entries():
            if action == "add":
                held.append(rest[1])
            else:
                new, *old = rest
                held = [f for f in held if f not in old] + [new]
        return [f"{self.root}/{f}" for f in held]

    def append(self, df: DataFrame, tag: str) -> bool:
        """Add a batch; False if its tag is there already."""
        if tag in self.tags():
            return False
        folder = f"{tag}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.root}/{folder}")
        return self._commit(f"add {tag} {folder}", lambda: tag in self.tags())

    def read(self, schema: StructType | str | None = None, folders: list[str] | None = None) -> DataFrame:
        """All batches, or those in ``folders``; columns that only some of them have are null in the others."""
        folders = self.folders() if folders is None else folders
        if not folders:
            if schema is None:
                raise FileNotFoundError(f"no batch under {self.root}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.option("mergeSchema", schema is None).parquet(*folders)

    def compact(self, most: int = 1, change: Callable[[DataFrame], DataFrame] | None = None, partitions: int | None = None,
                rebalance: bool = True) -> bool:
        """Write the batches there are as one, if they are more than ``most``; ``change`` may reduce their rows.

        ``partitions`` sets the number of files; by default adaptive execution chooses it by size. Without
        ``rebalance`` rows are written where ``change`` left them: right if it shuffles them itself.
        """
        old = [f.rsplit("/", 1)[1] for f in self.folders()]
        if len(old) <= most:
            return False
        df = self.read()
        df = change(df) if change else df
        folder = f"compact-{uuid.uuid4().hex[:8]}"
        df = df.repartition(partitions) if partitions else df.hint("rebalance") if rebalance else df
        df.write.parquet(f"{self.root}/{folder}")
        gone = lambda: not set(old) <= {f.rsplit("/", 1)[1] for f in self.folders()}
        return self._commit(" ".join(["put", folder, *old]), gone)

    def vacuum(self) -> list[str]:
        """Remove folders that a later entry replaced."""
        held = set(self.folders())
        gone = [f"{self.root}/{f}" for _, (action, *rest) in self._entries() if action == "put" for f in rest[1:] if f"{self.root}/{f}" not in held]
        for path in gone:
            files.delete(self.spark, path)
        return gone
