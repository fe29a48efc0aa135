"""Stages written once, counted while they are written, and removed after use.

A :class:`StageStore` is the barrier of one run. A stage is known by its plan
and its input files: asked for again, the written copy is scanned and one more
use is counted. Metrics of a stage are observed by the job that writes it, so
row counts and checks need no further scan. ``release`` gives up a use, and a
stage without uses is removed; closing the store, or the end of the
application, removes the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise.session import run_dir
from slotwise.sources import files


@dataclass
class _Stage:
    path: str
    scan: DataFrame
    metrics: dict = field(default_factory=dict)
    uses: int = 0


def _key(df: DataFrame) -> str:
    read = hashlib.sha256("\n".join(sorted(df.inputFiles())).encode()).hexdigest()[:16]
    return f"{df.semanticHash() & 0xFFFFFFFF:08x}-{read}"


class StageStore:
    """Written stages of one run under the shared folder."""

    def __init__(self, spark: SparkSession, label: str = "stages") -> None:
        self.spark = spark
        self.root = run_dir(spark, label)
        self.writes: list[str] = []  #: names in the order they were written
        self._held: dict[str, _Stage] = {}
        self._named: dict[str, str] = {}
        files.delete_at_end(spark, self.root)

    def stage(self, df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None) -> DataFrame:
        """A scan of ``df``, written on its first use; ``metrics`` are aggregates observed by that write."""
        key = _key(df)
        if key not in self._held:
            seen = Observation()
            measured = {"rows": F.count(F.lit(1)), **(metrics or {})}
            path = f"{self.root}/{len(self.writes):03d}-{name}"
            df.observe(seen, *(c.alias(k) for k, c in measured.items())).write.parquet(path)
            self.writes.append(name)
            self._held[key] = _Stage(path, self.spark.read.schema(df.schema).parquet(path), dict(seen.get))
        self._held[key].uses += 1
        self._named[name] = key
        return self._held[key].scan

    __call__ = stage

    def metrics(self, name: str) -> dict:
        """What was observed when the stage was written; ``rows`` always."""
        return self._held[self._named[name]].metrics

    def release(self, name: str) -> None:
        """Give up one use of a stage; without uses it is removed."""
        key = self._named.get(name)
        if key in self._held:
            self._held[key].uses -= 1
            if self._held[key].uses <= 0:
                files.delete(self.spark, self._held.pop(key).path)

    def close(self) -> None:
        self._held.clear()
        files.delete(self.spark, self.root)

    def __enter__(self) -> "StageStore":
        return self

    def __exit__(self, *_) -> None:
        self.close()
