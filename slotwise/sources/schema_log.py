"""Headers of a feed over time (A2, A5, schema tracking).

Producers add, drop and reorder columns, so the files of one feed have several
headers. The header of every file is read first (one pass over the lines of the
files in question); each header met is a version, kept in a log beside the
data. Files are then scanned by version, each with the columns of its own
header, matched by name and rescued as usual. A column outside the feed's
schema is kept in ``_rescued_data``, or, with ``evolve="add"``, becomes a text
column from then on, NULL where files lack it.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from slotwise.schemas import Feed
from slotwise.sources import files
from slotwise.sources.csv_feeds import CSV_OPTIONS, feed_path, only_loads, raw_schema, rescue, with_ingest_metadata

EVOLVE = ("rescue", "add")


class SchemaLog:
    """Versions of a feed's header, in the order they were met."""

    def __init__(self, spark: SparkSession, root: str, feed: Feed) -> None:
        self.spark, self.path = spark, f"{root.rstrip('/')}/_schemas/{feed.name}"

    def versions(self) -> list[dict]:
        """Of each version the ``columns`` and the batch that brought it (``since``)."""
        return [json.loads(files.content(self.spark, f"{self.path}/{n}")) for n in files.names(self.spark, self.path) if n.endswith(".json")]

    def record(self, headers: Iterable[tuple[str, ...]], batch_id: str) -> list[dict]:
        """Add the headers that are new; all versions."""
        known = self.versions()
        for header in sorted(set(headers) - {tuple(v["columns"]) for v in known}):
            version = {"columns": list(header), "since": batch_id}
            files.create(self.spark, f"{self.path}/{len(known):06d}.json", json.dumps(version))
            known.append(version)
        return known

    def added(self, feed: Feed, schema: StructType) -> list[str]:
        """Columns of any version that the schema lacks, in the order they came."""
        names = {f.name for f in schema.fields} | {feed.partition_column}
        return [c for c in dict.fromkeys(c for v in self.versions() for c in v["columns"]) if c not in names]


def file_headers(lines: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Files by header, from ``lines`` (value, file, start: where the line's part of the file begins).

    A file's first line is the first one of the part that begins at 0. Only the
    lines found, one a file, are grouped; headers and file names come to the
    driver, which lists the files anyway.
    """
    placed = lines.where("start = 0").withColumn("place", F.monotonically_increasing_id())
    first = placed.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in first.collect():
        columns = next(csv.reader([r["header"].lstrip("﻿").rstrip("\r")]), [])
        out.setdefault(tuple(c.strip() for c in columns), []).append(unquote(r["file"]))
    return {h: sorted(fs) for h, fs in sorted(out.items()) if any(h)}


def with_places(lines: DataFrame) -> DataFrame:
    """value, file and start of a text scan."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def read_files(spark: SparkSession, root: str, feed: Feed, schema: StructType, found: dict[tuple[str, ...], list[str]], added: list[str],
               batch_id: str | None = None) -> DataFrame:
    """Typed and rescued rows of the files in ``found``, with the ``added`` columns as text; with a batch id, ingest metadata too."""
    wide = StructType([*schema.fields, *(StructField(c, StringType()) for c in added)])
    parts = []
    for header, paths in found.items():
        raw = spark.read.schema(raw_schema(list(header))).options(**CSV_OPTIONS, basePath=feed_path(root, feed)).csv(paths)
        rows = rescue(raw, wide, feed.partition_column)
        parts.append(rows if batch_id is None else with_ingest_metadata(rows, batch_id))
    return reduce(DataFrame.unionByName, parts)


def read_feed_versions(spark: SparkSession, root: str, feed: Feed, schema: StructType, log_root: str, batch_id: str,
                       evolve: str = "rescue", loads=None) -> DataFrame:
    """A1 + A5 for a feed whose files have different headers; headers met are recorded under ``log_root``."""
    if evolve not in EVOLVE:
        raise ValueError(f"evolve must be one of {EVOLVE}")
    lines = only_loads(spark.read.text(feed_path(root, feed)), feed, loads)
    found = file_headers(with_places(lines))
    log = SchemaLog(spark, log_root, feed)
    log.record(found, batch_id)
    if not found:
        return rescue(spark.createDataFrame([], raw_schema([f.name for f in schema.fields])), schema)
    return read_files(spark, root, feed, schema, found, log.added(feed, schema) if evolve == "add" else [])
