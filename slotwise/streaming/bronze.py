"""Bronze ingest as Structured Streaming file streams.

Each feed directory is a CSV file-stream source; new files are picked up
exactly once per checkpoint, rows get ingest metadata (and rescued fields),
and are appended to a parquet table. ``trigger(availableNow=True)`` drains
what is there in bounded micro-batches and stops, so a scheduled batch job
and a continuous job run the same code.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from slotwise.schemas import Feed
from slotwise.sources.csv_feeds import CSV_OPTIONS, feed_path, header_columns, raw_schema, rescue, with_ingest_metadata
from slotwise.sources.tables import point_table


@dataclass(frozen=True)
class BronzeLayout:
    """Where landing files, tables and checkpoints live for one refresh generation.

    A full refresh (A7) starts a new generation: new table and checkpoint
    folders, so nothing is deleted and no old progress is reused.
    """

    landing: str
    root: str
    generation: int = 0

    def table(self, feed: Feed) -> str:
        return f"{self.root.rstrip('/')}/g{self.generation}/bronze_{feed.name}"

    def checkpoint(self, feed: Feed) -> str:
        return f"{self.root.rstrip('/')}/g{self.generation}/_checkpoints/{feed.name}"

    def refreshed(self) -> "BronzeLayout":
        return BronzeLayout(self.landing, self.root, self.generation + 1)


def stream_feed(spark: SparkSession, landing: str, feed: Feed, schema: StructType, batch_id: str,
                rescue_fields: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """A2: streaming scan of one feed directory with metadata (A3, A4) and rescue (A5)."""
    path = feed_path(landing, feed)
    reader = spark.readStream.schema(raw_schema(header_columns(spark, path, feed, schema))).options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = rescue(reader.csv(path), schema, feed.partition_column)
    return with_ingest_metadata(df if rescue_fields else df.drop("_rescued_data"), batch_id)


def start_ingest(df: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet table, one checkpoint per source, drain and stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_all(spark: SparkSession, layout: BronzeLayout, feeds: Mapping[Feed, StructType], batch_id: str,
               rescue_fields: bool = True, namespace: str | None = None,
               max_files_per_trigger: int | None = None) -> dict[str, str]:
    """Start every feed's stream, then wait for each; returns feed name -> table path.

    With ``namespace`` each bronze table is also a catalog table ``<namespace>.bronze_<feed>``.
    The name is pointed at this generation's folder once the stream has ended,
    so after a refresh it shows the new generation, whole.
    ``max_files_per_trigger`` bounds each micro-batch, so a large backlog is
    drained in several committed batches instead of one.
    """
    running = []
    for feed, schema in feeds.items():
        df = stream_feed(spark, layout.landing, feed, schema, batch_id, rescue_fields, max_files_per_trigger)
        running.append((feed, start_ingest(df, layout.table(feed), layout.checkpoint(feed))))
    out = {}
    for feed, q in running:
        q.awaitTermination()
        if q.exception() is not None:  # pragma: no cover - surfaced to the caller
            raise q.exception()
        out[feed.name] = layout.table(feed)
        if namespace:
            point_table(spark, f"{namespace}.bronze_{feed.name}", layout.table(feed))
    return out
