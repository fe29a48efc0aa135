"""Bronze ingest of feeds whose header changes (A2-A6, schema tracking).

The stream finds new files exactly once per checkpoint and reads them as lines,
which tell each file's header; a micro-batch then scans its files by header
version, rescues them and appends them as one batch to a table that readers see
whole batches of. The micro-batch's number is the batch's tag, so a batch that
is run again after a failure is appended once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slotwise.schemas import Feed
from slotwise.sources.append_log import AppendTable
from slotwise.sources.csv_feeds import feed_path
from slotwise.sources.schema_log import EVOLVE, SchemaLog, file_headers, read_files, with_places
from slotwise.streaming.bronze import BronzeLayout


def ingest_evolving(spark: SparkSession, layout: BronzeLayout, feeds: Mapping[Feed, StructType], batch_id: str, evolve: str = "rescue",
                    max_files_per_trigger: int | None = None) -> dict[str, AppendTable]:
    """Drain every feed; feed name -> its bronze table."""
    if evolve not in EVOLVE:
        raise ValueError(f"evolve must be one of {EVOLVE}")
    out, running = {}, []
    for feed, schema in feeds.items():
        table = AppendTable(spark, layout.table(feed))
        log = SchemaLog(spark, layout.root, feed)

        def load(lines: DataFrame, n: int, feed=feed, schema=schema, table=table, log=log) -> None:
            found = file_headers(lines)
            if found:
                log.record(found, batch_id)
                rows = read_files(spark, layout.landing, feed, schema, found, log.added(feed, schema) if evolve == "add" else [], batch_id)
                table.append(rows, f"batch-{n:08d}")

        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        lines = with_places(reader.load(feed_path(layout.landing, feed)))
        query = lines.writeStream.foreachBatch(load).option("checkpointLocation", layout.checkpoint(feed)).trigger(availableNow=True).start()
        running.append(query)
        out[feed.name] = table
    for query in running:
        query.awaitTermination()
    return out
