"""Current state kept up by streams (E1, E2 incremental).

Rows of a bronze table stream in micro-batches; each is reduced to the newest
version per key and appended as one batch of changes. What is current is the
newest change per key, by the same order; rules on the newest version (a bad
one removes the key) are tested on reading. ``compact`` leaves one row per key.
A load reads its own rows and touches its own keys. The changes are the state:
no key is held in the executors' memory from load to load, however many keys
there are, and a version that is older than one appended before loses on reading.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators.latest import latest_by_key
from slotwise.plans.silver import NEWEST, typed
from slotwise.schemas import BOOKING, SCHEDULE, Feed
from slotwise.sources.append_log import AppendTable


class CurrentState:
    """Newest version per ``keys`` of a feed; ``valid`` is tested on the newest one only."""

    def __init__(self, spark: SparkSession, root: str, feed: Feed, keys: Sequence[str], valid: str | None = None) -> None:
        self.spark, self.feed, self.keys, self.valid = spark, feed, list(keys), valid
        self.checkpoint = f"{root.rstrip('/')}/_checkpoint"
        self.changes = AppendTable(spark, f"{root.rstrip('/')}/changes")

    def update(self, bronze: DataFrame, prepare: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Take in what is new in the streaming scan ``bronze``; the number of rows read."""
        rows = typed(prepare(bronze) if prepare else bronze, self.feed)
        others = [c for c in rows.columns if c not in self.keys]
        # Nulls are smallest in a struct's order, as they come last in the batch order.
        newest = F.max(F.struct("source_updated_ts", *(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)))).alias("newest")
        named = [*self.keys, *(F.col(f"newest._{i}").alias(c) for i, c in enumerate(others))]

        def load(batch: DataFrame, n: int) -> None:
            self.changes.append(batch.groupBy(*self.keys).agg(newest).select(*named), f"batch-{n:08d}")

        query = rows.writeStream.foreachBatch(load).option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    def _newest(self, changes: DataFrame) -> DataFrame:
        return latest_by_key(changes, self.keys, [NEWEST])

    def read(self) -> DataFrame:
        """The current rows."""
        folders = self.changes.folders()
        now = self.changes.read(folders=folders or None)
        # A batch of changes has one row per key and so has a compacted one; only several have to be ranked.
        now = now if len(folders) == 1 else self._newest(now)
        now = now.where(self.valid) if self.valid else now
        return now.select(*(c for c, _ in self.feed.columns))

    def compact(self, most: int = 1) -> bool:
        """One row per key, if there are more than ``most`` batches of changes."""
        # The ranking deals the rows by key already, in as many parts as their size asks for.
        return self.changes.compact(most, self._newest, rebalance=False)


def schedule_state(spark: SparkSession, root: str) -> CurrentState:
    """E1 + B4: the newest version of a showtime, unless it ends before it starts."""
    return CurrentState(spark, root, SCHEDULE, ["showtime_id"], "show_end_ts > show_start_ts")


def booking_state(spark: SparkSession, root: str) -> CurrentState:
    """E2 + B5: the newest version of a booking snapshot, unless its seats are negative."""
    return CurrentState(spark, root, BOOKING, ["showtime_id", "snapshot_ts"], "booked_seats >= 0")
