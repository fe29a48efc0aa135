"""Feed and table schemas.

Ids are typed by the producer (strings in CSV feeds, integers from the
parquet adapter); every other column has one fixed silver type.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, I, D, B = StringType(), IntegerType(), DoubleType(), BooleanType()
TS, DT = TimestampNTZType(), DateType()


@dataclass(frozen=True)
class Feed:
    name: str
    partition_column: str
    columns: tuple[tuple[str, DataType], ...]
    key: tuple[str, ...]

    def schema(self, id_type: DataType | None = None) -> StructType:
        """Silver schema; ``id_type`` overrides the type of id columns."""
        fields = []
        for name, dtype in self.columns:
            if id_type is not None and name in ID_COLUMNS:
                dtype = id_type
            fields.append(StructField(name, dtype, True))
        return StructType(fields)

    def string_schema(self) -> StructType:
        """All columns as text: the raw form a rescuing reader starts from."""
        return StructType([StructField(n, S, True) for n, _ in self.columns])

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.columns]


ID_COLUMNS = frozenset(
    {
        "theatre_id", "screen_id", "movie_id", "showtime_id", "snapshot_id",
        "availability_id", "policy_id",
    }
)

THEATRE = Feed(
    "theatre_master", "snapshot_date",
    (("theatre_id", S), ("theatre_name", S), ("city", S), ("state", S), ("region", S),
     ("timezone", S), ("theatre_status", S), ("source_updated_ts", TS)),
    ("theatre_id",),
)
SCREEN = Feed(
    "screen_master", "snapshot_date",
    (("screen_id", S), ("theatre_id", S), ("screen_name", S), ("capacity", I),
     ("screen_format", S), ("is_active", B), ("source_updated_ts", TS)),
    ("screen_id",),
)
MOVIE = Feed(
    "movie_master", "snapshot_date",
    (("movie_id", S), ("movie_title", S), ("genre", S), ("language", S), ("runtime_minutes", I),
     ("movie_format", S), ("release_date", DT), ("distributor", S), ("average_ticket_price", D),
     ("seeded_baseline_demand", D), ("source_updated_ts", TS)),
    ("movie_id",),
)
SCHEDULE = Feed(
    "showtime_schedule", "snapshot_date",
    (("showtime_id", S), ("theatre_id", S), ("screen_id", S), ("movie_id", S),
     ("show_start_ts", TS), ("show_end_ts", TS), ("schedule_status", S), ("is_locked", B),
     ("published_ts", TS), ("source_updated_ts", TS)),
    ("showtime_id",),
)
BOOKING = Feed(
    "booking_snapshot", "load_date",
    (("snapshot_id", S), ("showtime_id", S), ("snapshot_ts", TS), ("booked_seats", I),
     ("booking_count", I), ("gross_booking_revenue", D), ("hours_to_show", D),
     ("source_updated_ts", TS)),
    ("showtime_id", "snapshot_ts"),
)
AVAILABILITY = Feed(
    "screen_availability", "snapshot_date",
    (("availability_id", S), ("theatre_id", S), ("screen_id", S), ("available_from_ts", TS),
     ("available_to_ts", TS), ("is_available", B), ("blackout_reason", S),
     ("minimum_turnaround_minutes", I), ("source_updated_ts", TS)),
    ("availability_id",),
)
POLICY = Feed(
    "schedule_policy", "snapshot_date",
    (("policy_id", S), ("theatre_id", S), ("freeze_window_hours", D),
     ("minimum_revenue_uplift", D), ("minimum_confidence_score", D),
     ("maximum_recommendations_per_day", I), ("source_updated_ts", TS)),
    ("policy_id",),
)

FEEDS: dict[str, Feed] = {
    f.name: f for f in (THEATRE, SCREEN, MOVIE, SCHEDULE, BOOKING, AVAILABILITY, POLICY)
}

# Bronze metadata columns, in order.
META_COLUMNS = ("_ingest_ts", "_source_file", "_batch_id", "_source_snapshot_date", "_rescued_data")

# Silver table names, in pipeline order.
SILVER_NAMES = (
    "dim_theatre", "dim_screen", "dim_movie", "fact_showtime_schedule_current",
    "fact_booking_snapshot", "fact_screen_availability", "fact_schedule_policy",
)
