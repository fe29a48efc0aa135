"""Silver: typed, current-state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from slotwise.operators.latest import latest_by_key
from slotwise.schemas import AVAILABILITY, BOOKING, ID_COLUMNS, MOVIE, POLICY, SCHEDULE, SCREEN, THEATRE, Feed

DEDUP_MODES = ("latest", "distinct")
NEWEST = "source_updated_ts DESC NULLS LAST"


def typed(df: DataFrame, feed: Feed) -> DataFrame:
    """Project ``feed``'s columns in order, cast to their silver types.

    Id columns keep the producer's type. Casts are strict: under ANSI mode a
    value that does not parse raises (bad values are rescued in bronze).
    """
    dtypes = dict(df.dtypes)
    cols = []
    for name, dtype in feed.columns:
        t = dtype.simpleString()
        if name in ID_COLUMNS or dtypes.get(name) == t:
            cols.append(f"`{name}`")
        else:
            cols.append(f"CAST(`{name}` AS {t}) AS `{name}`")
    return df.selectExpr(*cols)


def _dedup_dim(df: DataFrame, key: str, mode: str) -> DataFrame:
    if mode == "distinct":
        return df.distinct()
    if mode == "latest":
        return latest_by_key(df, [key], [NEWEST])
    raise ValueError(f"dedup must be one of {DEDUP_MODES}")


def conform_theatre(bronze: DataFrame, dedup: str = "latest") -> DataFrame:
    """B1: one row per site."""
    return _dedup_dim(typed(bronze, THEATRE).where("theatre_id IS NOT NULL"), "theatre_id", dedup)


def conform_screen(bronze: DataFrame, dedup: str = "latest") -> DataFrame:
    """B2: screens with a positive capacity."""
    return _dedup_dim(typed(bronze, SCREEN).where("screen_id IS NOT NULL AND capacity > 0"), "screen_id", dedup)


def conform_movie(bronze: DataFrame, dedup: str = "latest") -> DataFrame:
    """Films."""
    return _dedup_dim(typed(bronze, MOVIE).where("movie_id IS NOT NULL"), "movie_id", dedup)


def current_schedule(bronze: DataFrame) -> DataFrame:
    """B4 + E1: newest version per showtime, *then* drop it if it ends before it starts.

    Rank first, validate second: a bad newest version removes the showtime,
    it does not fall back to an older one.
    """
    latest = latest_by_key(typed(bronze, SCHEDULE), ["showtime_id"], [NEWEST])
    return latest.where("show_end_ts > show_start_ts")


def booking_snapshots(bronze: DataFrame) -> DataFrame:
    """B5 + E2: newest version per (showtime, snapshot time), then drop negative seats."""
    latest = latest_by_key(typed(bronze, BOOKING), ["showtime_id", "snapshot_ts"], [NEWEST])
    return latest.where("booked_seats >= 0")


def conform_availability(bronze: DataFrame) -> DataFrame:
    """Projection only (empty blackout text reads back as NULL from CSV)."""
    return typed(bronze, AVAILABILITY)


def conform_policy(bronze: DataFrame, dedup: str | None = "latest") -> DataFrame:
    """Projection; by default one row per policy id (newest), so a
    re-ingested policy does not multiply candidates."""
    t = typed(bronze, POLICY)
    return t if dedup is None else _dedup_dim(t, "policy_id", dedup)


SILVER_SOURCES = {
    "dim_theatre": "theatre_master",
    "dim_screen": "screen_master",
    "dim_movie": "movie_master",
    "fact_showtime_schedule_current": "showtime_schedule",
    "fact_booking_snapshot": "booking_snapshot",
    "fact_screen_availability": "screen_availability",
    "fact_schedule_policy": "schedule_policy",
}


def silver_table(name: str, feed: DataFrame, dims: str = "latest") -> DataFrame:
    """One silver table from its bronze feed."""
    build = {
        "dim_theatre": lambda: conform_theatre(feed, dims),
        "dim_screen": lambda: conform_screen(feed, dims),
        "dim_movie": lambda: conform_movie(feed, dims),
        "fact_showtime_schedule_current": lambda: current_schedule(feed),
        "fact_booking_snapshot": lambda: booking_snapshots(feed),
        "fact_screen_availability": lambda: conform_availability(feed),
        "fact_schedule_policy": lambda: conform_policy(feed, dims),
    }
    return build[name]()


def silver_tables(feeds, dims: str = "latest") -> dict[str, DataFrame]:
    """All seven silver tables from bronze feeds keyed by feed name."""
    return {name: silver_table(name, feeds[src], dims) for name, src in SILVER_SOURCES.items()}

