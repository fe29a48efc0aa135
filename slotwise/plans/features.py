"""Gold demand features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.exprs import QUALITY_MISSING, QUALITY_OK, completion_pct_sql, quote, text
from slotwise.operators.latest import latest_by_key
from slotwise.params import Params


def latest_booking(bookings: DataFrame) -> DataFrame:
    """Newest snapshot per showtime (not bounded by the run date)."""
    return latest_by_key(bookings, ["showtime_id"], ["snapshot_ts DESC NULLS LAST"])


def demand_features(
    schedule: DataFrame,
    screens: DataFrame,
    movies: DataFrame,
    bookings: DataFrame,
    p: Params = Params(),
    with_run_ts: bool = True,
) -> DataFrame:
    """One row per published showtime with a known screen and film.

    Join order keeps the showtime partitioning: the schedule and the latest
    booking are both hash-partitioned on showtime_id by their de-duplication,
    so their outer join needs no further exchange when neither side is
    broadcast; the screen and film lookups are broadcast by the caller when
    their size is checked. Unmatched screens/films drop the showtime.
    """
    s = schedule.where(f"schedule_status = {quote(p.published_status)}")
    b = latest_booking(bookings).selectExpr("showtime_id AS _b_sid", "booked_seats AS _b_seats", "hours_to_show AS _b_hours")
    sc = screens.selectExpr("screen_id AS _sc_id", "capacity AS screen_capacity", "screen_format", "screen_name")
    m = movies.selectExpr("movie_id AS _m_id", "movie_title", "movie_format", "average_ticket_price", "seeded_baseline_demand")
    j = (
        s.join(b, F.expr("showtime_id = _b_sid"), "left")
        .join(sc, F.expr("screen_id = _sc_id"))
        .join(m, F.expr("movie_id = _m_id"))
    )
    booked = "coalesce(_b_seats, 0)"
    hours = f"coalesce(_b_hours, {text(float(p.missing_hours))})"
    cols = [
        "showtime_id",
        "theatre_id",
        "screen_id",
        "movie_id",
        "CAST(show_start_ts AS DATE) AS show_date",
        "date_format(show_start_ts, 'E') AS day_of_week",
        "date_format(show_start_ts, 'HH:mm') AS time_slot",
        "screen_capacity",
        f"{booked} AS current_booked_seats",
        f"{hours} AS hours_to_show",
        f"{completion_pct_sql(hours, p)} AS expected_booking_completion_pct",
        f"round({booked} / screen_capacity, 4) AS booking_pace_ratio",
        "seeded_baseline_demand AS historical_avg_attendance_movie",
        "round(seeded_baseline_demand / screen_capacity, 4) AS historical_avg_occupancy_movie",
        "average_ticket_price",
        "movie_format",
        "screen_format",
        "screen_name",
        "movie_title",
        "show_start_ts",
        "show_end_ts",
        "is_locked",
        "dayofweek(show_start_ts) IN (1, 7) AS is_weekend",
        f"CASE WHEN _b_sid IS NULL THEN {quote(QUALITY_MISSING)} ELSE {quote(QUALITY_OK)} END AS forecast_input_quality_status",
    ]
    if with_run_ts:
        cols.append("current_timestamp() AS feature_run_ts")
    return j.selectExpr(*cols)
