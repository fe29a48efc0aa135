"""Gold demand forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.exprs import QUALITY_OK, confidence_sql, forecast_drivers_sql, quote
from slotwise.params import Params

CURVE = "current_booked_seats / expected_booking_completion_pct"


def forecast_columns(p: Params = Params()) -> list[str]:
    """Forecast values computed from a features row (SQL text, no join needed)."""
    return [
        f"round(greatest({CURVE}, historical_avg_attendance_movie), 2) AS unconstrained_demand_forecast",
        f"{confidence_sql(f'forecast_input_quality_status = {quote(QUALITY_OK)}', 'hours_to_show', p)} AS forecast_confidence_score",
    ]


def explained_columns(p: Params = Params()) -> list[str]:
    """:func:`forecast_columns` and the values that explain them."""
    return [
        *forecast_columns(p),
        f"round({CURVE}, 2) AS booking_curve_forecast",
        "historical_avg_attendance_movie AS historical_demand_baseline",
        f"{forecast_drivers_sql('current_booked_seats', 'historical_avg_attendance_movie', 'expected_booking_completion_pct')} AS top_forecast_drivers",
    ]


def demand_forecast(features: DataFrame, p: Params = Params(), with_run_ts: bool = True) -> DataFrame:
    """Booking-curve forecast floored by the film's baseline, rounded to 2."""
    cols = ["showtime_id", f"{quote(p.forecast_run_id)} AS forecast_run_id", *explained_columns(p)]
    if with_run_ts:
        cols.append("current_timestamp() AS forecast_run_ts")
    return features.selectExpr(*cols)


def enrich(features: DataFrame, policy: DataFrame, forecast: DataFrame | None = None, p: Params = Params()) -> DataFrame:
    """C3 + C4: features with their forecast and their site's policy.

    The forecast is a per-row function of the features, so by default it is
    computed inline instead of joined back (one less shuffle). Pass
    ``forecast`` to join a stored forecast table on showtime_id instead.
    A site without a policy drops its showtimes.
    """
    feats = features.drop("feature_run_ts")
    if forecast is None:
        e = feats.selectExpr("*", *forecast_columns(p))
    else:
        fc = forecast.selectExpr("showtime_id AS _fc_sid", "unconstrained_demand_forecast", "forecast_confidence_score")
        e = feats.join(fc, F.expr("showtime_id = _fc_sid")).drop("_fc_sid")
    pol = policy.selectExpr(
        "theatre_id AS _p_site", "freeze_window_hours", "minimum_revenue_uplift", "minimum_confidence_score",
        "maximum_recommendations_per_day",
    )
    return e.join(pol, F.expr("theatre_id = _p_site")).drop("_p_site")
