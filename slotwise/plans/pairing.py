"""Gold swap candidates.

A candidate pairs an over-subscribed show A with an under-used show B at the
same site starting at most ``band_seconds`` apart on a larger screen. Every
such pair is kept; invalid ones carry the first rule they break.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from slotwise.functions.exprs import candidate_id_sql, cents_sql, format_compatible_sql, money_diff_sql, pair_cents_sql, pair_revenue_sql, quote
from slotwise.operators.band import band_join
from slotwise.operators.rules import first_failure_sql
from slotwise.params import Params

Materializer = Callable[[DataFrame, str], DataFrame]

SIDE_COLUMNS = (
    "showtime_id", "theatre_id", "movie_id", "screen_id", "movie_title", "screen_name",
    "unconstrained_demand_forecast", "screen_capacity", "average_ticket_price", "movie_format",
    "screen_format", "show_start_ts", "forecast_confidence_score", "is_locked", "hours_to_show",
)
POLICY_COLUMNS = (
    "freeze_window_hours", "minimum_revenue_uplift", "minimum_confidence_score",
    "maximum_recommendations_per_day",
)

# Fixed values that must equal the reference's: rule names in the order they are tested.
LOCKED, FREEZE, FORMAT, NON_POSITIVE = "LOCKED_SHOWTIME", "FREEZE_WINDOW", "FORMAT_INCOMPATIBLE", "NON_POSITIVE_UPLIFT"
VALID, INVALID = "VALID", "INVALID"


def pair_inputs(enriched: DataFrame) -> DataFrame:
    """The columns pairing reads, for showtimes that can be in a pair at all
    (over or under capacity; a show exactly at capacity is neither)."""
    return enriched.where("unconstrained_demand_forecast <> screen_capacity").selectExpr(*SIDE_COLUMNS, *POLICY_COLUMNS)


def _side(enriched: DataFrame, prefix: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return enriched.selectExpr(*[f"{c} AS {prefix}{c}" for c in (*SIDE_COLUMNS, *extra)])


def busy_side(enriched: DataFrame) -> DataFrame:
    """Shows over their screen's capacity, as ``a_*`` with their site's policy."""
    return _side(enriched.where("unconstrained_demand_forecast > screen_capacity"), "a_", POLICY_COLUMNS)


def quiet_side(enriched: DataFrame) -> DataFrame:
    """Shows under their screen's capacity, as ``b_*``."""
    return _side(enriched.where("unconstrained_demand_forecast < screen_capacity"), "b_")


CENTS = {"forecast_cents": "unconstrained_demand_forecast", "price_cents": "average_ticket_price", "capacity_cents": "screen_capacity"}


def in_cents(side: DataFrame, prefix: str) -> DataFrame:
    """A side with its amounts in whole cents, taken from DOUBLE once per show and not once per pair.

    All three are NULL where one is NULL or not below a million: such pairs are priced in DECIMAL.
    """
    amounts = side.selectExpr("*", *(f"{cents_sql(prefix + c)} AS __{name}" for name, c in CENTS.items()))
    known = " AND ".join(f"__{name} IS NOT NULL" for name in CENTS)
    return amounts.selectExpr(*(f"`{c}`" for c in side.columns), *(f"CASE WHEN {known} THEN __{name} END AS {prefix}{name}" for name in CENTS))


def band_pairs(enriched: DataFrame, p: Params = Params(), hot_pairs: int | None = None, materialize: Materializer | None = None) -> DataFrame:
    """(a_*, b_*) rows for every qualifying pair.

    One-sided tests (A over capacity, B under capacity) run before the join,
    so only those rows are shuffled; the cross-side tests (different shows,
    B's screen larger, start times within the band) are the join residual.
    """
    return band_pairs_of(busy_side(enriched), quiet_side(enriched), p, hot_pairs, materialize)


def band_pairs_of(busy: DataFrame, quiet: DataFrame, p: Params = Params(), hot_pairs: int | None = None,
                  materialize: Materializer | None = None, spread: bool = False) -> DataFrame:
    """:func:`band_pairs` of given sides."""
    residual = "a_showtime_id <> b_showtime_id AND b_screen_capacity > a_screen_capacity"
    return band_join(
        busy, quiet, ["a_theatre_id"], ["b_theatre_id"], "a_show_start_ts", "b_show_start_ts",
        p.band_seconds, condition=residual, hot_pairs=hot_pairs, materialize=materialize, spread=spread,
    )


def failure_reason_sql() -> str:
    """First failing rule, or '' when the pair passes every rule."""
    return first_failure_sql(
        [
            ("showtime_a_locked OR showtime_b_locked", LOCKED),
            ("min_hours_to_show <= freeze_window_hours", FREEZE),
            ("NOT movie_a_target_compatible OR NOT movie_b_target_compatible", FORMAT),
            ("proposed_expected_ticket_revenue <= current_expected_ticket_revenue", NON_POSITIVE),
        ]
    )


# (output column, SQL over the a_/b_ pair columns), in output order.
def _pair_columns(p: Params) -> list[tuple[str, str]]:
    fa, fb = "a_unconstrained_demand_forecast", "b_unconstrained_demand_forecast"
    ca, cb = "a_screen_capacity", "b_screen_capacity"
    pa, pb = "a_average_ticket_price", "b_average_ticket_price"
    return [
        ("candidate_id", candidate_id_sql("a_showtime_id", "b_showtime_id", p.run_date)),
        ("theatre_id", "a_theatre_id"),
        ("showtime_a_id", "a_showtime_id"),
        ("showtime_b_id", "b_showtime_id"),
        ("movie_a_id", "a_movie_id"),
        ("movie_b_id", "b_movie_id"),
        ("movie_a_title", "a_movie_title"),
        ("movie_b_title", "b_movie_title"),
        ("current_screen_a_id", "a_screen_id"),
        ("current_screen_b_id", "b_screen_id"),
        ("proposed_screen_a_id", "b_screen_id"),
        ("proposed_screen_b_id", "a_screen_id"),
        ("current_screen_a", "a_screen_name"),
        ("current_screen_b", "b_screen_name"),
        ("recommended_screen_a", "b_screen_name"),
        ("recommended_screen_b", "a_screen_name"),
        ("forecast_a", fa),
        ("forecast_b", fb),
        ("current_capacity_a", ca),
        ("current_capacity_b", cb),
        ("proposed_capacity_a", cb),
        ("proposed_capacity_b", ca),
        ("price_a", pa),
        ("price_b", pb),
        ("movie_a_format", "a_movie_format"),
        ("movie_b_format", "b_movie_format"),
        ("proposed_screen_a_format", "b_screen_format"),
        ("proposed_screen_b_format", "a_screen_format"),
        ("show_start_ts", "a_show_start_ts"),
        ("forecast_confidence_score", "least(a_forecast_confidence_score, b_forecast_confidence_score)"),
        ("minimum_revenue_uplift", "a_minimum_revenue_uplift"),
        ("minimum_confidence_score", "a_minimum_confidence_score"),
        ("maximum_recommendations_per_day", "a_maximum_recommendations_per_day"),
        ("showtime_a_locked", "a_is_locked"),
        ("showtime_b_locked", "b_is_locked"),
        ("min_hours_to_show", "least(a_hours_to_show, b_hours_to_show)"),
        ("freeze_window_hours", "a_freeze_window_hours"),
        ("current_expected_ticket_revenue", pair_revenue_sql(fa, ca, pa, fb, cb, pb)),
        ("proposed_expected_ticket_revenue", pair_revenue_sql(fa, cb, pa, fb, ca, pb)),
        ("movie_a_target_compatible", format_compatible_sql("a_movie_format", "b_screen_format", p)),
        ("movie_b_target_compatible", format_compatible_sql("b_movie_format", "a_screen_format", p)),
    ]


def candidates(
    enriched: DataFrame, p: Params = Params(), hot_pairs: int | None = None, materialize: Materializer | None = None, with_run_ts: bool = True
) -> DataFrame:
    """Every band pair with revenue, uplift, compatibility and verdict."""
    busy, quiet = in_cents(busy_side(enriched), "a_"), in_cents(quiet_side(enriched), "b_")
    return judged(band_pairs_of(busy, quiet, p, hot_pairs, materialize, spread=bool(hot_pairs)), p, with_run_ts)


def judged(pairs: DataFrame, p: Params = Params(), with_run_ts: bool = True) -> DataFrame:
    """Candidate columns of (a_*, b_*) pairs; pairs of sides :func:`in_cents` are priced in whole cents."""
    columns = dict(_pair_columns(p))
    current, proposed = "current_expected_ticket_revenue", "proposed_expected_ticket_revenue"
    uplift = money_diff_sql(proposed, current)
    cents: list[str] = []
    if {"a_forecast_cents", "b_forecast_cents"} <= set(pairs.columns):
        cents = ["__current_cents", "__proposed_cents"]
        pairs = pairs.selectExpr("*", f"{pair_cents_sql('a_', 'a_', 'b_', 'b_')} AS __current_cents", f"{pair_cents_sql('a_', 'b_', 'b_', 'a_')} AS __proposed_cents")
        columns |= {current: f"coalesce(__current_cents / 100D, {columns[current]})", proposed: f"coalesce(__proposed_cents / 100D, {columns[proposed]})"}
        uplift = f"coalesce((__proposed_cents - __current_cents) / 100D, {uplift})"
    paired = pairs.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()], *cents)
    tested = paired.selectExpr(
        "*",
        f"{uplift} AS estimated_ticket_revenue_uplift",
        f"{failure_reason_sql()} AS constraint_failure_reason",
    )
    cols = [c for c in tested.columns if c not in ("constraint_failure_reason", *cents)]
    out = [
        *cols,
        f"CASE WHEN constraint_failure_reason = '' THEN {quote(VALID)} ELSE {quote(INVALID)} END AS constraint_validation_status",
        "constraint_failure_reason",
    ]
    if with_run_ts:
        out.append("current_timestamp() AS candidate_run_ts")
    return tested.selectExpr(*out)
