"""Domain rules as SQL expression text, with Column wrappers.

Stages build their projections from these texts with ``selectExpr`` /
``where``: one Python-to-JVM call per projection instead of several per
column. The ``Column`` versions (same names without ``_sql``) are for callers
that compose Columns. Arguments are SQL expressions (column names or any
expression text); Python numbers become literals.

Money is computed in DECIMAL and rounded half-up there, then returned as
DOUBLE, so half-cent ties round the same way on every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.params import Params

MONEY = "DECIMAL(18,2)"

# Fixed values that must equal the reference's (texts of published output):
#   reason sentence, in order:
#     "Move " <film A> " from " <screen A> " to " <screen B>
#     " because predicted demand is " <forecast A, whole seats>
#     " seats against current capacity of " <capacity A>
#     ", while " <film B> " is predicted at " <forecast B, whole seats>
#     " seats against capacity of " <capacity B>
#     ". Estimated ticket revenue uplift: $" <uplift, whole dollars> "."
#   forecast drivers: "booked_seats=" <n> "; baseline=" <x> "; completion_pct=" <p, 2 decimals>
#   candidate id: sha256 hex of "<showtime A>|<showtime B>|<run date>"
#   recommendation id: sha256 hex of "<candidate id>|recommendation"
#   quality flags: OK / NO_BOOKING_SNAPSHOT
REASON_PARTS = (
    "Move ", " from ", " to ", " because predicted demand is ", " seats against current capacity of ",
    ", while ", " is predicted at ", " seats against capacity of ", ". Estimated ticket revenue uplift: $", ".",
)
QUALITY_OK, QUALITY_MISSING = "OK", "NO_BOOKING_SNAPSHOT"


def text(value) -> str:
    """SQL text for a Python value or an expression string."""
    if isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    raise TypeError(f"not an SQL expression: {value!r}")


def quote(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def money_sql(x) -> str:
    return f"CAST({text(x)} AS {MONEY})"


def completion_pct_sql(hours, p: Params = Params()) -> str:
    """Expected share of final bookings already made ``hours`` before the show."""
    h = text(hours)
    arms = " ".join(f"WHEN {h} <= {text(float(limit))} THEN {text(float(pct))}" for limit, pct in p.completion_curve)
    return f"CASE {arms} ELSE {text(float(p.completion_default))} END"


def confidence_sql(quality_ok, hours, p: Params = Params()) -> str:
    """Fresh booking data -> high, older -> medium, none -> low."""
    ok, h = text(quality_ok), text(hours)
    return (
        f"CASE WHEN ({ok}) AND {h} <= {text(float(p.confident_hours))} THEN {text(float(p.confidence_fresh))} "
        f"WHEN ({ok}) THEN {text(float(p.confidence_stale))} ELSE {text(float(p.confidence_missing))} END"
    )


def capped_revenue_sql(forecast, capacity, price) -> str:
    """Seats sold cannot exceed capacity; DECIMAL result (4 places)."""
    return f"least({money_sql(forecast)}, {money_sql(capacity)}) * {money_sql(price)}"


def pair_revenue_sql(fa, cap_a, price_a, fb, cap_b, price_b) -> str:
    """Revenue of two shows, rounded to cents (DOUBLE)."""
    total = f"{capped_revenue_sql(fa, cap_a, price_a)} + {capped_revenue_sql(fb, cap_b, price_b)}"
    return f"CAST(round({total}, 2) AS DOUBLE)"


def cents_sql(x) -> str:
    """A money amount as whole cents (BIGINT), rounded as :func:`money_sql` rounds; NULL from a million on, where sums of products may leave a DOUBLE's exact range."""
    amount = f"try_cast({text(x)} AS {MONEY})"
    return f"CASE WHEN abs({amount}) < 1000000 THEN CAST({amount} * 100 AS BIGINT) END"


def pair_cents_sql(show_a, screen_a, show_b, screen_b) -> str:
    """J7 in whole cents (BIGINT) by the prefixes of each show and of the screen it plays on; half cents round away from zero."""
    total = " + ".join(
        f"least({show}forecast_cents, {screen}capacity_cents) * {show}price_cents" for show, screen in ((show_a, screen_a), (show_b, screen_b)))
    return f"CASE WHEN {total} >= 0 THEN ({total} + 50) div 100 ELSE -((50 - ({total})) div 100) END"


def swap_uplift_sql(fa, cap_a, price_a, fb, cap_b, price_b) -> str:
    """Revenue after exchanging the two screens minus revenue now (DOUBLE)."""
    now = f"round({capped_revenue_sql(fa, cap_a, price_a)} + {capped_revenue_sql(fb, cap_b, price_b)}, 2)"
    swapped = f"round({capped_revenue_sql(fa, cap_b, price_a)} + {capped_revenue_sql(fb, cap_a, price_b)}, 2)"
    return f"CAST(({swapped}) - ({now}) AS DOUBLE)"


def money_diff_sql(a, b) -> str:
    """a - b for two cent amounts, exact (DOUBLE)."""
    return f"CAST({money_sql(a)} - {money_sql(b)} AS DOUBLE)"


def format_compatible_sql(film_format, screen_format, p: Params = Params()) -> str:
    """A standard film plays on any listed screen, others need their own format.

    Case-sensitive; NULL formats give NULL, which falls through the failure chain.
    """
    film, screen = text(film_format), text(screen_format)
    fits = ", ".join(quote(s) for s in p.standard_fits)
    return f"CASE WHEN {film} = {quote(p.standard_format)} THEN {screen} IN ({fits}) ELSE {film} = {screen} END"


def candidate_id_sql(a_id, b_id, run_date: str) -> str:
    """Stable, order-sensitive id of a pair for one run."""
    return f"sha2(concat_ws('|', CAST({text(a_id)} AS STRING), CAST({text(b_id)} AS STRING), {quote(run_date)}), 256)"


def recommendation_id_sql(cand_id) -> str:
    return f"sha2(concat_ws('|', {text(cand_id)}, 'recommendation'), 256)"


def _whole(x) -> str:
    return f"CAST(CAST(round({text(x)}, 0) AS INT) AS STRING)"


def reason_text_sql(film_a, screen_a, screen_b, forecast_a, capacity_a, film_b, forecast_b, capacity_b, uplift) -> str:
    """One English sentence; NULL when any part is NULL."""
    values = [
        text(film_a), text(screen_a), text(screen_b), _whole(forecast_a), f"CAST({text(capacity_a)} AS STRING)",
        text(film_b), _whole(forecast_b), f"CAST({text(capacity_b)} AS STRING)", _whole(uplift),
    ]
    pieces = []
    for i, lit in enumerate(REASON_PARTS):
        pieces.append(quote(lit))
        if i < len(values):
            pieces.append(values[i])
    return f"concat({', '.join(pieces)})"


def forecast_drivers_sql(booked, baseline, pct) -> str:
    """The inputs behind a forecast, as text."""
    return (
        f"concat('booked_seats=', CAST({text(booked)} AS STRING), '; baseline=', CAST({text(baseline)} AS STRING), "
        f"'; completion_pct=', CAST(CAST({text(pct)} AS DECIMAL(3,2)) AS STRING))"
    )


# ---- Column versions -------------------------------------------------------


def completion_pct(hours, p: Params = Params()) -> Column:
    return F.expr(completion_pct_sql(hours, p))


def confidence_score(quality_ok, hours, p: Params = Params()) -> Column:
    return F.expr(confidence_sql(quality_ok, hours, p))


def money(x) -> Column:
    return F.expr(money_sql(x))


def capped_revenue(forecast, capacity, price) -> Column:
    return F.expr(capped_revenue_sql(forecast, capacity, price))


def pair_revenue(fa, cap_a, price_a, fb, cap_b, price_b) -> Column:
    return F.expr(pair_revenue_sql(fa, cap_a, price_a, fb, cap_b, price_b))


def swap_uplift(fa, cap_a, price_a, fb, cap_b, price_b) -> Column:
    return F.expr(swap_uplift_sql(fa, cap_a, price_a, fb, cap_b, price_b))


def format_compatible(film_format, screen_format, p: Params = Params()) -> Column:
    return F.expr(format_compatible_sql(film_format, screen_format, p))


def candidate_id(a_id, b_id, run_date: str) -> Column:
    return F.expr(candidate_id_sql(a_id, b_id, run_date))


def recommendation_id(cand_id) -> Column:
    return F.expr(recommendation_id_sql(cand_id))


def reason_text(*args) -> Column:
    return F.expr(reason_text_sql(*args))


def forecast_drivers(booked, baseline, pct) -> Column:
    return F.expr(forecast_drivers_sql(booked, baseline, pct))
