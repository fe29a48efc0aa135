"""Gold recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from slotwise.functions.exprs import quote, reason_text_sql, recommendation_id_sql
from slotwise.operators.topn import top_n_per_group
from slotwise.params import Params
from slotwise.plans.pairing import VALID

GATE = (
    f"constraint_validation_status = {quote(VALID)}"
    " AND estimated_ticket_revenue_uplift >= minimum_revenue_uplift"
    " AND forecast_confidence_score >= minimum_confidence_score"
)

#: What the gate reads, besides the uplift.
GATED_BY = ("constraint_validation_status", "minimum_revenue_uplift", "forecast_confidence_score", "minimum_confidence_score")

BEST_FIRST = ["estimated_ticket_revenue_uplift DESC NULLS LAST", "showtime_a_id ASC NULLS LAST", "showtime_b_id ASC NULLS LAST"]


def publish_gate(candidates: DataFrame) -> DataFrame:
    """Valid pairs meeting their site's uplift and confidence minimums (inclusive)."""
    return candidates.where(GATE)


def daily_top_n(gated: DataFrame, cap: int | None = None, rank_col: str | None = None) -> DataFrame:
    """At most the site's daily maximum per (site, show date), best uplift first.

    Ties are broken by the show ids so the result is reproducible. ``cap`` is
    a literal bound on every site's maximum (the largest policy value); it
    lets Spark keep only ``cap`` rows per group on the map side.
    """
    g = gated.selectExpr("*", "CAST(show_start_ts AS DATE) AS show_date")
    return top_n_per_group(
        g,
        ["theatre_id", "show_date"],
        BEST_FIRST,
        "maximum_recommendations_per_day",
        cap=cap,
        rank_col=rank_col,
    )


def daily_top_n_of_batches(gated: DataFrame, batch: str, cap: int | None = None) -> DataFrame:
    """The best rows of every batch (an SQL expression, as ``__batch``), site and day, in one pass over gated candidates.

    A row that its own batch does not list is in no merged list, so this is all of a batch that a merge needs.
    """
    g = gated.selectExpr("*", f"{batch} AS __batch", "CAST(show_start_ts AS DATE) AS __day")
    return top_n_per_group(g, ["__batch", "theatre_id", "__day"], BEST_FIRST, "maximum_recommendations_per_day", cap=cap).drop("__day")


def merged_daily_top_n(listed: DataFrame | None, batch: DataFrame, cap: int | None = None) -> DataFrame:
    """E4 batch by batch: the daily list of all candidates so far, from the list before and a new batch.

    ``listed`` are the candidate rows listed before, ``batch`` new ones, gated or not. A row that
    is not among the best of its site and day now never will be, so the list, at most the daily
    maximum per group, is all that has to be kept; each map task cuts both to that many rows.
    """
    gated = publish_gate(batch)
    return daily_top_n(gated if listed is None else listed.unionByName(gated), cap).drop("show_date")


def policy_cap(policy: DataFrame) -> int | None:
    """Largest daily maximum over all sites (one scalar from a small table)."""
    rows = policy.selectExpr("max(maximum_recommendations_per_day) AS m").collect()
    return None if not rows or rows[0]["m"] is None else int(rows[0]["m"])


def recommendations(
    candidates: DataFrame, p: Params = Params(), cap: int | None = None, with_run_ts: bool = True
) -> DataFrame:
    """The published list of advisory swaps with a plain-English reason."""
    top = daily_top_n(publish_gate(candidates), cap)
    reason = reason_text_sql(
        "movie_a_title", "current_screen_a", "recommended_screen_a", "forecast_a", "current_capacity_a",
        "movie_b_title", "forecast_b", "current_capacity_b", "estimated_ticket_revenue_uplift",
    )
    cols = [
        f"{recommendation_id_sql('candidate_id')} AS recommendation_id",
        f"{quote(p.recommendation_run_id)} AS recommendation_run_id",
        "'PROPOSED' AS recommendation_status",
        "theatre_id", "show_date", "show_start_ts", "showtime_a_id", "showtime_b_id",
        "movie_a_title", "movie_b_title", "current_screen_a", "current_screen_b",
        "recommended_screen_a", "recommended_screen_b", "forecast_a", "forecast_b",
        "current_capacity_a", "current_capacity_b", "estimated_ticket_revenue_uplift", "forecast_confidence_score",
        f"{reason} AS recommendation_reason",
        f"{quote(p.rules_version)} AS rules_version",
        f"{quote(p.forecast_version)} AS forecast_version",
    ]
    if with_run_ts:
        cols += ["current_timestamp() AS data_freshness_ts", "current_timestamp() AS created_ts"]
    return top.selectExpr(*cols)
