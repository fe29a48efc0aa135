"""Domain Column expressions (JVM-side, no Python UDFs)."""

from slotwise.functions.exprs import (
    candidate_id,
    capped_revenue,
    completion_pct,
    confidence_score,
    format_compatible,
    forecast_drivers,
    money,
    pair_revenue,
    reason_text,
    recommendation_id,
    swap_uplift,
)

__all__ = [
    "candidate_id",
    "capped_revenue",
    "completion_pct",
    "confidence_score",
    "format_compatible",
    "forecast_drivers",
    "money",
    "pair_revenue",
    "reason_text",
    "recommendation_id",
    "swap_uplift",
]
