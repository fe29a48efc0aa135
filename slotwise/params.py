"""Rule thresholds for the whole pipeline, in one frozen object.

Fixed values that must equal the reference's for the same results
(defaults below):
  band between paired shows: 900 seconds, whole seconds, inclusive
  booking completion curve: hours <= 24 -> 0.55, hours <= 72 -> 0.42, else 0.30
  hours used when no booking snapshot exists: 999
  confidence: booking present and hours <= 96 -> 0.86, booking present -> 0.72, else 0.50
  format rule: a STANDARD film fits STANDARD or PREMIUM screens; any other film
               needs a screen of its own format
  published schedule status: PUBLISHED
  audit minimums: 3 recommendations, 1 invalid candidate
  version stamps: mvp_rules_v1, baseline_forecast_v1
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    run_date: str = "2026-07-01"
    band_seconds: int = 900
    completion_curve: tuple[tuple[float, float], ...] = ((24.0, 0.55), (72.0, 0.42))
    completion_default: float = 0.30
    missing_hours: float = 999.0
    confident_hours: float = 96.0
    confidence_fresh: float = 0.86
    confidence_stale: float = 0.72
    confidence_missing: float = 0.50
    standard_format: str = "STANDARD"
    standard_fits: tuple[str, ...] = ("STANDARD", "PREMIUM")
    published_status: str = "PUBLISHED"
    min_recommendations: int = 3
    min_invalid_candidates: int = 1
    rules_version: str = "mvp_rules_v1"
    forecast_version: str = "baseline_forecast_v1"

    @property
    def forecast_run_id(self) -> str:
        return f"forecast-{self.run_date}"

    @property
    def recommendation_run_id(self) -> str:
        return f"recommendation-{self.run_date}"
