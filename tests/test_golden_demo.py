"""The demo fixture end to end: 4 candidates, 3 recommendations, golden values."""

import pytest
from demo import demo_feeds

from slotwise.plans import quality
from slotwise.plans.pipeline import Pipeline

GOLDEN = {
    # pair: (forecast A, forecast B, confidence, current, proposed, uplift, status, reason)
    "n": (180.0, 40.0, 0.86, 1650.0, 1920.0, 270.0, "VALID", ""),  # 150*9 + 40*7.5 -> 180*9 + 40*7.5
    "s": (140.0, 55.0, 0.86, 1300.0, 2300.0, 1000.0, "VALID", ""),  # 60*12.5 + 55*10 -> 140*12.5 + 55*10
    "h": (200.0, 40.0, 0.72, 2175.0, 2800.0, 625.0, "VALID", ""),  # 60 booked at 102 hours: 60 / 0.30
    "x": (180.0, 200.0, 0.86, 4140.0, 2700.0, -1440.0, "INVALID", "FORMAT_INCOMPATIBLE"),
}


@pytest.fixture(scope="module")
def demo(spark):
    return Pipeline(demo_feeds(spark))


def test_counts(demo):
    assert demo.features.count() == 17
    assert demo.candidates.count() == 4
    assert demo.recommendations.count() == 3


def test_golden_candidates(demo):
    rows = {r["showtime_a_id"][0]: r for r in demo.candidates.collect()}
    assert set(rows) == set(GOLDEN)
    for pair, (fa, fb, conf, cur, prop, up, status, reason) in GOLDEN.items():
        r = rows[pair]
        assert r["showtime_b_id"] == pair + "-quiet"
        assert (r["forecast_a"], r["forecast_b"]) == (fa, fb)
        assert r["forecast_confidence_score"] == conf
        assert r["current_expected_ticket_revenue"] == cur
        assert r["proposed_expected_ticket_revenue"] == prop
        assert r["estimated_ticket_revenue_uplift"] == up
        assert (r["constraint_validation_status"], r["constraint_failure_reason"]) == (status, reason)


def test_recommendation_text_and_ids(demo):
    recs = {r["showtime_a_id"]: r for r in demo.recommendations.collect()}
    assert set(recs) == {"n-busy", "s-busy", "h-busy"}
    r = recs["n-busy"]
    assert r["recommendation_reason"] == (
        "Move Amber from Hall h2 to Hall h3 because predicted demand is 180 seats against current "
        "capacity of 150, while Dune is predicted at 40 seats against capacity of 240. "
        "Estimated ticket revenue uplift: $270."
    )
    assert r["recommendation_status"] == "PROPOSED"
    assert r["recommendation_run_id"] == "recommendation-2026-07-01"
    assert len(r["recommendation_id"]) == 64
    assert str(r["show_date"]) == "2026-07-02"


def test_quality_gate_and_audit(demo):
    counts = quality.enforce(demo.recommendations, demo.candidates)
    assert counts == {"recommendation_count": 3, "bad_recommendation_count": 0, "invalid_candidate_count": 1}
    audit = {r["check_name"]: (r["status"], r["detail"]) for r in quality.audit(demo.recommendations, demo.candidates).collect()}
    assert audit == {
        "gold_recommendations_min_count": ("PASS", "recommendation_count=3"),
        "gold_candidates_invalid_present": ("PASS", "invalid_candidate_count=1"),
    }


def test_forecast_drivers_text(demo):
    r = {x["showtime_id"]: x for x in demo.forecast.collect()}["n-busy"]
    assert r["top_forecast_drivers"] == "booked_seats=70; baseline=180.0; completion_pct=0.42"
    assert r["forecast_run_id"] == "forecast-2026-07-01"
    assert r["booking_curve_forecast"] == 166.67


def test_split_hot_groups_give_identical_candidates(spark):
    """A site's band with three busy shows is 'hot' at hot_pairs=1: splitting it must not change the result."""
    from datetime import datetime

    from demo import booking_row, demo_rows, show_row

    from slotwise.sources.tables import parquet_materializer

    rows = demo_rows()
    for n, minute in enumerate((25, 35)):
        start = datetime(2026, 7, 2, 20, minute)
        rows["showtime_schedule"].append(show_row(f"n-more{n}", "north", "h1", "basalt", start))
        rows["booking_snapshot"].append(booking_row(f"n-more{n}", start, 33))
    plain = Pipeline(demo_feeds(spark, rows), hot_pairs=None)
    split = Pipeline(demo_feeds(spark, rows), materialize=parquet_materializer(spark), hot_pairs=1)
    assert plain.candidates.where("theatre_id = 'north' AND showtime_b_id = 'n-quiet'").count() == 3
    cols = ["candidate_id", "estimated_ticket_revenue_uplift", "constraint_failure_reason"]
    assert sorted(plain.candidates.select(*cols).collect()) == sorted(split.candidates.select(*cols).collect())
    assert sorted(plain.recommendations.select("recommendation_id").collect()) == sorted(
        split.recommendations.select("recommendation_id").collect()
    )


def test_publish_writes_every_layer_and_views(spark):
    import tempfile

    from slotwise.sources.tables import parquet_materializer

    pl = Pipeline(demo_feeds(spark), materialize=parquet_materializer(spark))
    root = tempfile.mkdtemp(prefix="publish-")
    counts = pl.publish(spark, root, {"silver": "silver_d", "gold": "gold_d", "ops": "ops_d"})
    assert counts["gold_d.gold_screen_allocation_candidates"] == 4
    assert counts["gold_d.gold_screen_allocation_recommendations"] == 3
    assert counts["silver_d.fact_showtime_schedule_current"] == 17
    assert counts["ops_d.ops_data_quality_audit"] == 2
    views = pl.register_views("demo_")
    assert "demo_gold_screen_allocation_recommendations" in views
    assert spark.sql("SELECT count(*) AS n FROM demo_gold_screen_allocation_candidates").collect()[0]["n"] == 4
