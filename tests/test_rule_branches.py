"""Every rule branch on small literal variations of the demo."""

from datetime import datetime, timedelta

import pytest
from demo import NOON, booking_row, demo_feeds, demo_rows, show_row

from slotwise.plans import quality
from slotwise.plans.pipeline import Pipeline

SCHED, BOOK, POL, FILM = "showtime_schedule", "booking_snapshot", "schedule_policy", "movie_master"


def run(spark, rows):
    pl = Pipeline(demo_feeds(spark, rows))
    cands = {(r["showtime_a_id"], r["showtime_b_id"]): r for r in pl.candidates.collect()}
    recs = {(r["showtime_a_id"], r["showtime_b_id"]): r for r in pl.recommendations.collect()}
    return pl, cands, recs


def reason(cands, a="n-busy", b="n-quiet"):
    return cands[(a, b)]["constraint_failure_reason"]


def replace(rows, table, key, **changes):
    cols = {
        SCHED: ["showtime_id", "theatre_id", "screen_id", "movie_id", "show_start_ts", "show_end_ts",
                "schedule_status", "is_locked", "published_ts", "source_updated_ts"],
        BOOK: ["snapshot_id", "showtime_id", "snapshot_ts", "booked_seats", "booking_count",
               "gross_booking_revenue", "hours_to_show", "source_updated_ts"],
        POL: ["policy_id", "theatre_id", "freeze_window_hours", "minimum_revenue_uplift",
              "minimum_confidence_score", "maximum_recommendations_per_day", "source_updated_ts"],
        FILM: ["movie_id", "movie_title", "genre", "language", "runtime_minutes", "movie_format",
               "release_date", "distributor", "average_ticket_price", "seeded_baseline_demand", "source_updated_ts"],
    }[table]
    key_col = {SCHED: 0, BOOK: 1, POL: 1, FILM: 0}[table]
    out = []
    for r in rows[table]:
        if r[key_col] == key:
            r = list(r)
            for k, v in changes.items():
                r[cols.index(k)] = v
            r = tuple(r)
        out.append(r)
    rows[table] = out


def test_freeze_window_is_inclusive(spark):
    rows = demo_rows()
    replace(rows, POL, "north", freeze_window_hours=32.5)  # the busy show starts in 32.5 hours
    _, cands, recs = run(spark, rows)
    assert reason(cands) == "FREEZE_WINDOW"
    assert reason(cands, "s-busy", "s-quiet") == ""
    assert ("n-busy", "n-quiet") not in recs


def test_format_incompatible(spark):
    rows = demo_rows()
    replace(rows, FILM, "dune", movie_format="PREMIUM")  # quiet film would move to a STANDARD screen
    _, cands, _ = run(spark, rows)
    assert reason(cands) == "FORMAT_INCOMPATIBLE"
    assert cands[("n-busy", "n-quiet")]["movie_b_target_compatible"] is False


def test_non_positive_uplift_at_zero(spark):
    rows = demo_rows()
    # 180 for the quiet film fit 240 seats but not 150: the swap loses 30 seats at 9.0 = 270, exactly the gain.
    replace(rows, FILM, "dune", seeded_baseline_demand=180.0, average_ticket_price=9.0)
    _, cands, recs = run(spark, rows)
    c = cands[("n-busy", "n-quiet")]
    assert c["estimated_ticket_revenue_uplift"] == 0.0
    assert reason(cands) == "NON_POSITIVE_UPLIFT"
    assert c["constraint_validation_status"] == "INVALID"


def test_daily_cap_breaks_ties_by_show_ids(spark):
    rows = demo_rows()
    start = datetime(2026, 7, 2, 20, 30)
    for show, hall, film, seats in (("n-busy2", "h2", "amber", 70), ("n-quiet2", "h3", "dune", 12)):
        rows[SCHED].append(show_row(show, "north", hall, film, start))
        rows[BOOK].append(booking_row(show, start, seats))
    replace(rows, POL, "north", maximum_recommendations_per_day=1)
    _, cands, recs = run(spark, rows)
    of_day = lambda found: [k for k, r in found.items() if r["theatre_id"] == "north" and r["show_start_ts"].date() == start.date()]
    assert len(of_day(cands)) == 4 and {cands[k]["estimated_ticket_revenue_uplift"] for k in of_day(cands)} == {270.0}
    assert of_day(recs) == [("n-busy", "n-quiet")]


def test_newest_version_invalid_removes_showtime(spark):
    rows = demo_rows()
    newer = show_row("n-busy", "north", "h2", "amber", datetime(2026, 7, 2, 20, 30), loaded=NOON, minutes=0)  # ends when it starts
    rows[SCHED].append(newer)
    pl, cands, recs = run(spark, rows)
    assert pl.silver["fact_showtime_schedule_current"].where("showtime_id = 'n-busy'").count() == 0
    assert len(cands) == 3 and len(recs) == 2


def test_duplicate_snapshots_keep_newest_version_and_latest_snapshot(spark):
    rows = demo_rows()
    start = datetime(2026, 7, 2, 20, 30)
    rows[BOOK] += [
        booking_row("n-busy", start, 84, loaded=NOON, tag="v2"),  # newer version
        booking_row("n-busy", start, 200, taken=NOON - timedelta(days=1), loaded=NOON),  # older snapshot
    ]
    pl, cands, _ = run(spark, rows)
    f = {r["showtime_id"]: r for r in pl.features.collect()}["n-busy"]
    assert f["current_booked_seats"] == 84 and f["hours_to_show"] == 32.5
    assert cands[("n-busy", "n-quiet")]["forecast_a"] == 200.0  # 84 / 0.42


def test_duplicate_policy_rows_do_not_multiply(spark):
    rows = demo_rows()
    rows[POL] = rows[POL] + rows[POL]
    _, cands, recs = run(spark, rows)
    assert len(cands) == 4 and len(recs) == 3


def test_missing_booking_uses_999_hours_and_low_confidence(spark):
    rows = demo_rows()
    rows[BOOK] = [r for r in rows[BOOK] if r[1] != "n-quiet"]
    pl, cands, recs = run(spark, rows)
    f = {r["showtime_id"]: r for r in pl.features.collect()}["n-quiet"]
    assert (f["current_booked_seats"], f["hours_to_show"], f["forecast_input_quality_status"]) == (0, 999.0, "NO_BOOKING_SNAPSHOT")
    assert f["expected_booking_completion_pct"] == 0.30
    c = cands[("n-busy", "n-quiet")]
    assert c["forecast_b"] == 40.0 and c["forecast_confidence_score"] == 0.5
    assert ("n-busy", "n-quiet") not in recs and len(recs) == 2


def test_null_lock_flag_falls_through(spark):
    rows = demo_rows()
    replace(rows, SCHED, "h-busy", is_locked=None)
    _, cands, recs = run(spark, rows)
    assert reason(cands, "h-busy", "h-quiet") == ""
    assert ("h-busy", "h-quiet") in recs


@pytest.mark.parametrize("side", ["h-busy", "h-quiet"])
def test_locked_show_comes_first(spark, side):
    rows = demo_rows()
    replace(rows, SCHED, side, is_locked=True)
    replace(rows, POL, "harbor", freeze_window_hours=500.0)
    _, cands, recs = run(spark, rows)
    assert reason(cands, "h-busy", "h-quiet") == "LOCKED_SHOWTIME"
    assert ("h-busy", "h-quiet") not in recs


@pytest.mark.parametrize("gap,paired", [(900, True), (901, False)])
def test_band_edge_in_whole_seconds(spark, gap, paired):
    rows = demo_rows()
    start = datetime(2026, 7, 2, 20, 30) + timedelta(seconds=gap)
    replace(rows, SCHED, "n-quiet", show_start_ts=start, show_end_ts=start + timedelta(minutes=135))
    _, cands, _ = run(spark, rows)
    assert (("n-busy", "n-quiet") in cands) is paired


def test_empty_candidates_fail_audit_with_null_detail(spark):
    rows = demo_rows()
    rows[SCHED] = [r[:6] + ("DRAFT",) + r[7:] for r in rows[SCHED]]
    pl, cands, recs = run(spark, rows)
    assert not cands and not recs
    audit = {r["check_name"]: (r["status"], r["detail"]) for r in quality.audit(pl.recommendations, pl.candidates).collect()}
    assert audit["gold_recommendations_min_count"] == ("FAIL", "recommendation_count=0")
    assert audit["gold_candidates_invalid_present"] == ("FAIL", None)
    with pytest.raises(quality.QualityGateError):
        quality.enforce(pl.recommendations, pl.candidates)
