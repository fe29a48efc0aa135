"""Domain Column functions on literal rows."""

from slotwise.functions import (
    candidate_id, completion_pct, confidence_score, format_compatible, pair_revenue, swap_uplift,
)


def one(spark, col, schema="x int", rows=((1,),)):
    return spark.createDataFrame(list(rows), schema).select(col.alias("v")).collect()


def test_swap_uplift_known_pair(spark):
    r = one(spark, swap_uplift(225.0, 120, 14.0, 70.0, 280, 10.0))
    assert r[0]["v"] == 1470.0


def test_pair_revenue_rounds_half_up_in_decimal(spark):
    # 223.81 * 13.5 + 66.67 * 11 = 3754.805 -> 3754.81
    r = one(spark, pair_revenue(223.81, 280, 13.5, 66.67, 120, 11.0))
    assert r[0]["v"] == 3754.81


def test_format_rule_truth_table(spark):
    rows = [("STANDARD", "PREMIUM"), ("PREMIUM", "PREMIUM"), ("PREMIUM", "STANDARD"), ("STANDARD", "STANDARD"),
            ("IMAX", "IMAX"), ("standard", "PREMIUM"), (None, "PREMIUM")]
    got = [r["v"] for r in one(spark, format_compatible("f", "s"), "f string, s string", rows)]
    assert got == [True, True, False, True, True, False, None]


def test_completion_curve_edges(spark):
    rows = [(24.0,), (24.5,), (72.0,), (72.01,), (999.0,)]
    got = [r["v"] for r in one(spark, completion_pct("x"), "x double", rows)]
    assert got == [0.55, 0.42, 0.42, 0.30, 0.30]


def test_confidence_levels(spark):
    rows = [("OK", 96.0), ("OK", 96.5), ("NO_BOOKING_SNAPSHOT", 999.0)]
    got = [r["v"] for r in one(spark, confidence_score("q = 'OK'", "h"), "q string, h double", rows)]
    assert got == [0.86, 0.72, 0.50]


def test_candidate_id_is_stable_and_ordered(spark):
    rows = [("A", "B"), ("B", "A")]
    got = [r["v"] for r in one(spark, candidate_id("a", "b", "2026-07-01"), "a string, b string", rows)]
    import hashlib
    assert got[0] == hashlib.sha256(b"A|B|2026-07-01").hexdigest()
    assert got[0] != got[1]
