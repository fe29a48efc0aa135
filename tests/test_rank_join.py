"""The bounded rank join against the list of all candidates."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from slotwise.params import Params
from slotwise.plans.pairing import candidates
from slotwise.plans.rank_join import rank_join
from slotwise.plans.recommend import recommendations
from slotwise.plans.stages import StageStore

COLUMNS = ("showtime_id string, theatre_id string, movie_id string, screen_id string, movie_title string, screen_name string, "
           "unconstrained_demand_forecast double, screen_capacity int, average_ticket_price double, movie_format string, screen_format string, "
           "show_start_ts timestamp, forecast_confidence_score double, is_locked boolean, hours_to_show double, freeze_window_hours double, "
           "minimum_revenue_uplift double, minimum_confidence_score double, maximum_recommendations_per_day int")


def shows(seed: int, n: int, sites: int, prices=(5.0, 9.5, 14.0)):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        site = rnd.randrange(sites)
        start = datetime(2026, 7, 1 + rnd.randrange(2), 19) + timedelta(minutes=5 * rnd.randrange(8))
        out.append((
            f"s{i:04d}", f"site{site}", f"f{i % 7}", f"h{i}", f"Film {i % 7}", f"Hall {i}", round(rnd.paretovariate(1.1) * 30, 2), rnd.choice((40, 60, 90, 150, 300)),
            rnd.choice(prices), rnd.choice(("STANDARD", "STANDARD", "PREMIUM")), rnd.choice(("STANDARD", "PREMIUM")), start,
            rnd.choice((0.5, 0.72, 0.86)), rnd.choice((False, False, False, True, None)), rnd.choice((5.0, 30.0, 80.0)), 6.0, 50.0, 0.6, 1 + site % 3,
        ))
    return out


def both(spark, rows, **kw):
    p = Params()
    with StageStore(spark) as store:
        inputs = store.stage(spark.createDataFrame(rows, COLUMNS), "inputs")
        cap = max((r[-1] for r in rows if r[-1] is not None), default=None)
        every = candidates(inputs, p)
        ids = ["recommendation_id", "theatre_id", "show_date", "estimated_ticket_revenue_uplift"]
        want = sorted(map(str, recommendations(every, p, cap).select(*ids).collect()))
        got = rank_join(inputs, p, cap, store, **kw)
        return sorted(map(str, got.recommendations.select(*ids).collect())), want, got, every.count()


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"first": 1, "growth": 2}), (3, {"first": 1, "hot_pairs": 500})])
def test_same_list_from_fewer_pairs(spark, seed, kw):
    got, want, found, every = both(spark, shows(seed, 700, 3), **kw)
    assert got == want and len(want) > 5
    assert sum(found.pairs_scored) < 0.7 * every
    assert found.open_days[-1] == 0


def test_equal_bounds_are_scored_whole(spark):
    """All shows alike: no bound closes a day early, ties go by the show ids."""
    rows = [(f"s{i:03d}", "x", "f", f"h{i}", "Film", "Hall", 200.0 if i % 2 else 20.0, 60 if i % 2 else 150, 10.0, "STANDARD", "STANDARD",
             datetime(2026, 7, 1, 20), 0.86, False, 30.0, 6.0, 50.0, 0.6, 2) for i in range(60)]
    got, want, found, every = both(spark, rows, first=1, growth=3)
    assert got == want and len(want) == 2 and sum(found.pairs_scored) == every


def test_negative_prices_nulls_and_nothing(spark):
    got, want, _, _ = both(spark, shows(7, 400, 2, prices=(-6.0, 0.0, 8.0, None)), first=1)
    assert got == want and want
    got, want, found, every = both(spark, shows(1, 40, 1)[:1])
    assert got == want == [] and every == 0 and found.pairs_scored == [0]
