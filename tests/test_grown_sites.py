"""Work that must not grow with the square of a site's shows: lists, counts and lookups without rows for all candidates."""

from __future__ import annotations

import pytest

from demo import demo_feeds
from slotwise.functions.exprs import money_diff_sql, pair_cents_sql
from slotwise.params import Params
from slotwise.plans.pairing import _pair_columns, band_pairs, busy_side, candidates, in_cents, judged, quiet_side
from slotwise.plans.pipeline import SINGLE_CONSUMER, Pipeline
from slotwise.plans.rank_join import bounded_busy, publishable
from slotwise.plans.recommend import daily_top_n, daily_top_n_of_batches, merged_daily_top_n, publish_gate
from slotwise.plans.stages import StageStore
from slotwise.sources import files
from slotwise.sources.tables import parquet_materializer
from test_rank_join import COLUMNS, shows

ROWS = ["candidate_id", "theatre_id", "estimated_ticket_revenue_uplift", "minimum_revenue_uplift", "maximum_recommendations_per_day"]


def several_policies(rows):
    """A site with a second policy that asks and allows more, as source rows may repeat."""
    return rows + [(*r[:-3], 400.0, 0.86, 3) for r in rows if r[1] == "site1"]


def test_staged_candidates_are_counted_and_not_written(spark):
    with StageStore(spark) as store:
        pl = Pipeline(demo_feeds(spark))
        pl.staged(store)
        every = pl.candidates.count()
        folder = next(n for n in files.names(spark, store.root) if n.endswith("-candidates"))
        assert store.metrics("candidates")["rows"] == every > 1
        assert spark.read.parquet(f"{store.root}/{folder}").count() == 1
        assert pl.recommendations.count() == store.metrics("recommendations")["rows"] == 3


def test_list_of_one_consumer_builds_no_candidates(spark):
    pl = Pipeline(demo_feeds(spark), materialize=parquet_materializer(spark), barriers=SINGLE_CONSUMER)
    volatile = ("data_freshness_ts", "created_ts")
    got = pl.recommendations.drop(*volatile).collect()
    assert "candidates" not in vars(pl)
    every = Pipeline(demo_feeds(spark)).recommendations.drop(*volatile)
    assert pl.recommendations.drop(*volatile).columns == every.columns
    assert sorted(map(str, got)) == sorted(map(str, every.collect())) and len(got) == 3


@pytest.mark.parametrize("seed,prices", [(1, (5.0, 9.5, 14.0)), (7, (-6.125, 0.0, 8.005, None))])
def test_publishable_is_the_gate_of_all_candidates(spark, seed, prices):
    rows = several_policies(shows(seed, 300, 2, prices))
    with StageStore(spark) as store:
        inputs = store.stage(spark.createDataFrame(rows, COLUMNS), "inputs")
        want = publish_gate(candidates(inputs, Params())).select(ROWS)
        got = publishable(inputs, Params(), 500, store.stage).select(ROWS)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 3


def test_no_swap_exceeds_its_bound_when_prices_round_up(spark):
    rows = shows(4, 300, 1, prices=(9.005, 7.125))
    inputs = spark.createDataFrame(rows, COLUMNS)
    p = Params()
    quiet = quiet_side(inputs).where("b_is_locked IS NOT TRUE")
    bounds = {r["a_showtime_id"]: r["__bound"] for r in bounded_busy(busy_side(inputs), quiet, p).collect()}
    gated = publish_gate(candidates(inputs, p)).collect()
    assert gated and all(r["estimated_ticket_revenue_uplift"] <= bounds[r["showtime_a_id"]] for r in gated)


def test_batches_keep_what_their_merges_list(spark):
    with StageStore(spark) as store:
        inputs = store.stage(spark.createDataFrame(shows(2, 300, 2), COLUMNS), "inputs")
        gated = publish_gate(store.stage(candidates(inputs, Params(), with_run_ts=False), "every"))
        batches = store.stage(daily_top_n_of_batches(gated, "pmod(hash(candidate_id), 3)", 3), "batches")
        listed = None
        for n in range(3):
            listed = merged_daily_top_n(listed, batches.where(f"__batch = {n}").drop("__batch"), 3)
        want = daily_top_n(gated, 3).select("candidate_id").collect()
        assert sorted(listed.select("candidate_id").collect()) == sorted(want) and want
        assert batches.count() < gated.count()


def test_roles_are_looked_up_before_pairing(spark):
    import __spark_entry__ as E

    plan = E.queries()["role_lookup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join " in line for line in plan.splitlines()) == 1, plan


def test_pairs_are_priced_in_cents_as_in_decimal(spark):
    """In cents or, beyond a million or without a price, in DECIMAL: the same revenues to the last bit, half cents and negative amounts too."""
    side = "unconstrained_demand_forecast double, screen_capacity int, average_ticket_price double"
    amounts = [(30.005, 20, 0.5), (1.005, 1, 12.345), (12.34, 10, None), (0.015, 0, -0.5), (-3.335, -4, 7.77), (2.5e6, 50, 19.99),
               (77.7, 2_000_000_000, 1.15), (999999.99, 999999, 999999.99), (1e6, 5, 1e6), (5.0, 3, 1e9), (3.0, 9, 0.125)]
    rows = spark.createDataFrame(amounts, side)
    a, b = (rows.selectExpr(*(f"{c} AS {prefix}{c}" for c in rows.columns)) for prefix in ("a_", "b_"))
    columns = dict(_pair_columns(Params()))
    current, proposed = "current_expected_ticket_revenue", "proposed_expected_ticket_revenue"
    pairs = in_cents(a, "a_").crossJoin(in_cents(b, "b_"))
    got = pairs.selectExpr(
        f"{pair_cents_sql('a_', 'a_', 'b_', 'b_')} AS now", f"{pair_cents_sql('a_', 'b_', 'b_', 'a_')} AS swapped",
        f"{columns[current]} AS {current}", f"{columns[proposed]} AS {proposed}",
    ).selectExpr("*", f"{money_diff_sql(proposed, current)} AS uplift").collect()
    assert len(got) == len(amounts) ** 2
    priced = [r for r in got if r["now"] is not None]
    assert len(priced) == 6 * 6
    for r in priced:
        assert (r["now"] / 100, r["swapped"] / 100, (r["swapped"] - r["now"]) / 100) == (r[current], r[proposed], r["uplift"])
    assert all((r["now"] is None) == (r["swapped"] is None) for r in got)


def test_candidates_come_in_the_sessions_partitions(spark):
    """What a task makes follows from pairs: partitions are not merged by the few bytes of the shows."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        with StageStore(spark) as store:
            inputs = store.stage(spark.createDataFrame(shows(3, 300, 2), COLUMNS), "inputs")
            got = candidates(inputs, Params(), 50_000_000, store.stage, with_run_ts=False)
            assert got.rdd.getNumPartitions() == 13
            plain = judged(band_pairs(inputs), Params(), with_run_ts=False)
            assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and plain.count() > 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
