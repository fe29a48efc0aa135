"""The physical plans keep the shapes the scale design relies on."""

import re

import pytest
from demo import demo_feeds

from slotwise.operators import latest_by_key, top_n_per_group
from slotwise.plans.pipeline import Pipeline
from slotwise.plans.recommend import publish_gate
from slotwise.sources.tables import parquet_materializer


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lines(df) -> list[str]:
    """Plan nodes, one per line, without tree drawing or codegen stage ids."""
    return [re.sub(r"^\*\(\d+\) ", "", ln.strip(" :+-")) for ln in plan(df).splitlines()]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _partial_limit_below_exchange(df):
    ls = lines(df)
    ex = next(i for i, ln in enumerate(ls) if ln.startswith("Exchange hashpartitioning"))
    assert any("WindowGroupLimit" in ln and "Partial" in ln for ln in ls[ex:]), plan(df)


def test_latest_by_key_limits_before_the_shuffle(spark, no_broadcast):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS v")
    _partial_limit_below_exchange(latest_by_key(df, ["k"], ["v DESC"]))


def test_top_n_with_cap_limits_before_the_shuffle(spark, no_broadcast):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS v", "2 AS n")
    _partial_limit_below_exchange(top_n_per_group(df, ["k"], ["v DESC"], "n", cap=2))


def test_band_join_shuffles_on_site_and_bucket_and_tests_band_first(spark, no_broadcast):
    pl = Pipeline(demo_feeds(spark), hot_pairs=None)
    p = plan(pl.recommendations)
    assert re.search(r"hashpartitioning\(a_theatre_id#\d+, __band_bucket_l#\d+L?, ", p), p
    assert re.search(r"hashpartitioning\(b_theatre_id#\d+, __band_bucket_r#\d+L?, ", p), p
    smj = next(ln for ln in p.splitlines() if "SortMergeJoin [a_theatre_id" in ln)
    assert smj.index("abs((__band_epoch_l") < smj.index("CASE WHEN"), smj  # cheap band test first


def test_latest_booking_join_needs_no_exchange(spark, no_broadcast):
    pl = Pipeline(demo_feeds(spark), hot_pairs=None)
    ls = lines(pl.features)
    j = next(i for i, ln in enumerate(ls) if ln.startswith("SortMergeJoin [showtime_id") and "LeftOuter" in ln)
    # the outer join's left child is the schedule's de-duplication output, not a new exchange
    below = [ln for ln in ls[j + 1:j + 5] if ln]
    assert below[0].startswith("Project") and any(ln.startswith("Window") for ln in below), "\n".join(ls[j:j + 8])
    assert not any(ln.startswith("Exchange") for ln in below), "\n".join(ls[j:j + 8])


def test_gate_is_pushed_into_the_candidates_scan(spark):
    pl = Pipeline(demo_feeds(spark), materialize=parquet_materializer(spark))
    df = publish_gate(pl.candidates)
    p = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    scan = p[p.index("Scan parquet"):]
    assert "EqualTo(constraint_validation_status,VALID)" in scan[: scan.index("ReadSchema")], p


def test_no_sizing_funnel_in_any_stage(spark):
    """Lookups are plain joins: no limit is counted in one task to size a side."""
    from slotwise.plans.pipeline import Pipeline

    pl = Pipeline.from_driver_tables(spark, "/root/testdata/sf0.001", barriers=False)
    for df in (pl.features, pl.forecast, pl.enriched, pl.candidates):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GlobalLimit" not in plan and "CollectLimit" not in plan


def test_reports_come_in_their_stated_order(spark):
    """leading keys of every report, read from collected rows."""
    import __spark_entry__ as E

    sf, q = "/root/testdata/sf0.001", E.queries()
    rows = [(r["theatre_id"], r["show_start_ts"], r["capacity"], r["showtime_id"]) for r in q["report_schedule"](spark, sf).collect()]
    assert len(rows) > 1 and rows == sorted(rows)
    rows = [(-r["unconstrained_demand_forecast"], r["showtime_id"]) for r in q["report_forecast"](spark, sf).collect()]
    assert len(rows) > 1 and rows == sorted(rows)
    rows = [r["constraint_validation_status"] for r in q["report_candidates"](spark, sf).collect()]
    assert rows == sorted(rows, reverse=True)


def test_clustered_tables_join_without_exchange(spark, tmp_path, no_broadcast):
    from slotwise.plans.forecast import demand_forecast, enrich
    from slotwise.sources.tables import create_namespace, list_tables, save_clustered

    create_namespace(spark, "clustered_t", str(tmp_path / "ns"))
    pl = Pipeline(demo_feeds(spark))
    features = save_clustered(pl.features, "clustered_t.features", ["showtime_id"], 4)
    forecast = save_clustered(demand_forecast(features), "clustered_t.forecast", ["showtime_id"], 4)
    e = enrich(features, pl.silver["fact_schedule_policy"], forecast)
    ls = lines(e)
    assert any(ln.startswith("SortMergeJoin [showtime_id") for ln in ls)
    assert not any(re.match(r"Exchange hashpartitioning\((showtime_id|_fc_sid)#", ln) for ln in ls), "\n".join(ls)
    assert sum("Bucketed: true" in ln for ln in ls) == 2
    assert e.count() == 17
    for _ in range(3):
        save_clustered(pl.forecast, "clustered_t.forecast", ["showtime_id"], 4)
    assert len([t for t in list_tables(spark, "clustered_t") if t.startswith("forecast__")]) == 2
    assert spark.table("clustered_t.forecast").count() == 17
    spark.sql("DROP SCHEMA clustered_t CASCADE")


def test_lists_merged_batch_by_batch(spark):
    from slotwise.plans.recommend import daily_top_n, merged_daily_top_n

    pl = Pipeline.from_driver_tables(spark, "/root/testdata/sf0.01")
    listed = None
    for n in range(4):
        listed = merged_daily_top_n(listed, pl.candidates.where(f"pmod(hash(candidate_id), 4) = {n}"), pl.cap)
    want = daily_top_n(publish_gate(pl.candidates), pl.cap).select("candidate_id").collect()
    assert sorted(listed.select("candidate_id").collect()) == sorted(want) and want
