"""Atomic publishing, the stage store and checks observed while tables are written."""

from __future__ import annotations

import threading

import pytest
from demo import demo_feeds

from slotwise.plans import quality
from slotwise.plans.pipeline import Pipeline
from slotwise.plans.stages import StageStore
from slotwise.sources import files
from slotwise.sources.tables import create_namespace, list_tables, save_table
from slotwise.sources.versions import CommitConflict, VersionedTable, show_version


def values(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_the_old_version_or_the_new_one(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        t.read()
    t.publish(spark.range(5).toDF("v"))
    old = t.read()
    written = t.write(spark.range(3).toDF("v"))  # a writer killed here leaves the old version
    assert values(t.read()) == [0, 1, 2, 3, 4]
    t.commit(written)
    assert values(t.read()) == [0, 1, 2]
    assert values(old) == [0, 1, 2, 3, 4]  # a scan that began on the old version goes on
    t.publish(t.read().selectExpr("v + 10 AS v"))  # a table may be read by the query that replaces it
    assert values(t.read()) == [10, 11, 12]
    assert len(t.expire(keep=1)) == 2 and len([n for n in files.names(spark, t.root) if n.startswith("v-")]) == 1
    assert values(t.read()) == [10, 11, 12]


def test_two_writers_and_half_written_commits(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.publish(spark.range(1).toDF("v"))
    a, b = t.write(spark.range(2).toDF("v")), t.write(spark.range(4).toDF("v"))
    t.commit(a)
    with pytest.raises(CommitConflict):
        t.commit(b)
    files.create(spark, f"{t.root}/_commits/0000000009", "v-half")  # no line end: not complete
    assert values(t.read()) == [0, 1]


def test_readers_during_replacement_never_meet_a_gap(spark, tmp_path):
    create_namespace(spark, "busy", str(tmp_path / "busy"))
    save_table(spark.range(10).toDF("v"), "busy.t")
    seen, errors, over = set(), [], threading.Event()

    def read():
        other = spark.newSession()
        while not over.is_set():
            try:
                seen.add(other.table("busy.t").count())
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for n in (20, 30, 40):
        save_table(spark.range(n).toDF("v"), "busy.t", keep=10)
    over.set()
    reader.join()
    assert not errors and seen <= {10, 20, 30, 40}
    assert spark.table("busy.t").count() == 40 and list_tables(spark, "busy") == ["t"]
    spark.sql("DROP VIEW busy.t")
    spark.sql("CREATE TABLE busy.held (v INT) USING parquet")
    with pytest.raises(ValueError, match="not a view"):
        show_version(spark, "busy.held", str(tmp_path))
    spark.sql("DROP SCHEMA busy CASCADE")


def test_a_failed_gate_leaves_the_former_run(spark, tmp_path):
    ns = {layer: f"{layer}_gated" for layer in ("silver", "gold", "ops")}
    feeds = demo_feeds(spark)
    Pipeline(feeds).publish(spark, str(tmp_path), ns)
    before = {n: spark.table(f"{ns['gold']}.{n}").count() for n in list_tables(spark, ns["gold"])}
    draft = feeds | {"showtime_schedule": feeds["showtime_schedule"].where("showtime_id LIKE 'n-%'")}
    with pytest.raises(quality.QualityGateError, match="at least 3"):
        Pipeline(draft).publish(spark, str(tmp_path), ns)
    assert {n: spark.table(f"{ns['gold']}.{n}").count() for n in list_tables(spark, ns["gold"])} == before
    again = Pipeline(feeds).publish(spark, str(tmp_path), ns)
    assert again["gold_gated.gold_screen_allocation_recommendations"] == 3
    for layer in ns.values():
        spark.sql(f"DROP SCHEMA {layer} CASCADE")


def test_every_stage_is_written_once_and_gone_at_the_end(spark):
    with StageStore(spark) as store:
        pl = Pipeline(demo_feeds(spark))
        found = pl.staged(store)
        assert len(store.writes) == len(set(store.writes)) == len(pl.silver) + 5  # features, pair inputs, hot ranges, candidates, recommendations
        twice = store.stage(spark.range(7).where("id > 2"), "few")
        assert store.stage(spark.range(7).where("id > 2"), "few") is twice and store.writes.count("few") == 1
        assert store.metrics("few")["rows"] == 4
        store.release("few")
        assert twice.count() == 4
        store.release("few")
        assert not any(n.endswith("few") for n in files.names(spark, store.root))
        assert quality.enforce_facts(found) == {"recommendation_count": 3, "bad_recommendation_count": 0, "invalid_candidate_count": 1}
    assert not files.exists(spark, store.root)
    assert {r["status"] for r in quality.audit_of(found).collect()} == {"PASS"}


def test_observed_facts_equal_a_pass_over_the_tables(spark):
    feeds = demo_feeds(spark)
    with StageStore(spark) as store:
        pl = Pipeline(feeds)
        observed = pl.staged(store)
        assert observed.collect() == quality.facts(pl.recommendations, pl.candidates).collect()
    nothing = feeds | {"showtime_schedule": feeds["showtime_schedule"].limit(0)}
    with StageStore(spark) as store:
        row = Pipeline(nothing).staged(store).first()
    assert row["recommendation_count"] == 0 and row["invalid_candidate_count"] == 0 and row["invalid_candidate_sum"] is None
