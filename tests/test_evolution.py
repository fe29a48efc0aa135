"""Feeds with several headers, tables that grow by batches, and incremental current state."""

from __future__ import annotations

from datetime import timedelta

import pytest
from demo import NOON, booking_row, demo_feeds, demo_rows, show_row

from slotwise.plans.silver import booking_snapshots, current_schedule
from slotwise.schemas import BOOKING, SCHEDULE, SCREEN
from slotwise.sources import csv_feeds, files
from slotwise.sources.append_log import AppendTable
from slotwise.sources.csv_feeds import schema_of, write_feed
from slotwise.sources.schema_log import SchemaLog, read_feed_versions
from slotwise.streaming.bronze import BronzeLayout, ingest_all
from slotwise.streaming.current import booking_state, schedule_state
from slotwise.streaming.evolving import ingest_evolving

PLAIN = "screen_id,theatre_id,screen_name,capacity,screen_format,is_active,source_updated_ts\na,t,One,80,STANDARD,true,2026-07-01T08:00:00\n"
WIDER = "theatre_id,screen_id,seat_map,capacity,screen_name\nt,b,\"rows,12\",90,Two\nt,c,,many,Three\n"
FEWER = "screen_id,capacity\r\nd,70\r\n"


@pytest.fixture
def landing(tmp_path):
    for day, name, text in (("2026-07-01", "x", PLAIN), ("2026-07-02", "x", WIDER), ("2026-07-02", "y", FEWER), ("2026-07-02", "z", "")):
        folder = tmp_path / "landing" / SCREEN.name / f"snapshot_date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.csv").write_bytes(text.encode())
    return tmp_path


def rows_of(df):
    return {r["screen_id"]: (r["theatre_id"], r["screen_name"], r["capacity"], str(r["snapshot_date"]), r["_rescued_data"]) for r in df.collect()}


RESCUED = {
    "a": ("t", "One", 80, "2026-07-01", None), "b": ("t", "Two", 90, "2026-07-02", '{"seat_map":"rows,12"}'),
    "c": ("t", "Three", None, "2026-07-02", '{"capacity":"many"}'), "d": (None, None, 70, "2026-07-02", None),
}


def test_headers_load_whole_in_batch(spark, landing):
    schema = schema_of(demo_feeds(spark)["screen_master"])
    where = (str(landing / "landing"), SCREEN, schema, str(landing / "log"))
    got = read_feed_versions(spark, *where, "b1")
    assert rows_of(got) == RESCUED
    wide = read_feed_versions(spark, *where, "b2", evolve="add")
    assert {r["screen_id"]: r["seat_map"] for r in wide.collect()} == {"a": None, "b": "rows,12", "c": None, "d": None}
    versions = SchemaLog(spark, str(landing / "log"), SCREEN).versions()
    assert [v["since"] for v in versions] == ["b1"] * 3 and ["screen_id", "capacity"] in [v["columns"] for v in versions]
    assert rows_of(read_feed_versions(spark, *where, "b3", loads=["2026-07-01"])) == {"a": RESCUED["a"]}
    with pytest.raises(ValueError, match="evolve"):
        read_feed_versions(spark, *where, "b4", evolve="drop")


def test_headers_load_whole_in_streams(spark, landing):
    schema = schema_of(demo_feeds(spark)["screen_master"])
    layout = BronzeLayout(str(landing / "landing"), str(landing / "bronze"))
    table = ingest_evolving(spark, layout, {SCREEN: schema}, "b1", max_files_per_trigger=2)[SCREEN.name]
    assert rows_of(table.read()) == RESCUED and len(table.folders()) >= 2
    assert {r["_source_snapshot_date"] for r in table.read().collect()} == {"2026-07-01", "2026-07-02"}
    day = landing / "landing" / SCREEN.name / "snapshot_date=2026-07-03"
    day.mkdir()
    (day / "x.csv").write_text(WIDER.replace(",b,", ",e,").replace(",c,", ",f,"))
    ingest_evolving(spark, layout, {SCREEN: schema}, "b2", evolve="add")
    ingest_evolving(spark, layout, {SCREEN: schema}, "b3", evolve="add")  # nothing new
    got = {r["screen_id"]: (r["seat_map"], r["_batch_id"]) for r in table.read().collect()}
    assert got["e"] == ("rows,12", "b2") and got["a"] == (None, "b1") and len(got) == 6


def test_batches_are_appended_once_and_compacted(spark, tmp_path):
    t = AppendTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        t.read()
    for n in range(6):
        assert t.append(spark.range(n, n + 1).toDF("v"), f"batch-{n}")
    assert not t.append(spark.range(99).toDF("v"), "batch-3")  # a re-run batch
    values = lambda: sorted(r["v"] for r in t.read().collect())
    old = t.read()
    assert values() == list(range(6)) and t.compact(partitions=1) and len(t.folders()) == 1
    assert not t.append(spark.range(99).toDF("v"), "batch-3") and t.append(spark.range(50, 51).toDF("v"), "batch-6")
    assert values() == [*range(6), 50] and old.count() == 6
    assert len(t.vacuum()) == 6 and values() == [*range(6), 50]
    assert sum(n.endswith(".parquet") for f in t.folders() for n in files.names(spark, f)) <= 3


@pytest.mark.parametrize("feed,state,batch", [(SCHEDULE, schedule_state, current_schedule), (BOOKING, booking_state, booking_snapshots)])
def test_two_loads_give_the_batch_result(spark, tmp_path, feed, state, batch):
    rows = demo_rows()
    later = NOON + timedelta(hours=2)
    start = NOON + timedelta(days=3)
    second = {
        SCHEDULE.name: [show_row("n-busy", "north", "h2", "amber", start, loaded=later, minutes=0),  # newest ends when it starts
                        show_row("s-busy", "south", "h2", "basalt", start, loaded=later), show_row("new", "south", "h1", "dune", start, loaded=later),
                        show_row("n-quiet", "north", "h1", "dune", start, loaded=NOON - timedelta(days=9))],  # older than what is there
        BOOKING.name: [booking_row("n-busy", start, -5, loaded=later, tag="x"), booking_row("s-busy", start, 31, loaded=later), booking_row("s-busy", start, 32, taken=later)],
    }[feed.name]
    frames = [spark.createDataFrame(r, feed.schema()) for r in (rows[feed.name], second)]
    layout = BronzeLayout(str(tmp_path / "landing"), str(tmp_path / "bronze"))
    now = state(spark, str(tmp_path / "state"))
    read = []
    for day, frame in zip(("2026-07-01", "2026-07-02"), frames, strict=True):
        write_feed(frame, layout.landing, feed, day)
        path = ingest_all(spark, layout, {feed: schema_of(frame)}, day)[feed.name]
        read.append(now.update(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)))
    assert read == [len(rows[feed.name]), len(second)]  # the second load reads its own rows only
    want = sorted(map(str, batch(frames[0].unionByName(frames[1])).collect()))
    assert sorted(map(str, now.read().collect())) == want
    assert now.compact() and not now.compact()
    assert sorted(map(str, now.read().collect())) == want


def test_one_batch_of_changes_is_read_and_compacted_without_another_shuffle(spark, tmp_path):
    now = booking_state(spark, str(tmp_path / "state"))
    start = NOON + timedelta(days=3)
    old, new = (spark.createDataFrame([booking_row("n-busy", start, seats, loaded=at), booking_row("s-busy", start, 3, loaded=NOON)], BOOKING.schema())
                for seats, at in ((7, NOON), (9, NOON + timedelta(hours=2))))
    plan = lambda: now.read()._jdf.queryExecution().executedPlan().toString()
    seats = lambda: sorted((r["showtime_id"], r["booked_seats"]) for r in now.read().collect())
    now.changes.append(old, "batch-0")
    assert "Exchange" not in plan() and seats() == [("n-busy", 7), ("s-busy", 3)]
    now.changes.append(new, "batch-1")
    assert "Exchange" in plan() and seats() == [("n-busy", 9), ("s-busy", 3)]
    ranked = now._newest
    now._newest = lambda df: _Unhinted(ranked(df))
    assert now.compact()
    now._newest = ranked
    assert "Exchange" not in plan() and seats() == [("n-busy", 9), ("s-busy", 3)]


class _Unhinted:
    """A table that may be written but not dealt anew."""

    def __init__(self, df):
        self.write = df.write


def test_a_packed_load_is_read_back_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_feeds, "PACKED_ROWS", 10)
    rows = spark.createDataFrame([booking_row(f"s{n}", NOON + timedelta(days=3), n, loaded=NOON) for n in range(35)], BOOKING.schema()).coalesce(1)
    layout = BronzeLayout(str(tmp_path / "landing"), str(tmp_path / "bronze"))
    write_feed(rows, layout.landing, BOOKING, "2026-07-01", compression="gzip")
    landed = list((tmp_path / "landing").rglob("*.csv*"))
    assert len([p for p in landed if p.name.endswith(".csv.gz")]) == 4
    path = ingest_all(spark, layout, {BOOKING: schema_of(rows)}, "2026-07-01")[BOOKING.name]
    got = spark.read.parquet(path)
    assert got.where("_rescued_data IS NULL").count() == 35
    assert sorted(map(str, got.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))


def test_loads_leave_no_keys_in_a_state_store(spark, tmp_path):
    """The changes are the state: its keys are not held in memory from load to load, and an older version that comes late changes nothing."""
    now = schedule_state(spark, str(tmp_path / "state"))
    start = NOON + timedelta(days=3)
    for n, (screen, loaded) in enumerate((("h1", NOON), ("h2", NOON + timedelta(hours=2)), ("h3", NOON - timedelta(days=9)))):
        load = spark.createDataFrame([show_row("n-busy", "north", screen, "amber", start, loaded=loaded)], SCHEDULE.schema())
        load.write.mode("append").parquet(str(tmp_path / "bronze"))
        assert now.update(spark.readStream.schema(load.schema).parquet(str(tmp_path / "bronze"))) == 1
        assert len(now.changes.folders()) == n + 1
    assert not files.exists(spark, f"{now.checkpoint}/state")
    assert [r["screen_id"] for r in now.read().collect()] == ["north/h2"]
    assert now.compact() and [r["screen_id"] for r in now.read().collect()] == ["north/h2"]
