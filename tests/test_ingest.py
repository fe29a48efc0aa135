"""CSV feeds, rescue, and file-stream ingest on literal files."""

import os
import tempfile

from demo import demo_feeds

from slotwise.plans.silver import conform_screen
from slotwise.schemas import SCREEN
from slotwise.sources.csv_feeds import read_feed, read_feed_rescued, schema_of, with_ingest_metadata, write_feed
from slotwise.streaming.bronze import BronzeLayout, ingest_all


def _write_text(root, feed, day, text):
    d = os.path.join(root, feed.name, f"{feed.partition_column}={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.csv"), "w") as fh:
        fh.write(text)


def test_partitioned_roundtrip_keeps_types_and_path_date(spark):
    root = tempfile.mkdtemp(prefix="feeds-")
    screens = demo_feeds(spark)["screen_master"]
    write_feed(screens, root, SCREEN, "2026-07-01")
    back = with_ingest_metadata(read_feed(spark, root, SCREEN, schema_of(screens)), "b1")
    rows = back.collect()
    assert len(rows) == 9
    assert dict(back.dtypes)["capacity"] == "int" and dict(back.dtypes)["snapshot_date"] == "date"
    assert {r["_source_snapshot_date"] for r in rows} == {"2026-07-01"}
    assert all(r["_source_file"].endswith(".csv") and r["_rescued_data"] is None for r in rows)


def test_rescue_keeps_unparseable_values_and_malformed_rows(spark):
    root = tempfile.mkdtemp(prefix="rescue-")
    _write_text(root, SCREEN, "2026-07-01", "\n".join([
        "screen_id,theatre_id,screen_name,capacity,screen_format,is_active,source_updated_ts",
        "S1,T1,One,80,STANDARD,true,2026-07-01T08:00:00",
        "S2,T1,Two,big,STANDARD,true,yesterday",
        "S3,T1,Three",
        "",
    ]))
    schema = schema_of(demo_feeds(spark)["screen_master"])
    rows = {r["screen_id"]: r for r in read_feed_rescued(spark, root, SCREEN, schema).collect()}
    assert rows["S1"]["capacity"] == 80 and rows["S1"]["_rescued_data"] is None
    assert rows["S2"]["capacity"] is None and rows["S2"]["source_updated_ts"] is None
    assert rows["S2"]["_rescued_data"] == '{"capacity":"big","source_updated_ts":"yesterday"}'
    assert '"_corrupt_record":"S3,T1,Three"' in rows["S3"]["_rescued_data"]


def test_stream_ingest_is_incremental_and_refresh_rebuilds(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    layout = BronzeLayout(os.path.join(base, "landing"), os.path.join(base, "bronze"))
    screens = demo_feeds(spark)["screen_master"]
    schemas = {SCREEN: schema_of(screens)}
    write_feed(screens, layout.landing, SCREEN, "2026-07-01")
    t = ingest_all(spark, layout, schemas, "b1")[SCREEN.name]
    assert spark.read.parquet(t).count() == 9
    ingest_all(spark, layout, schemas, "b2")  # no new files
    assert spark.read.parquet(t).count() == 9
    write_feed(screens, layout.landing, SCREEN, "2026-07-02")
    ingest_all(spark, layout, schemas, "b3")
    bronze = spark.read.parquet(t)
    assert bronze.count() == 18
    assert sorted(r[0] for r in bronze.select("_batch_id").distinct().collect()) == ["b1", "b3"]
    assert conform_screen(bronze).count() == 9  # re-ingested versions collapse to the newest
    fresh = ingest_all(spark, layout.refreshed(), schemas, "b4")[SCREEN.name]
    assert fresh != t and spark.read.parquet(fresh).count() == 18


def test_stream_to_catalog_table(spark):
    base = tempfile.mkdtemp(prefix="stream-cat-")
    layout = BronzeLayout(os.path.join(base, "landing"), os.path.join(base, "bronze"))
    screens = demo_feeds(spark)["screen_master"]
    write_feed(screens, layout.landing, SCREEN, "2026-07-01")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS bronze_t LOCATION '{base}/ns'")
    ingest_all(spark, layout, {SCREEN: schema_of(screens)}, "b1", namespace="bronze_t")
    assert spark.table("bronze_t.bronze_screen_master").count() == 9


def test_incremental_read_prunes_load_directories(spark):
    root = tempfile.mkdtemp(prefix="prune-")
    screens = demo_feeds(spark)["screen_master"]
    write_feed(screens, root, SCREEN, "2026-07-01")
    write_feed(screens, root, SCREEN, "2026-07-02")
    df = read_feed(spark, root, SCREEN, schema_of(screens), loads=["2026-07-02"])
    assert df.count() == 9
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(snapshot_date" in scan and "= 2026-07-02)]" in scan


def test_stream_drains_backlog_in_bounded_batches(spark):
    base = tempfile.mkdtemp(prefix="stream-mf-")
    layout = BronzeLayout(os.path.join(base, "landing"), os.path.join(base, "bronze"))
    screens = demo_feeds(spark)["screen_master"]
    for day in ("2026-07-01", "2026-07-02", "2026-07-03"):
        write_feed(screens, layout.landing, SCREEN, day)
    t = ingest_all(spark, layout, {SCREEN: schema_of(screens)}, "b1", max_files_per_trigger=1)[SCREEN.name]
    assert spark.read.parquet(t).count() == 27


def test_columns_are_read_by_header_name(spark, tmp_path):
    from slotwise.schemas import SCREEN
    from slotwise.sources.csv_feeds import read_feed, read_feed_rescued

    folder = tmp_path / SCREEN.name / f"{SCREEN.partition_column}=2026-01-01"
    folder.mkdir(parents=True)
    names = sorted(f.name for f in SCREEN.schema().fields)
    values = {"screen_id": "7", "theatre_id": "3", "capacity": "80", "is_active": "true"}
    (folder / "a.csv").write_text(",".join([*names, "new_col"]) + "\n" + ",".join([values.get(n, "") for n in names] + ["extra"]) + "\n")
    for got in (read_feed(spark, str(tmp_path), SCREEN, SCREEN.schema()), read_feed_rescued(spark, str(tmp_path), SCREEN, SCREEN.schema())):
        row = got.first()
        assert str(row["screen_id"]) == "7" and str(row["theatre_id"]) == "3" and row["capacity"] == 80
    assert row["_rescued_data"] == '{"new_col":"extra"}'
    assert read_feed(spark, str(tmp_path), SCREEN, SCREEN.schema(), loads=[]).count() == 0
    assert read_feed(spark, str(tmp_path), SCREEN, SCREEN.schema(), loads=["2026-01-01"]).count() == 1


def test_refresh_of_a_named_table_shows_every_load(spark, tmp_path):
    from slotwise.schemas import SCREEN
    from slotwise.sources.csv_feeds import write_feed
    from slotwise.sources.tables import create_namespace
    from slotwise.streaming.bronze import BronzeLayout, ingest_all

    landing = str(tmp_path / "landing")
    rows = spark.range(8).selectExpr(*(f"CAST(id AS {f.dataType.simpleString()}) AS {f.name}" if f.dataType.simpleString() not in ("timestamp", "timestamp_ntz", "boolean", "date")
                                       else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in SCREEN.schema().fields))
    create_namespace(spark, "refreshed_bronze", str(tmp_path / "ns"))
    layout = BronzeLayout(landing, str(tmp_path / "bronze"))
    write_feed(rows, landing, SCREEN, "2026-01-01")
    ingest_all(spark, layout, {SCREEN: SCREEN.schema()}, "b1", namespace="refreshed_bronze")
    write_feed(rows, landing, SCREEN, "2026-01-02")
    out = ingest_all(spark, layout.refreshed(), {SCREEN: SCREEN.schema()}, "o'brien", namespace="refreshed_bronze")
    name = f"refreshed_bronze.bronze_{SCREEN.name}"
    assert spark.table(name).count() == 16 == spark.read.parquet(out[SCREEN.name]).count()
    assert {r["_batch_id"] for r in spark.table(name).select("_batch_id").distinct().collect()} == {"o'brien"}
    spark.sql(f"DROP VIEW {name}")
    spark.sql("DROP SCHEMA refreshed_bronze")


def test_json_is_built_for_unclean_rows_only(spark):
    from slotwise.sources.csv_feeds import raw_schema, rescue

    schema = schema_of(demo_feeds(spark)["screen_master"])
    plan = rescue(spark.createDataFrame([], raw_schema([*schema.names, "extra"])), schema)._jdf.queryExecution().analyzed().toString().lower()
    assert "to_json(" in plan and "nullif" not in plan, plan


def test_whole_flow_lands_packed_feeds(spark):
    import glob

    import __spark_entry__ as E
    from slotwise.schemas import FEEDS
    from slotwise.session import shared_dir

    landed = lambda: set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/slotwise/landing-*/*/*/*.csv*"))
    before = landed()
    E.queries()["medallion_recommendations"](spark, "/root/testdata/sf0.001")
    new = landed() - before
    assert len({f.split("/")[-3] for f in new}) == len(FEEDS) and all(f.endswith(".csv.snappy") for f in new)
