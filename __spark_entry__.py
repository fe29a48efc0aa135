"""

Every query reads the driver tables under ``sf_dir`` (through the domain
adapter) and runs over whole tables. Sites are nations unless the name says
``_region``.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_sql as O  # noqa: E402
from slotwise.functions.exprs import capped_revenue_sql, format_compatible_sql, pair_revenue_sql  # noqa: E402
from slotwise.params import Params  # noqa: E402
from slotwise.plans import quality, reports  # noqa: E402
from slotwise.plans.features import latest_booking  # noqa: E402
from slotwise.plans.forecast import demand_forecast, enrich, forecast_columns  # noqa: E402
from slotwise.plans.pairing import band_pairs, candidates  # noqa: E402
from slotwise.operators.band import band_join  # noqa: E402
from slotwise.plans.pipeline import BARRIERS, DEFAULT_HOT_PAIRS, SINGLE_CONSUMER, Pipeline  # noqa: E402
from slotwise.plans.rank_join import rank_join  # noqa: E402
from slotwise.plans.recommend import GATED_BY, daily_top_n, daily_top_n_of_batches, merged_daily_top_n  # noqa: E402
from slotwise.plans.stages import StageStore  # noqa: E402
from slotwise.plans.silver import conform_screen, conform_theatre  # noqa: E402
from slotwise.schemas import BOOKING, FEEDS, SCHEDULE, SCREEN  # noqa: E402
from slotwise.session import run_dir  # noqa: E402
from slotwise.sources import adapters  # noqa: E402
from slotwise.sources.csv_feeds import (  # noqa: E402
    read_feed, read_feed_rescued, schema_of, with_ingest_metadata, write_feed,
)
from slotwise.sources.tables import create_namespace, list_tables, parquet_materializer, save_clustered  # noqa: E402
from slotwise.streaming.bronze import BronzeLayout, ingest_all  # noqa: E402
from slotwise.streaming.current import booking_state, schedule_state  # noqa: E402
from slotwise.streaming.evolving import ingest_evolving  # noqa: E402

P = Params()
SMOKE_DIR = "/root/testdata/sf0.001"


def _pipe(spark: SparkSession, sf_dir: str, site: str = "nation", shared: bool = False, **kw) -> Pipeline:
    """Stages for one query. Candidates are written to the shared folder only
    when the query reads them more than once (``shared``)."""
    kw.setdefault("barriers", BARRIERS if shared else SINGLE_CONSUMER)
    return Pipeline.from_driver_tables(spark, sf_dir, site, P, **kw)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: ranked, capped swap recommendations; regions as sites on sf0.001."""
    return q_recommendations_region(spark, SMOKE_DIR)


# ---------------------------------------------------------------- gold


def q_recommendations(spark, sf_dir):
    return _pipe(spark, sf_dir).recommendations.drop("data_freshness_ts", "created_ts")


def q_recommendations_region(spark, sf_dir):
    return _pipe(spark, sf_dir, "region").recommendations.drop("data_freshness_ts", "created_ts")


def q_recommendations_house(spark, sf_dir):
    """Sites of ten screens, as many as the data have: candidates grow with the data and not with its square."""
    return _pipe(spark, sf_dir, "house").recommendations.drop("data_freshness_ts", "created_ts")


def q_candidates_house(spark, sf_dir):
    return _pipe(spark, sf_dir, "house").candidates.drop("candidate_run_ts")


def q_rank_join_recommendations(spark, sf_dir):
    """J13 + E4 as a bounded rank join: the published list without building all candidates."""
    pl = _pipe(spark, sf_dir)
    found = rank_join(pl.pair_inputs, P, pl.cap, StageStore(spark, "rank-join"), pl.hot_pairs)
    return found.recommendations.drop("data_freshness_ts", "created_ts")


def q_candidates(spark, sf_dir):
    return _pipe(spark, sf_dir).candidates.drop("candidate_run_ts")


def q_constraint_reasons(spark, sf_dir):
    c = _pipe(spark, sf_dir).candidates
    return c.groupBy("constraint_validation_status", "constraint_failure_reason").agg(
        F.expr("count(1)").alias("candidate_count"),
        F.expr("CAST(sum(CAST(estimated_ticket_revenue_uplift AS DECIMAL(18,2))) AS DOUBLE)").alias("uplift_total"),
    )


def q_band_pairs(spark, sf_dir):
    pl = _pipe(spark, sf_dir)
    pr = band_pairs(pl.pair_inputs, P, pl.hot_pairs, pl.materialize)
    return pr.selectExpr(
        "a_theatre_id AS theatre_id",
        "a_showtime_id AS showtime_a_id",
        "b_showtime_id AS showtime_b_id",
        "unix_timestamp(b_show_start_ts) - unix_timestamp(a_show_start_ts) AS start_gap_seconds",
    )


def q_band_pairs_events(spark, sf_dir):
    """C5 as a generic operator: ordered pairs of one user's events at most 900 s apart."""
    ev = adapters.read_table(spark, sf_dir, "events")
    a = ev.selectExpr("event_id AS a_event_id", "user_id AS a_user_id", "ts AS a_ts")
    b = ev.selectExpr("event_id AS b_event_id", "user_id AS b_user_id", "ts AS b_ts")
    pr = band_join(a, b, ["a_user_id"], ["b_user_id"], "a_ts", "b_ts", P.band_seconds,
                   condition="a_event_id <> b_event_id", hot_pairs=DEFAULT_HOT_PAIRS,
                   materialize=parquet_materializer(spark))
    return pr.selectExpr("a_user_id AS user_id", "a_event_id AS event_a_id", "b_event_id AS event_b_id",
                         "unix_timestamp(b_ts) - unix_timestamp(a_ts) AS gap_seconds")


def q_publish_gate(spark, sf_dir):
    g = _pipe(spark, sf_dir).publishable
    return g.select("candidate_id", "theatre_id", "showtime_a_id", "showtime_b_id",
                    "estimated_ticket_revenue_uplift", "forecast_confidence_score")


def q_daily_top_n(spark, sf_dir):
    pl = _pipe(spark, sf_dir)
    top = daily_top_n(pl.publishable, pl.cap, rank_col="daily_rank")
    return top.select("theatre_id", "show_date", "daily_rank", "showtime_a_id", "showtime_b_id",
                      "estimated_ticket_revenue_uplift")


def q_merged_daily_top_n(spark, sf_dir):
    """E4 kept batch by batch: candidates come in three batches, each merged into the list before.

    One pass over all candidates leaves what each batch may list; that is written and merged, not the candidates."""
    pl = _pipe(spark, sf_dir)
    listed = None
    store = StageStore(spark, "merged-list")
    gated = pl.publishable.select("candidate_id", "theatre_id", "show_start_ts", "showtime_a_id", "showtime_b_id", "estimated_ticket_revenue_uplift",
                                  "maximum_recommendations_per_day", *GATED_BY)
    batches = store.stage(daily_top_n_of_batches(gated, "pmod(xxhash64(candidate_id), 3)", pl.cap), "batches")
    for n in range(3):
        batch = batches.where(f"__batch = {n}").drop("__batch")
        listed = store.stage(merged_daily_top_n(listed, batch, pl.cap), f"list_{n}")
    top = daily_top_n(listed, pl.cap, rank_col="daily_rank")
    return top.select("theatre_id", "show_date", "daily_rank", "showtime_a_id", "showtime_b_id", "estimated_ticket_revenue_uplift")


def q_clustered_forecast(spark, sf_dir):
    """A10 clustered, C3 + C4: features and forecast stored in buckets by showtime, joined where they lie."""
    pl = _pipe(spark, sf_dir, barriers=False)
    root = run_dir(spark, "clustered")
    ns = f"gold_{root.rsplit('-', 1)[-1]}"
    create_namespace(spark, ns, f"{root}/{ns}")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    features = save_clustered(pl.features, f"{ns}.features", ["showtime_id"], n)
    forecast = save_clustered(demand_forecast(features, P), f"{ns}.forecast", ["showtime_id"], n)
    e = enrich(features, pl.silver["fact_schedule_policy"], forecast, P)
    return e.select("showtime_id", "theatre_id", "unconstrained_demand_forecast", "forecast_confidence_score", "screen_capacity",
                    "minimum_revenue_uplift", "maximum_recommendations_per_day")


def q_demand_features(spark, sf_dir):
    return _pipe(spark, sf_dir).features.drop("feature_run_ts")


def q_demand_forecast(spark, sf_dir):
    return _pipe(spark, sf_dir).forecast.drop("forecast_run_ts")


def q_completion_curve(spark, sf_dir):
    return _pipe(spark, sf_dir).features.select("showtime_id", "hours_to_show", "expected_booking_completion_pct")


def q_confidence(spark, sf_dir):
    f = _pipe(spark, sf_dir).features
    return f.selectExpr("showtime_id", "forecast_input_quality_status", "hours_to_show", forecast_columns(P)[1])


def q_forecast_drivers(spark, sf_dir):
    return _pipe(spark, sf_dir).forecast.select("showtime_id", "top_forecast_drivers")


def q_showtime_revenue(spark, sf_dir):
    e = _pipe(spark, sf_dir).features.selectExpr("*", *forecast_columns(P))
    rev = capped_revenue_sql("unconstrained_demand_forecast", "screen_capacity", "average_ticket_price")
    return e.selectExpr("showtime_id", "theatre_id", f"CAST(round({rev}, 2) AS DOUBLE) AS capped_ticket_revenue")


def q_capped_and_pair_revenue(spark, sf_dir):
    """J6, J7 on every band pair: each show's capped revenue now and after the swap, and the pair totals."""
    pl = _pipe(spark, sf_dir)
    pr = band_pairs(pl.pair_inputs, P, pl.hot_pairs, pl.materialize)
    fa, fb = "a_unconstrained_demand_forecast", "b_unconstrained_demand_forecast"
    ca, cb = "a_screen_capacity", "b_screen_capacity"
    pa, pb = "a_average_ticket_price", "b_average_ticket_price"

    def cents(x):
        return f"CAST(round({x}, 2) AS DOUBLE)"

    return pr.selectExpr(
        "a_showtime_id AS showtime_a_id",
        "b_showtime_id AS showtime_b_id",
        f"{cents(capped_revenue_sql(fa, ca, pa))} AS revenue_a_now",
        f"{cents(capped_revenue_sql(fb, cb, pb))} AS revenue_b_now",
        f"{cents(capped_revenue_sql(fa, cb, pa))} AS revenue_a_swapped",
        f"{cents(capped_revenue_sql(fb, ca, pb))} AS revenue_b_swapped",
        f"{pair_revenue_sql(fa, ca, pa, fb, cb, pb)} AS pair_revenue_now",
        f"{pair_revenue_sql(fa, cb, pa, fb, ca, pb)} AS pair_revenue_swapped",
    )


def q_swap_uplift(spark, sf_dir):
    c = _pipe(spark, sf_dir).candidates
    return c.select("candidate_id", "current_expected_ticket_revenue", "proposed_expected_ticket_revenue",
                    "estimated_ticket_revenue_uplift")


def q_format_compat(spark, sf_dir):
    f = _pipe(spark, sf_dir).features
    return f.selectExpr("showtime_id", "movie_format", "screen_format",
                        f"{format_compatible_sql('movie_format', 'screen_format', P)} AS format_compatible")


def q_role_lookup(spark, sf_dir):
    pl = _pipe(spark, sf_dir)
    mv = pl.silver["dim_movie"].selectExpr("movie_id AS _mid", "movie_title")
    sc = pl.silver["dim_screen"].selectExpr("screen_id AS _sid", "screen_name")
    # Pairs grow with the square of a site's shows: each show's film and screen are looked up by id
    # before it takes its roles in pairs, not once per pair and role.
    shows = pl.pair_inputs.drop("movie_title", "screen_name")
    looked_up = shows.join(mv, F.expr("movie_id = _mid")).join(sc, F.expr("screen_id = _sid")).drop("_mid", "_sid")
    c = candidates(pl.materialize(looked_up, "looked_up"), P, pl.hot_pairs, pl.materialize)
    return c.select("candidate_id", "movie_a_title", "movie_b_title", "current_screen_a", "current_screen_b",
                    "recommended_screen_a", "recommended_screen_b")


# ---------------------------------------------------------------- silver


def q_current_schedule(spark, sf_dir):
    return _pipe(spark, sf_dir).silver["fact_showtime_schedule_current"]


def q_booking_snapshots(spark, sf_dir):
    return _pipe(spark, sf_dir).silver["fact_booking_snapshot"]


def q_latest_booking(spark, sf_dir):
    return latest_booking(_pipe(spark, sf_dir).silver["fact_booking_snapshot"])


def q_conform_theatre(spark, sf_dir):
    return _pipe(spark, sf_dir).silver["dim_theatre"]


def q_conform_screen(spark, sf_dir):
    return _pipe(spark, sf_dir).silver["dim_screen"]


def q_conform_movie(spark, sf_dir):
    return _pipe(spark, sf_dir).silver["dim_movie"]


def q_conform_availability(spark, sf_dir):
    return _pipe(spark, sf_dir).silver["fact_screen_availability"]


def q_conform_policy(spark, sf_dir):
    return _pipe(spark, sf_dir).silver["fact_schedule_policy"]


def q_distinct_rows(spark, sf_dir):
    """A screen feed ingested twice (bronze appends) conforms to one copy."""
    feed = adapters.screens(spark, sf_dir, "nation", P)
    return conform_screen(feed.unionByName(feed), dedup="distinct")


# ---------------------------------------------------------------- sources, sinks, streams

NEXT_DAY = "2026-07-02"
DROP_VOLATILE = ("_ingest_ts", "_source_file")
PACKED = "snappy"


def q_csv_roundtrip(spark, sf_dir):
    """Write the screen feed as partitioned CSV, read it back typed."""
    feed = adapters.screens(spark, sf_dir, "nation", P)
    root = run_dir(spark, "csv-roundtrip")
    write_feed(feed, root, SCREEN, P.run_date)
    return read_feed(spark, root, SCREEN, schema_of(feed))


def q_partitioned_csv_scan(spark, sf_dir):
    """Bookings landed in monthly load directories; partition
    discovery types ``load_date``; the snapshot date is also taken from the path."""
    feed = adapters.bookings(spark, sf_dir, P)
    root = run_dir(spark, "csv-monthly")
    write_feed(feed, root, BOOKING, F.trunc(F.col("snapshot_ts"), "month"))
    back = with_ingest_metadata(read_feed(spark, root, BOOKING, schema_of(feed)), P.run_date)
    return back.select("snapshot_id", "showtime_id", "snapshot_ts", "booked_seats", "load_date", "_source_snapshot_date")


def q_rescued_rows(spark, sf_dir):
    """A5: unparseable values become NULL and are kept as JSON text."""
    export = adapters.booking_export(spark, sf_dir, P)
    root = run_dir(spark, "csv-rescue")
    write_feed(export, root, BOOKING, P.run_date)
    typed = schema_of(adapters.bookings(spark, sf_dir, P))
    back = read_feed_rescued(spark, root, BOOKING, typed)
    return back.select("snapshot_id", "showtime_id", "booked_seats", "hours_to_show", "_rescued_data")


def q_stream_ingest(spark, sf_dir):
    """Schedule feed landed as CSV, streamed into a bronze table."""
    feed = adapters.showtimes(spark, sf_dir, "nation", P)
    layout = BronzeLayout(run_dir(spark, "landing"), run_dir(spark, "bronze"))
    write_feed(feed, layout.landing, SCHEDULE, P.run_date)
    tables = ingest_all(spark, layout, {SCHEDULE: schema_of(feed)}, P.run_date)
    return spark.read.parquet(tables[SCHEDULE.name]).drop(*DROP_VOLATILE)


def q_stream_reingest_idempotent(spark, sf_dir):
    """A re-run picks up only new files; a full refresh rebuilds from all loads."""
    feed = adapters.screens(spark, sf_dir, "nation", P)
    layout = BronzeLayout(run_dir(spark, "landing"), run_dir(spark, "bronze"))
    schemas = {SCREEN: schema_of(feed)}
    write_feed(feed, layout.landing, SCREEN, P.run_date)
    ingest_all(spark, layout, schemas, P.run_date)
    write_feed(feed, layout.landing, SCREEN, NEXT_DAY)
    ingest_all(spark, layout, schemas, NEXT_DAY)
    ingest_all(spark, layout, schemas, NEXT_DAY)  # nothing new: no rows added
    fresh = layout.refreshed()
    tables = ingest_all(spark, fresh, schemas, NEXT_DAY)
    return spark.read.parquet(tables[SCREEN.name]).select(
        "screen_id", "capacity", "snapshot_date", "_source_snapshot_date", "_batch_id"
    )


def q_evolving_feed(spark, sf_dir):
    """A2, A5, §2.8 schema tracking: the booking feed's header changes between two loads (columns moved, one dropped,
    one new); a stream loads both whole and the new column is added."""
    feed = adapters.bookings(spark, sf_dir, P)
    layout = BronzeLayout(run_dir(spark, "landing"), run_dir(spark, "bronze"))
    write_feed(feed.where("showtime_id % 2 = 0"), layout.landing, BOOKING, P.run_date)
    changed = feed.where("showtime_id % 2 <> 0").select(
        F.expr("concat('web-', showtime_id % 3)").alias("sales_channel"), *[c for c in reversed(feed.columns) if c != "gross_booking_revenue"])
    write_feed(changed, layout.landing, BOOKING, NEXT_DAY)
    table = ingest_evolving(spark, layout, {BOOKING: schema_of(feed)}, P.run_date, evolve="add")[BOOKING.name]
    return table.read().select("snapshot_id", "showtime_id", "snapshot_ts", "booked_seats", "gross_booking_revenue", "hours_to_show",
                               "sales_channel", "_source_snapshot_date", "_rescued_data")


def _incremental(spark, feed, loads, state):
    """Load after load, landed as packed CSV, through bronze into current state."""
    layout = BronzeLayout(run_dir(spark, "landing"), run_dir(spark, "bronze"))
    for day, load in zip((P.run_date, NEXT_DAY), loads, strict=True):
        write_feed(load, layout.landing, feed, day, compression=PACKED)
        path = ingest_all(spark, layout, {feed: schema_of(load)}, day)[feed.name]
        state.update(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path))
    return state


def q_incremental_schedule(spark, sf_dir):
    """E1 kept up by streams: an earlier version of most showtimes, then the feed's own rows for every other one."""
    feed = adapters.showtimes(spark, sf_dir, "nation", P)
    earlier = feed.where("showtime_id % 10 < 6").withColumns({
        "is_locked": F.expr("NOT is_locked"), "source_updated_ts": F.expr("source_updated_ts - INTERVAL 1 DAY")})
    loads = [earlier, feed.where("showtime_id % 2 = 0")]
    return _incremental(spark, SCHEDULE, loads, schedule_state(spark, run_dir(spark, "state"))).read()


def q_incremental_bookings(spark, sf_dir):
    """E2 kept up by streams: corrections of a later load win, a negative one removes its snapshot; read after compaction."""
    feed = adapters.bookings(spark, sf_dir, P)
    corrected = feed.where("showtime_id % 10 <= 2").withColumns({
        "booked_seats": F.expr("CASE WHEN showtime_id % 10 = 2 THEN -1 ELSE booked_seats + 5 END"),
        "source_updated_ts": F.expr("source_updated_ts + INTERVAL 1 DAY")})
    state = _incremental(spark, BOOKING, [feed, corrected], booking_state(spark, run_dir(spark, "state")))
    state.compact()
    return state.read()


def q_site_rows(spark, sf_dir):
    """Rows that the caller holds (one per region) become a typed feed, then a dimension."""
    held = [tuple(r) for r in adapters.theatres(spark, sf_dir, "region", P).collect()]
    feed = spark.createDataFrame(held, adapters.theatres(spark, sf_dir, "region", P).schema)
    return conform_theatre(feed)


def q_view_sql(spark, sf_dir):
    """SQL over the views of a run's tables."""
    pl = _pipe(spark, sf_dir, barriers=False)
    pl.register_views("slotwise_")
    return spark.sql("""
        SELECT f.theatre_id, t.theatre_name, count(*) AS shows, sum(f.current_booked_seats) AS booked_seats
        FROM slotwise_gold_showtime_demand_features f JOIN slotwise_dim_theatre t ON f.theatre_id = t.theatre_id
        GROUP BY f.theatre_id, t.theatre_name""")


def q_medallion_recommendations(spark, sf_dir):
    """The whole flow: all seven feeds landed as CSV, streamed into bronze tables
    (with rescue and ingest metadata), conformed and paired from bronze."""
    feeds = adapters.domain_feeds(spark, sf_dir, "nation", P)
    layout = BronzeLayout(run_dir(spark, "landing"), run_dir(spark, "bronze"))
    schemas = {}
    for name, feed in FEEDS.items():
        df = feeds[name]
        # Landed whole, feeds are the largest files of the flow: packed, by a codec that costs no more time than plain text.
        write_feed(df, layout.landing, feed, P.run_date, compression=PACKED)
        schemas[feed] = schema_of(df)
    tables = ingest_all(spark, layout, schemas, P.run_date)
    bronze = {name: spark.read.parquet(path) for name, path in tables.items()}
    pl = Pipeline(bronze, P, materialize=parquet_materializer(spark), barriers=SINGLE_CONSUMER)
    return pl.recommendations.drop("data_freshness_ts", "created_ts")


def q_table_layers(spark, sf_dir):
    """Every silver, gold and ops table published in its
    namespace, listed from the catalog and counted."""
    pl = _pipe(spark, sf_dir, barriers=False)
    root = run_dir(spark, "tables")
    tag = root.rsplit("-", 1)[-1]
    ns = {layer: f"{layer}_{tag}" for layer in ("silver", "gold", "ops")}
    pl.publish(spark, root, ns, gate=False)
    tables = {t: spark.table(f"{n}.{t}") for n in ns.values() for t in list_tables(spark, n)}
    return reports.stage_counts(tables).withColumnRenamed("stage", "table_name")


# ---------------------------------------------------------------- quality and reports


def _observed(spark, sf_dir):
    """The facts of the checks, observed while the stages of a run are written (of candidates: their counts); the stages go at once."""
    pl = _pipe(spark, sf_dir, barriers=False)
    with StageStore(spark) as store:
        return pl.staged(store)


def q_dq_audit(spark, sf_dir):
    return quality.audit_of(_observed(spark, sf_dir), P, with_run_ts=False)


def q_dq_checks(spark, sf_dir):
    return quality.counts_of(_observed(spark, sf_dir))


def q_dq_gate(spark, sf_dir):
    """K2 + K3: the hard gate's counts, verdict and first failure message
    (``quality.enforce`` raises on the same verdict)."""
    return quality.gate_of(_observed(spark, sf_dir), P)


def q_stage_counts(spark, sf_dir):
    """Rows of every stage; those after bronze are counted by the jobs that write them, candidates by the one that judges them."""
    pl = _pipe(spark, sf_dir, barriers=False)
    with StageStore(spark) as store:
        pl.staged(store)
        rows = {name: store.metrics(name)["rows"] for name in pl.silver}
        features = store.metrics("features")["rows"]
        rows |= {"gold_showtime_demand_features": features, "gold_showtime_demand_forecast": features}
        rows |= {f"gold_screen_allocation_{name}": store.metrics(name)["rows"] for name in ("candidates", "recommendations")}
    feeds = reports.stage_counts({f"bronze_{k}": v for k, v in pl.feeds.items()})
    return feeds.unionByName(reports.known_counts(spark, rows))


def q_report_schedule(spark, sf_dir):
    s = _pipe(spark, sf_dir).silver
    return reports.report_schedule(s["fact_showtime_schedule_current"], s["dim_movie"], s["dim_screen"])


def q_report_forecast(spark, sf_dir):
    pl = _pipe(spark, sf_dir)
    return reports.report_forecast(pl.features, P)


def q_report_candidates(spark, sf_dir):
    return reports.report_candidates(_pipe(spark, sf_dir).candidates)


def q_report_recommendations(spark, sf_dir):
    return reports.report_recommendations(_pipe(spark, sf_dir).recommendations)


def q_report_reasons(spark, sf_dir):
    return reports.report_reasons(_pipe(spark, sf_dir).recommendations)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def _llm_module(name: str):
    """A module of the llm subpackage or its pipeline, or None where they are absent."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        if e.name and (e.name.startswith("slotwise.llm") or e.name == "corpus_pipeline"):
            return None
        raise


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES)
    if llm := _llm_module("slotwise.llm.queries"):
        out |= llm.queries()
    if pipeline := _llm_module("corpus_pipeline"):
        out["pipeline"] = pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    """Equivalent DuckDB SQL per query over the driver tables."""
    out = O.oracle_queries()
    if llm := _llm_module("slotwise.llm.oracle"):
        out |= llm.oracle_queries()
    pipeline = _llm_module("corpus_pipeline")
    if pipeline and pipeline.ORACLE_SQL:
        out["pipeline"] = pipeline.ORACLE_SQL
    return out
