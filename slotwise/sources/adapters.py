"""Domain feeds derived from the driver's parquet tables.

Each feed is a lazy projection of one driver table (plus a size-checked
lookup of the site), so its size grows with the data and Catalyst prunes the
scan to the few columns used.

Derivation rules (fixed, mirrored by the oracle SQL):
  site      nation key, region key, or house (ten suppliers: sites that grow with the data)
  screen    supplier: capacity 20 + (suppkey % 8) * 10; PREMIUM when suppkey % 3 = 0
  film      part: PREMIUM when size <= 10; price 5 + size % 10; baseline 2 * size
  showtime  lineitem: id orderkey * 10 + linenumber; start shipdate + 19 h +
            (partkey % 12) * 5 min; end start + 135 min; locked when returnflag R;
            PUBLISHED when linestatus F, else DRAFT; updated at shipdate
  booking   lineitem with discount > 0.01: seats = quantity; hours to show =
            12 * linenumber; snapshot taken that many hours before the start
  policy    per site: freeze (site % 3) * 12 h, min uplift 100, min confidence 0.6,
            at most 2 per day
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.params import Params

SITE_LEVELS = ("nation", "region", "house")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table; files are listed anew, so a table that grew is read whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _updated(p: Params) -> str:
    return f"TIMESTAMP_NTZ'{p.run_date} 08:00:00'"


#: Screens of a site where sites grow with the table.
HOUSE_SCREENS = 10


def site_of_nation(spark: SparkSession, sf_dir: str, site: str) -> DataFrame:
    """(nationkey, site_id): the site each nation belongs to."""
    key = "n_nationkey" if site == "nation" else "n_regionkey"
    return read_table(spark, sf_dir, "nation").selectExpr("n_nationkey AS _nk", f"{key} AS _site")


def supplier_sites(spark: SparkSession, sf_dir: str, site: str, p: Params) -> DataFrame:
    """(s_suppkey, s_name, site): one row per supplier (screen)."""
    sup = read_table(spark, sf_dir, "supplier")
    if site == "nation":
        return sup.selectExpr("s_suppkey", "s_name", "s_nationkey AS _site")
    if site == "house":
        return sup.selectExpr("s_suppkey", "s_name", f"s_suppkey div {HOUSE_SCREENS} AS _site")
    nations = site_of_nation(spark, sf_dir, site)
    return sup.join(nations, F.expr("s_nationkey = _nk")).selectExpr("s_suppkey", "s_name", "_site")


def theatres(spark: SparkSession, sf_dir: str, site: str = "nation", p: Params = Params()) -> DataFrame:
    if site == "nation":
        return read_table(spark, sf_dir, "nation").selectExpr(
            "n_nationkey AS theatre_id", "n_name AS theatre_name", "n_name AS city", "n_name AS state",
            "CAST(n_regionkey AS STRING) AS region", "'UTC' AS timezone", "'ACTIVE' AS theatre_status",
            f"{_updated(p)} AS source_updated_ts",
        )
    if site == "house":
        houses = supplier_sites(spark, sf_dir, site, p).select("_site").distinct()
        return houses.selectExpr(
            "_site AS theatre_id", "concat('House ', _site) AS theatre_name", "'Town' AS city", "'Shire' AS state",
            "'All' AS region", "'UTC' AS timezone", "'ACTIVE' AS theatre_status", f"{_updated(p)} AS source_updated_ts",
        )
    return read_table(spark, sf_dir, "region").selectExpr(
        "r_regionkey AS theatre_id", "r_name AS theatre_name", "r_name AS city", "r_name AS state",
        "r_name AS region", "'UTC' AS timezone", "'ACTIVE' AS theatre_status", f"{_updated(p)} AS source_updated_ts",
    )


def screens(spark: SparkSession, sf_dir: str, site: str = "nation", p: Params = Params()) -> DataFrame:
    return supplier_sites(spark, sf_dir, site, p).selectExpr(
        "s_suppkey AS screen_id",
        "_site AS theatre_id",
        "s_name AS screen_name",
        "CAST(20 + (s_suppkey % 8) * 10 AS INT) AS capacity",
        "CASE WHEN s_suppkey % 3 = 0 THEN 'PREMIUM' ELSE 'STANDARD' END AS screen_format",
        "TRUE AS is_active",
        f"{_updated(p)} AS source_updated_ts",
    )


def movies(spark: SparkSession, sf_dir: str, p: Params = Params()) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS movie_id",
        "p_name AS movie_title",
        "p_type AS genre",
        "'English' AS language",
        "115 AS runtime_minutes",
        "CASE WHEN p_size <= 10 THEN 'PREMIUM' ELSE 'STANDARD' END AS movie_format",
        "date_add(DATE'1995-01-01', CAST(p_partkey % 365 AS INT)) AS release_date",
        "p_brand AS distributor",
        "CAST(5 + p_size % 10 AS DOUBLE) AS average_ticket_price",
        "CAST(p_size * 2 AS DOUBLE) AS seeded_baseline_demand",
        f"{_updated(p)} AS source_updated_ts",
    )


SHOW_START = "l_shipdate + make_dt_interval(0, 19, CAST((l_partkey % 12) * 5 AS INT), 0)"
SHOWTIME_ID = "l_orderkey * 10 + l_linenumber"


def showtimes(spark: SparkSession, sf_dir: str, site: str = "nation", p: Params = Params()) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    sites = supplier_sites(spark, sf_dir, site, p).selectExpr("s_suppkey AS _sk", "_site")
    return li.join(sites, F.expr("l_suppkey = _sk")).selectExpr(
        f"{SHOWTIME_ID} AS showtime_id",
        "_site AS theatre_id",
        "l_suppkey AS screen_id",
        "l_partkey AS movie_id",
        f"{SHOW_START} AS show_start_ts",
        f"{SHOW_START} + make_dt_interval(0, 0, 135, 0) AS show_end_ts",
        "CASE WHEN l_linestatus = 'F' THEN 'PUBLISHED' ELSE 'DRAFT' END AS schedule_status",
        "l_returnflag = 'R' AS is_locked",
        "l_shipdate AS published_ts",
        "l_shipdate AS source_updated_ts",
    )


def bookings(spark: SparkSession, sf_dir: str, p: Params = Params()) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").where("l_discount > 0.01").selectExpr(
        f"concat('BS-', CAST({SHOWTIME_ID} AS STRING)) AS snapshot_id",
        f"{SHOWTIME_ID} AS showtime_id",
        f"{SHOW_START} - make_dt_interval(0, l_linenumber * 12, 0, 0) AS snapshot_ts",
        "CAST(l_quantity AS INT) AS booked_seats",
        "greatest(1, CAST(floor(CAST(l_quantity AS INT) / 2) AS INT)) AS booking_count",
        "l_extendedprice AS gross_booking_revenue",
        "CAST(l_linenumber * 12 AS DOUBLE) AS hours_to_show",
        "l_shipdate AS source_updated_ts",
    )


def booking_export(spark: SparkSession, sf_dir: str, p: Params = Params()) -> DataFrame:
    """The booking feed as text, as an upstream system exports it.

    Open lines (linestatus O) have no confirmed show time yet and report
    hours-to-show as 'TBD', which a typed reader cannot parse.
    """
    return read_table(spark, sf_dir, "lineitem").where("l_discount > 0.01").selectExpr(
        f"concat('BS-', CAST({SHOWTIME_ID} AS STRING)) AS snapshot_id",
        f"CAST({SHOWTIME_ID} AS STRING) AS showtime_id",
        f"CAST({SHOW_START} - make_dt_interval(0, l_linenumber * 12, 0, 0) AS STRING) AS snapshot_ts",
        "CAST(CAST(l_quantity AS INT) AS STRING) AS booked_seats",
        "CAST(greatest(1, CAST(floor(CAST(l_quantity AS INT) / 2) AS INT)) AS STRING) AS booking_count",
        "CAST(l_extendedprice AS STRING) AS gross_booking_revenue",
        "CASE WHEN l_linestatus = 'O' THEN 'TBD' ELSE CAST(CAST(l_linenumber * 12 AS DOUBLE) AS STRING) END AS hours_to_show",
        "CAST(l_shipdate AS STRING) AS source_updated_ts",
    )


def availability(spark: SparkSession, sf_dir: str, site: str = "nation", p: Params = Params()) -> DataFrame:
    return supplier_sites(spark, sf_dir, site, p).selectExpr(
        "concat('AV-', CAST(s_suppkey AS STRING)) AS availability_id",
        "_site AS theatre_id",
        "s_suppkey AS screen_id",
        f"TIMESTAMP_NTZ'{p.run_date} 00:00:00' AS available_from_ts",
        f"TIMESTAMP_NTZ'{p.run_date} 23:59:00' + make_dt_interval(8, 0, 0, 0) AS available_to_ts",
        "TRUE AS is_available",
        "CAST(NULL AS STRING) AS blackout_reason",
        "20 AS minimum_turnaround_minutes",
        f"{_updated(p)} AS source_updated_ts",
    )


def policies(spark: SparkSession, sf_dir: str, site: str = "nation", p: Params = Params()) -> DataFrame:
    return theatres(spark, sf_dir, site, p).selectExpr(
        "concat('POL-', CAST(theatre_id AS STRING)) AS policy_id",
        "theatre_id",
        "CAST((theatre_id % 3) * 12 AS DOUBLE) AS freeze_window_hours",
        "100.0D AS minimum_revenue_uplift",
        "0.6D AS minimum_confidence_score",
        "2 AS maximum_recommendations_per_day",
        f"{_updated(p)} AS source_updated_ts",
    )


class LazyFeeds(Mapping):
    """Feed name -> DataFrame, each built on first use."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]) -> None:
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def domain_feeds(spark: SparkSession, sf_dir: str, site: str = "nation", p: Params = Params()) -> LazyFeeds:
    """All seven feeds, keyed by feed name (built lazily)."""
    if site not in SITE_LEVELS:
        raise ValueError(f"site must be one of {SITE_LEVELS}")
    return LazyFeeds({
        "theatre_master": lambda: theatres(spark, sf_dir, site, p),
        "screen_master": lambda: screens(spark, sf_dir, site, p),
        "movie_master": lambda: movies(spark, sf_dir, p),
        "showtime_schedule": lambda: showtimes(spark, sf_dir, site, p),
        "booking_snapshot": lambda: bookings(spark, sf_dir, p),
        "screen_availability": lambda: availability(spark, sf_dir, site, p),
        "schedule_policy": lambda: policies(spark, sf_dir, site, p),
    })
