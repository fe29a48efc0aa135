"""End-to-end pipeline: feeds -> silver -> gold, lazily, one stage at a time.

Every stage is a lazy DataFrame. ``materialize`` (for example
:func:`slotwise.sources.tables.parquet_materializer`) writes a stage to the
shared folder and reads it back; the pipeline uses it at the two places where
a barrier pays: before pairing (the enriched rows are read by both sides of
the band join and by the hot-group count) and after candidates (an output
table that gating, ranking, audit and reports all read).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise.params import Params
from slotwise.plans import quality
from slotwise.plans.features import demand_features
from slotwise.plans.forecast import demand_forecast, enrich
from slotwise.plans.pairing import candidates, pair_inputs
from slotwise.plans.rank_join import publishable, rank_join
from slotwise.plans.recommend import publish_gate, recommendations
from slotwise.plans.silver import SILVER_SOURCES, silver_table
from slotwise.sources.adapters import domain_feeds
from slotwise.plans.stages import StageStore
from slotwise.sources.tables import create_namespace, parquet_materializer
from slotwise.sources.versions import Version, VersionedTable, show_version

Materializer = Callable[[DataFrame, str], DataFrame]

# Pairs of one (site, time range) above which the band join splits it into a grid of groups.
DEFAULT_HOT_PAIRS = 50_000_000

# Stages written to the shared folder by default: the pair inputs (enriched
# showtimes that can pair, narrowed to the columns pairing reads) are read by
# both band-join sides and the hot-group count; the candidates are an
# output table read by gating, ranking, audit and reports. A job that needs
# only one consumer of the candidates can drop the second barrier.
BARRIERS = ("pair_inputs", "candidates")
SINGLE_CONSUMER = ("pair_inputs",)

class _Silver(Mapping):
    def __init__(self, feeds: Mapping[str, DataFrame], dims: str) -> None:
        self._feeds, self._dims, self._built = feeds, dims, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = silver_table(name, self._feeds[SILVER_SOURCES[name]], self._dims)
        return self._built[name]

    def keep(self, name: str, written: DataFrame) -> None:
        """Use a written copy of a table from here on."""
        self._built[name] = written

    def __iter__(self):
        return iter(SILVER_SOURCES)

    def __len__(self) -> int:
        return len(SILVER_SOURCES)


class Pipeline:
    """Lazily built stages over one set of bronze feeds."""

    def __init__(
        self,
        feeds: Mapping[str, DataFrame],
        p: Params = Params(),
        dims: str = "latest",
        materialize: Materializer | None = None,
        hot_pairs: int | None = DEFAULT_HOT_PAIRS,
        barriers: tuple[str, ...] = BARRIERS,
    ) -> None:
        self.feeds = feeds
        self.p = p
        self.dims = dims
        self.materialize = materialize
        self.hot_pairs = hot_pairs
        self.barriers = tuple(barriers)
        self.silver = _Silver(feeds, dims)

    @classmethod
    def from_driver_tables(
        cls, spark: SparkSession, sf_dir: str, site: str = "nation", p: Params = Params(),
        barriers: tuple[str, ...] | bool = BARRIERS, **kw,
    ) -> "Pipeline":
        """Pipeline over the driver tables. ``barriers`` names the stages written to
        the shared folder (``True`` = all, ``False`` = none)."""
        if barriers is True:
            barriers = BARRIERS
        barriers = tuple(barriers or ())
        if barriers and "materialize" not in kw:
            kw["materialize"] = parquet_materializer(spark)
        return cls(domain_feeds(spark, sf_dir, site, p), p, barriers=barriers, **kw)

    def _barrier(self, df: DataFrame, name: str) -> DataFrame:
        return self.materialize(df, name) if self.materialize and name in self.barriers else df

    @cached_property
    def features(self) -> DataFrame:
        s = self.silver
        return demand_features(
            s["fact_showtime_schedule_current"],
            s["dim_screen"],
            s["dim_movie"],
            s["fact_booking_snapshot"],
            self.p,
        )

    @cached_property
    def forecast(self) -> DataFrame:
        return demand_forecast(self.features, self.p)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.features, self.silver["fact_schedule_policy"], p=self.p)

    @cached_property
    def pair_inputs(self) -> DataFrame:
        return self._barrier(pair_inputs(self.enriched), "pair_inputs")

    @cached_property
    def candidates(self) -> DataFrame:
        # Sizing the ranges reads the pair inputs once more: only worth it from a written table.
        hot = self.hot_pairs if self.materialize and "pair_inputs" in self.barriers else None
        return self._barrier(candidates(self.pair_inputs, self.p, hot, self.materialize), "candidates")

    @cached_property
    def cap(self) -> int | None:
        """Literal bound on every site's daily maximum. The raw feed's maximum
        bounds the conformed one (conforming only removes rows), and the cap is
        a redundant filter, so an upper bound is all it needs to be."""
        policy = self.feeds["schedule_policy"]
        v = policy.selectExpr("max(try_cast(maximum_recommendations_per_day AS INT)) AS m").first()["m"]
        return None if v is None else int(v)

    @property
    def _from_pair_inputs(self) -> bool:
        """Whether the list is found from written pair inputs; with candidates that are written or in memory anyway it is not."""
        return bool(self.materialize) and "pair_inputs" in self.barriers and "candidates" not in self.barriers

    @cached_property
    def publishable(self) -> DataFrame:
        """The candidates that pass their site's gate."""
        if self._from_pair_inputs:
            return publishable(self.pair_inputs, self.p, self.hot_pairs, self.materialize)
        return publish_gate(self.candidates)

    @cached_property
    def recommendations(self) -> DataFrame:
        if self._from_pair_inputs:
            # Candidates grow with the square of a site's shows, the list does not: only what may be listed is paired.
            inputs = self.pair_inputs
            return rank_join(inputs, self.p, self.cap, StageStore(inputs.sparkSession, "rank-join"), self.hot_pairs).recommendations
        return recommendations(self.candidates, self.p, self.cap)

    # ---- publishing ------------------------------------------------------

    def layers(self) -> dict[str, dict[str, DataFrame]]:
        """Every table of a run, by layer (names as the medallion tables)."""
        return {
            "silver": dict(self.silver.items()),
            "gold": {
                "gold_showtime_demand_features": self.features,
                "gold_showtime_demand_forecast": self.forecast,
                "gold_screen_allocation_candidates": self.candidates,
                "gold_screen_allocation_recommendations": self.recommendations,
            },
            "ops": {"ops_data_quality_audit": quality.audit(self.recommendations, self.candidates, self.p)},
        }

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every table as a temp view for SQL users."""
        names = []
        for tables in self.layers().values():
            for name, df in tables.items():
                df.createOrReplaceTempView(prefix + name)
                names.append(prefix + name)
        return names

    def staged(self, store: StageStore) -> DataFrame:
        """Write every stage once, each read by the next; the facts of the checks, observed by those writes.

        Silver, features and recommendations of this pipeline are scans of the store from here on.
        The forecast is a projection of the features and is not written. Candidates grow with the
        square of a site's shows: every one is judged and counted by one pass that writes its
        counts, not the rows; the list comes from the pair inputs by a rank join.
        """
        for name in self.silver:
            self.silver.keep(name, store.stage(self.silver[name], name))
        self.features = store.stage(self.features, "features")
        self.pair_inputs = store.stage(pair_inputs(self.enriched), "pair_inputs")
        self.candidates = candidates(self.pair_inputs, self.p, self.hot_pairs, store.stage)
        counted = quality.metrics({"rows": "count(1)", **quality.CANDIDATE_FACTS})
        store.stage(self.candidates.agg(*(c.alias(k) for k, c in counted.items())), "candidates", {k: F.max(k) for k in counted})
        spark = self.features.sparkSession
        with StageStore(spark, "rank-join") as rounds:
            found = rank_join(self.pair_inputs, self.p, self.cap, rounds, self.hot_pairs)
            self.recommendations = store.stage(found.recommendations, "recommendations", quality.metrics(quality.RECOMMENDATION_FACTS))
        return quality.observed_facts(spark, store.metrics("recommendations"), store.metrics("candidates"))

    def publish(self, spark: SparkSession, root: str, namespaces: dict[str, str] | None = None,
                gate: bool = True) -> dict[str, int]:
        """Write every layer, enforce the gate, then show the new versions.

        Tables are versions under ``root`` (a shared folder), known by views in the
        catalog; ``namespaces`` maps layer -> schema name. Every stage is written once,
        straight into its table's new version, and read back by the next one; row counts
        and checks are observed by those writes. A failed gate or a lost job leaves the
        former versions current. Returns row counts per table.
        """
        namespaces = namespaces or {layer: layer for layer in ("silver", "gold", "ops")}
        for ns in namespaces.values():
            create_namespace(spark, ns, f"{root}/{ns}")
        written: list[tuple[str, VersionedTable, Version]] = []
        counts: dict[str, int] = {}

        def save(layer: str, name: str, df: DataFrame, facts: dict | None = None) -> tuple[DataFrame, dict]:
            table = VersionedTable(spark, f"{root}/{namespaces[layer]}/{name}")
            seen = Observation()
            version = table.write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in quality.metrics(facts or {}).items())))
            written.append((f"{namespaces[layer]}.{name}", table, version))
            counts[f"{namespaces[layer]}.{name}"] = seen.get["rows"]
            return spark.read.schema(df.schema).parquet(version.path), seen.get

        for name in self.silver:
            self.silver.keep(name, save("silver", name, self.silver[name])[0])
        self.features = save("gold", "gold_showtime_demand_features", self.features)[0]
        self.forecast = save("gold", "gold_showtime_demand_forecast", self.forecast)[0]
        with StageStore(spark) as store:
            self.pair_inputs = store.stage(pair_inputs(self.enriched), "pair_inputs")
            paired = candidates(self.pair_inputs, self.p, self.hot_pairs, store.stage)
            self.candidates, of_candidates = save("gold", "gold_screen_allocation_candidates", paired, quality.CANDIDATE_FACTS)
        self.recommendations, of_list = save(
            "gold", "gold_screen_allocation_recommendations", self.recommendations, quality.RECOMMENDATION_FACTS)
        found = quality.observed_facts(spark, of_list, of_candidates)
        save("ops", "ops_data_quality_audit", quality.audit_of(found, self.p))
        if gate:
            quality.enforce_facts(found, self.p)
        for name, table, version in written:
            table.commit(version)
            show_version(spark, name, version.path)
            table.expire()
        return counts
